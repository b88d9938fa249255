"""Vector values: decoding, shape tests, named-vector maps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from pointferry.model import VECTOR_TYPE, VECTORS_TYPE, empty_vectors


def dense(data: Column) -> Column:
    """A dense vector value, narrowed to 32-bit floats; overflow becomes infinity."""
    return F.struct(
        data.cast("array<float>").alias("data"),
        F.lit(None).cast("array<bigint>").alias("indices"),
        F.lit(None).cast("int").alias("vectors_count"),
    ).cast(VECTOR_TYPE)


def sparse(indices: Column, values: Column) -> Column:
    """A sparse vector value from two parallel arrays."""
    return F.struct(
        values.cast("array<float>").alias("data"),
        indices.cast("array<bigint>").alias("indices"),
        F.lit(None).cast("int").alias("vectors_count"),
    ).cast(VECTOR_TYPE)


def named(vectors: dict[str, Column]) -> Column:
    """A named-vector map without the entries whose source value is NULL."""
    if not vectors:
        return empty_vectors()
    pairs = [part for name, value in vectors.items() for part in (F.lit(name), value)]
    return drop_absent(F.create_map(*pairs)).cast(VECTORS_TYPE)


def drop_absent(vectors: Column) -> Column:
    """Remove entries without data; a record without any vector keeps an empty map."""
    return F.coalesce(F.map_filter(vectors, lambda _, v: v["data"].isNotNull()), empty_vectors())


def merge_named(base: Column, override: Column) -> Column:
    """Union of two maps where the second wins a name clash."""
    kept = F.map_filter(base, lambda k, _: ~F.map_contains_key(override, k))
    return F.when(override.isNull(), base).otherwise(F.map_concat(kept, override))


def clone_vectors(vectors: Column) -> Column:
    """Vectors in the point's own type: data, positions and counts as they are, absent stays absent."""
    return vectors.cast(VECTORS_TYPE)


# --- binary vectors -------------------------------------------------------------------------


def _binary_parts(blobs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and validity of every blob in the column's shared byte buffer."""
    wide = pa.types.is_large_binary(blobs.type)
    offsets = np.frombuffer(blobs.buffers()[1], dtype="<i8" if wide else "<i4")
    offsets = offsets[blobs.offset : blobs.offset + len(blobs) + 1].astype(np.int64)
    valid = np.asarray(blobs.is_valid())
    return offsets[:-1], np.where(valid, np.diff(offsets), 0), valid


def _decode_floats(blobs: pa.Array) -> pa.Array:
    if len(blobs) == 0:
        return pa.array([], type=pa.list_(pa.float32()))
    starts, lengths, valid = _binary_parts(blobs)
    counts = lengths // 4
    ends = np.cumsum(counts)
    data = blobs.buffers()[2]
    if int(ends[-1]) == 0 or data is None:
        floats = np.empty(0, dtype="<f4")
    else:
        raw = np.frombuffer(data, dtype=np.uint8)
        if np.array_equal(starts[1:], (starts + counts * 4)[:-1]):
            # No gaps between the blobs: the buffer already is the float column.
            floats = np.frombuffer(raw[starts[0] : starts[0] + 4 * int(ends[-1])].tobytes(), dtype="<f4")
        else:
            whole = memoryview(data)
            floats = np.frombuffer(b"".join(whole[a:b] for a, b in zip(starts.tolist(), (starts + 4 * counts).tolist())), dtype="<f4")
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(floats), mask=pa.array(~valid))


@arrow_udf(T.ArrayType(T.FloatType()))
def bytes_to_floats(blobs: pa.Array) -> pa.Array:
    """Little-endian 32-bit floats; up to three trailing bytes are dropped.

    No built-in function reinterprets bits, so this is Arrow's buffers viewed through numpy: no
    Python object is made per row or per element.
    """
    return _decode_floats(blobs)


@arrow_udf(T.BinaryType())
def floats_to_bytes(vectors: pa.Array) -> pa.Array:
    """The inverse of bytes_to_floats; NaN payloads, infinities and -0 survive."""
    if len(vectors) == 0:
        return pa.array([], type=pa.binary())
    valid = np.asarray(vectors.is_valid())
    counts = np.where(valid, np.asarray(vectors.value_lengths().fill_null(0)), 0)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f4")
    offsets = np.concatenate([[0], np.cumsum(counts * 4)]).astype(np.int32)
    validity = pa.array(valid).buffers()[1] if valid.all() else pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    return pa.Array.from_buffers(
        pa.binary(), len(vectors), [validity, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())]
    )


# --- is this JSON value a vector? -----------------------------------------------------------

_NUMBER_KINDS = r"BIGINT|FLOAT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\)"
_FULL_ARRAY = rf"^ARRAY<(?:{_NUMBER_KINDS})>$"
_ANY_ARRAY = rf"^ARRAY<(?:{_NUMBER_KINDS}|VOID)>$"


def list_floats(value: Column) -> Column:
    """The elements of a JSON list of numbers as 32-bit floats.

    Through the list's text: a VARIANT keeps most numbers as decimals, and casting those one by one
    takes about twice as long as writing and reading them.
    """
    return F.from_json(F.to_json(value), "array<double>").cast("array<float>")


def candidate_vector(value: Column, empty_is_vector: bool) -> Column:
    """The floats of a JSON list of numbers, possibly with NULL elements; else NULL."""
    kind = F.schema_of_variant(value)
    return F.when(kind.rlike(_ANY_ARRAY if empty_is_vector else _FULL_ARRAY), list_floats(value))


def is_whole(floats: Column) -> Column:
    """Whether a candidate is there and has no NULL element."""
    return floats.isNotNull() & ~F.coalesce(F.exists(floats, lambda x: x.isNull()), F.lit(False))


def variant_vector(value: Column, empty_is_vector: bool) -> Column:
    """The floats of a JSON list whose elements are all numbers, else NULL.

    The kind test alone would let a list with a JSON null through, and a cast alone would turn
    ``["1"]`` or ``[true]`` into floats; both are needed.
    """
    floats = candidate_vector(value, empty_is_vector)
    return F.when(is_whole(floats), floats)


def candidate_vectors(fields: Column, empty_is_vector: bool, only: list[str] | None = None) -> Column:
    """Every field's candidate floats. ``only`` limits the test to fields a mapping declares."""
    tested = fields if only is None else F.map_filter(fields, lambda k, _: k.isin(list(only)))
    return F.transform_values(tested, lambda _, v: candidate_vector(v, empty_is_vector))


def whole_vectors(candidates: Column) -> Column:
    """The candidates that are vectors, as a named-vector map."""
    return F.transform_values(F.map_filter(candidates, lambda _, v: is_whole(v)), lambda _, v: dense(v))


def as_vector_nonempty(value: Column) -> Column:
    """Search-store rule A: a non-empty list of numbers."""
    return variant_vector(value, empty_is_vector=False)


def as_vector_or_empty(value: Column) -> Column:
    """Search-store rule B: a list of numbers, where the empty list is a vector of size 0."""
    return variant_vector(value, empty_is_vector=True)


def as_vector_doubles(value: Column) -> Column:
    """Document-store rule: a list whose elements all are doubles; the empty list counts.

    Looks at every element's own kind (DOUBLE or DECIMAL), because a VARIANT array reports one
    merged kind and so hides a whole number among doubles.
    """
    elements = value.try_cast("array<variant>")
    doubles = F.forall(elements, lambda e: F.coalesce(F.schema_of_variant(e).startswith("D"), F.lit(False)))
    return F.when(doubles, list_floats(value))
