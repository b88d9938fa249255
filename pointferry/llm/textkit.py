"""Words and their 64-bit codes of whole Arrow string columns, with numpy.

A column's UTF-8 bytes are one array; words never cross two texts. Work goes in slices of a few
megabytes, so that memory follows the longest text and not the batch.
"""

from __future__ import annotations

import ctypes
import inspect
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

SLICE_BYTES = 1 << 20
BLOCK = 1 << 15  # codes that are worked on at once, so that what is made of them on the way stays near the processor
BATCH_ROWS = 1024  # rows of an Arrow batch that are taken at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # masks of a block's first bytes


class _Memo(dict):
    """Values kept by one process; it travels to tasks empty."""

    def __reduce__(self):
        return _Memo, ()


_powers = _Memo()


def in_process(name: str, make: Callable):
    """A value made once in a Python worker and kept there from task to task."""
    held = sys.modules.setdefault("pointferry_task_values", ModuleType("pointferry_task_values")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


class Kept(dict):
    """Values made once and kept in two generations: when the newer is full it becomes the older, whose values go."""

    def __init__(self, make: Callable, room: int, longest: int = 64):
        super().__init__()
        self.make, self.room, self.longest = make, room, longest
        self.older: dict = {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.room:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value

# Separator classes, one flag per byte value; bytes of multi-byte characters are word bytes.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table of a query."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


NO_ID = (1 << 63) - 1  # stands for a null id inside operators; the result has the null again


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """The two columns an operator reads, under its own names; other columns may have any names.

    With ``carry`` a third column, ``rest``, holds all columns but the text.
    """
    chosen = [F.coalesce(df[id_col].cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(df[text_col], F.lit("")).alias("text")]
    if carry:
        chosen.append(F.struct(*(df[f"`{c}`"] for c in df.columns if c != text_col)).alias("rest"))
    return df.select(*chosen)


def with_doc_id(df: DataFrame, id_col: str) -> DataFrame:
    """A result under the caller's name of the id, with null ids restored."""
    named = F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias(id_col)
    return df.select(*(named if c == "doc_id" else df[c] for c in df.columns))


def as_before(df: DataFrame, columns: list[str], text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The columns a carried table came from, with its present text and, if named, that text's length."""
    rest = df.schema["rest"].dataType if "rest" in df.columns else None
    made = []
    for c in columns:
        if c == text_col:
            made.append(F.col("text").alias(c))
        elif c == length_col:
            made.append(F.length("text").cast(rest[c].dataType).alias(c))
        else:
            made.append(F.col("rest").getField(c).alias(c))
    return df.select(*made)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread codes over all 64 bits."""
    made = np.empty(len(h), np.uint64)
    for i in range(0, len(h), BLOCK):
        part = h[i : i + BLOCK]
        part = part ^ (part >> np.uint64(31))
        part *= np.uint64(0xBF58476D1CE4E5B9)
        part ^= part >> np.uint64(29)
        part *= np.uint64(0x94D049BB133111EB)
        np.bitwise_xor(part, part >> np.uint64(32), out=made[i : i + BLOCK])
    return made


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0 to n-1 of the base of all codes, or of its inverse, modulo 2**64."""
    name = "inverse" if inverse else "base"
    if name not in _powers or len(_powers[name]) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), _BASE_INVERSE if inverse else _BASE)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name][:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts in them."""
    texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row (exclusive), bytes and offsets of runs of whole texts of about ``most`` bytes."""
    data, at = text_bytes(texts)
    first = 0
    while first < len(at) - 1:
        last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
        yield first, last, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_bounds(data: np.ndarray, at: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes, and the n + 1 offsets of each text's words."""
    inside = ~separators[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    after[at[1:][at[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit code of each word's bytes, made in slices of whole words.

    Blocks of eight bytes are spread over all bits together with their place before they are added up.
    A sum of bytes times powers would give some unlike words of 1,024 letters one code.
    """
    codes = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        first = starts[i]
        part = np.concatenate([data[first : ends[j - 1]], np.zeros(8, np.uint8)])
        eights = np.ndarray(len(part) - 7, np.uint64, part, strides=(1,))  # the eight bytes from every place on
        a, size = starts[i:j] - first, ends[i:j] - starts[i:j]
        sums = mix(mix((eights[a] & _FIRST_BYTES[np.minimum(size, 8)]) + _BASE))
        more = np.flatnonzero(size > 8)
        if len(more):
            blocks = (size[more] - 1) // 8
            before = np.cumsum(blocks) - blocks
            step = np.arange(blocks.sum()) - np.repeat(before, blocks) + 1
            value = eights[np.repeat(a[more], blocks) + 8 * step] & _FIRST_BYTES[np.minimum(np.repeat(size[more], blocks) - 8 * step, 8)]
            sums[more] += np.add.reduceat(mix(mix(value + _BASE) + step.astype(np.uint64) * _BASE), before)
        codes[i:j] = mix(sums + size.astype(np.uint64) * _BASE)
        i = j
    return codes


def window_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """The code of every run of n neighbouring codes, by position of its first; shorter input gives none.

    A code does not depend on where its run stands, so blocks that overlap give the same ones.
    """
    made = np.empty(max(0, len(codes) - n + 1), np.uint64)
    for i in range(0, len(made), BLOCK):
        part = codes[i : i + BLOCK + n - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers(len(part)), dtype=np.uint64, out=sums[1:])
        made[i : i + BLOCK] = mix((sums[n:] - sums[:-n]) * powers(len(part) - n + 1, True))
    return made


def row_of(at: np.ndarray) -> np.ndarray:
    """For every element the row whose n + 1 offsets hold it."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in a run of the given length that begins at one of the starts."""
    starts = starts.astype(np.int64, copy=False)
    begun = np.bincount(starts, minlength=n + 1)
    begun -= np.bincount(np.minimum(starts + length, n), minlength=n + 1)
    return np.cumsum(begun[:-1]) > 0


def counts_in_rows(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number of set flags in each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of one Arrow batch as one for mapInArrow."""

    def run(batches):
        for batch in batches:
            yield from map(fn, small_batches(batch))

    return run


def small_batches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that what is made of its texts takes less memory than they do."""
    for i in range(0, batch.num_rows, BATCH_ROWS):
        yield batch.slice(i, BATCH_ROWS)
    give_back()


def give_back() -> None:
    """Return freed memory to the system; a Python worker lives on, and so do its neighbours."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(fn: Callable) -> Callable:
    """A function of a group, with memory given back after each."""

    def one(table):
        made = fn(table)
        give_back()
        return made

    def two(left, right):
        made = fn(left, right)
        give_back()
        return made

    return two if len(inspect.signature(fn).parameters) == 2 else one
