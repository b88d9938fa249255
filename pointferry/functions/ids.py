"""Point ids: deterministic UUIDs, UUID detection, key text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from pointferry.model import ID_TYPE

# Fixed value: the URL namespace of RFC 4122.
URL_NAMESPACE_HEX = "6ba7b8119dad11d180b400c04fd430c8"

_DASHED = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
# Dashed, 32 plain hex digits, braced, or a URN; \z because $ would allow a trailing newline.
UUID_PATTERN = rf"(?i)\A(?:{_DASHED}|[0-9a-f]{{32}}|\{{{_DASHED}\}}|urn:uuid:{_DASHED})\z"


def is_uuid(text: Column) -> Column:
    """Whether a text is a UUID in one of the four accepted spellings."""
    return text.rlike(UUID_PATTERN)


def uuid5_url(text: Column) -> Column:
    """The version 5 UUID of a text in the URL namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE_HEX)), text.cast("binary")))
    # The top two bits of the clock sequence are 10, so its first digit becomes one of 8, 9, a, b.
    variant = F.translate(F.substr(digest, F.lit(17), F.lit(1)), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws(
        "-",
        F.substr(digest, F.lit(1), F.lit(8)),
        F.substr(digest, F.lit(9), F.lit(4)),
        F.concat(F.lit("5"), F.substr(digest, F.lit(14), F.lit(3))),
        F.concat(variant, F.substr(digest, F.lit(18), F.lit(3))),
        F.substr(digest, F.lit(21), F.lit(12)),
    )


def to_point_uuid(text: Column) -> Column:
    """A UUID is taken as it is written; any other text gets its version 5 UUID.

    Both candidates sit in an array instead of two CASE branches: code generation shares a common
    subexpression only where it is always evaluated, and so hashes each text once, not five times.
    """
    return F.get(F.array(uuid5_url(text), text), is_uuid(text).cast("int"))


def uuid_id(text: Column) -> Column:
    """A point id holding a UUID text."""
    return F.struct(F.lit(None).cast("decimal(20,0)").alias("num"), text.alias("uuid")).cast(ID_TYPE)


def number_id(number: Column) -> Column:
    """A point id holding an unsigned 64-bit number."""
    return F.struct(number.cast("decimal(20,0)").alias("num"), F.lit(None).cast("string").alias("uuid")).cast(ID_TYPE)


def hashed_id(text: Column) -> Column:
    return uuid_id(to_point_uuid(text))


def make_point_id(key: Column, data_type: T.DataType) -> Column:
    """A number becomes a number id, a text becomes a UUID id without hashing."""
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        return number_id(key)
    if isinstance(data_type, T.StringType):
        return uuid_id(key)
    raise TypeError(f"a point id is a number or a text, not {data_type.simpleString()}")


def binary_uuid(value: Column) -> Column:
    """16 bytes as dashed UUID text."""
    return F.regexp_replace(F.lower(F.hex(value)), r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def key_to_string(key: Column, data_type: T.DataType) -> Column:
    """A table key as the text that is hashed: 16 bytes are a UUID, other bytes are text."""
    if isinstance(data_type, T.BinaryType):
        return F.when(F.octet_length(key) == 16, binary_uuid(key)).otherwise(F.decode(key, "UTF-8"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        fraction = F.regexp_replace(F.date_format(key.cast("timestamp_ntz"), ".SSSSSS"), r"\.?0*$", "")
        seconds = F.date_format(key.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
        return F.concat(seconds, fraction, F.lit(" +0000 UTC"))
    if isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        return float_text(key, 32 if isinstance(data_type, T.FloatType) else 64)
    return key.cast("string")


def float_text(key: Column, bits: int = 64) -> Column:
    """A float by its fewest digits: plain, and with a two-digit exponent below 1e-4 and from 1e21 on."""
    kind, digits = ("double", (15, 16, 17)) if bits == 64 else ("float", (6, 7, 8, 9))
    size = F.abs(key.cast("double"))
    # The first of these texts that reads back as the same number; the last always does.
    texts = [F.format_string(f"%.{n - 1}e", key) for n in digits]
    text = F.coalesce(*[F.when(t.cast(kind) == key, t) for t in texts[:-1]], texts[-1])
    mantissa = F.regexp_replace(F.substring_index(text, "e", 1), r"\.?0*$", "")
    wide = F.when(size >= 1, text.try_cast("decimal(38,16)").cast("string")).otherwise(text.try_cast("decimal(38,24)").cast("string"))
    return (
        F.when(F.isnan(key), F.lit("NaN"))
        .when(size == float("inf"), F.when(key > 0, F.lit("+Inf")).otherwise(F.lit("-Inf")))
        .when(size == 0, F.regexp_replace(key.cast("string"), r"\.0$", ""))
        .when((size < 1e-4) | (size >= 1e21), F.concat(mantissa, F.lit("e"), F.substring_index(text, "e", -1)))
        .otherwise(F.regexp_replace(F.regexp_replace(wide, "0+$", ""), r"\.$", ""))
    )


def objectid_text(hex_text: Column) -> Column:
    """The printed form of a document store's object id; this text is hashed and kept."""
    return F.format_string('ObjectID("%s")', hex_text)


def offset_key(source: Column) -> Column:
    """The row id of a source's progress record. Unlike a point id it is always hashed."""
    return uuid5_url(source)


def range_offset_name(source: Column, workers: Column, range_id: Column) -> Column:
    """The progress name of one key range; a new worker count starts afresh."""
    return F.format_string("%s-workers-%d-range-%d", source, workers, range_id)


def id_order(id_col: Column) -> list[Column]:
    """Sort columns of the point-id order: null, then numbers, then UUIDs as text."""
    return [id_col["uuid"].asc_nulls_first(), id_col["num"].asc_nulls_first()]


def id_order_key(id_col: Column) -> Column:
    """One text whose plain order is the point-id order, so ranges need a single key column."""
    return (
        F.when(id_col["uuid"].isNotNull(), F.concat(F.lit("2"), id_col["uuid"]))
        .when(id_col["num"].isNotNull(), F.concat(F.lit("1"), F.lpad(id_col["num"].cast("string"), 20, "0")))
        .otherwise(F.lit("0"))
    )
