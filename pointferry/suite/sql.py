"""Building blocks of the comparison SQL."""

from __future__ import annotations

from pointferry.functions.ids import URL_NAMESPACE_HEX


def uuid5(text: str) -> str:
    """Version 5 UUID of a text expression in the URL namespace."""
    h = f"sha1(unhex('{URL_NAMESPACE_HEX}') || encode({text}))"
    return (
        f"concat_ws('-', {h}[1:8], {h}[9:12], '5' || {h}[14:16], "
        f"substr('89ab', (strpos('0123456789abcdef', {h}[17]) - 1) % 4 + 1, 1) || {h}[18:20], {h}[21:32])"
    )


def checksum(vector: str) -> str:
    """The whole-number fingerprint of a vector expression."""
    return f"list_sum(list_transform({vector}, lambda x, i: i * floor(x::DOUBLE * 1000000)::BIGINT))::BIGINT"


def with_vector(table: str, key: str, columns: str = "t.*") -> str:
    """Rows of a table with an embedding chosen by their key."""
    return (
        f"SELECT {columns}, e.embedding FROM {table} t "
        f"JOIN embeddings e ON e.vec_id = t.{key} % (SELECT count(*) FROM embeddings)"
    )
