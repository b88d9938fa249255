"""One normaliser per source, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from pointferry.sources.base import accepted, rejected
from pointferry.sources.chroma import normalize_chroma
from pointferry.sources.collection import normalize_collection
from pointferry.sources.faiss import normalize_faiss
from pointferry.sources.milvus import normalize_milvus
from pointferry.sources.mongodb import normalize_mongodb
from pointferry.sources.pinecone import normalize_pinecone
from pointferry.sources.postgres import normalize_pg
from pointferry.sources.redis import normalize_redis
from pointferry.sources.s3vectors import normalize_s3_vectors
from pointferry.sources.search_hits import normalize_elasticsearch, normalize_opensearch
from pointferry.sources.staged import RAW_SCHEMAS, read_staged, read_table
from pointferry.sources.weaviate import normalize_weaviate

NORMALIZERS: dict[str, Callable[..., DataFrame]] = {
    "collection": normalize_collection,
    "milvus": normalize_milvus,
    "pinecone": normalize_pinecone,
    "chroma": normalize_chroma,
    "weaviate": normalize_weaviate,
    "redis": normalize_redis,
    "mongodb": normalize_mongodb,
    "opensearch": normalize_opensearch,
    "elasticsearch": normalize_elasticsearch,
    "pg": normalize_pg,
    "s3": normalize_s3_vectors,
    "faiss": normalize_faiss,
}


def normalize(source: str, raw: DataFrame, **options) -> DataFrame:
    """Bring a staged raw table to the point shape."""
    if source not in NORMALIZERS:
        raise ValueError(f"unknown source {source!r}; one of {', '.join(sorted(NORMALIZERS))}")
    return NORMALIZERS[source](raw, **options)


__all__ = [
    "NORMALIZERS",
    "RAW_SCHEMAS",
    "accepted",
    "normalize",
    "normalize_collection",
    "read_staged",
    "read_table",
    "rejected",
]
