"""Reading staged exports, one raw table per source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schemas of the staged raw tables. A table export and a typed collection keep their own schema.
RAW_SCHEMAS = {
    "collection": (
        "id struct<num:decimal(20,0),uuid:string>,"
        "vectors map<string,struct<data:array<float>,indices:array<bigint>,vectors_count:int>>,"
        "payload variant,shard_key struct<keyword:string,number:decimal(20,0)>,source_ord bigint"
    ),
    "redis": "key string, fields map<string,binary>",
    "mongodb": "doc string",
    "elasticsearch": "_id string, _source string, fields string",
    "opensearch": "_id string, _source string",
    "pinecone": (
        "id string, values array<float>, sparse_indices array<bigint>, sparse_values array<float>,"
        " metadata string, namespace string"
    ),
    "chroma": "id string, embedding array<float>, document string, metadata string",
    "weaviate": (
        "id string, vector array<double>, vectors map<string,array<double>>, properties string, tenant string"
    ),
    "s3": "key string, data array<float>, metadata string",
    "faiss": "pos bigint, vector array<float>",
}


def read_staged(spark: SparkSession, source: str, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """A staged export as a batch or streaming DataFrame.

    ``jsonl`` reads one record per line; nested objects land in the JSON text columns unchanged,
    and a document store's lines are the documents themselves.
    """
    if fmt not in ("parquet", "jsonl"):
        raise ValueError(f"staged format must be 'parquet' or 'jsonl', not {fmt!r}")
    reader = spark.readStream if stream else spark.read
    if fmt == "jsonl" and source == "mongodb":
        return reader.text(path).withColumnRenamed("value", "doc")
    schema = RAW_SCHEMAS.get(source)
    if schema is not None:
        reader = reader.schema(schema)
    elif stream or fmt == "jsonl":
        raise ValueError(f"source {source!r} has no fixed schema; read it with its own and pass the DataFrame")
    return reader.json(path) if fmt == "jsonl" else reader.parquet(path)


def range_predicates(key: str, boundaries: list[str]) -> list[str]:
    """One SQL condition per key range ``(start, end]``, the outer two open, for a partitioned JDBC read."""
    quoted = ["'" + b.replace("'", "''") + "'" for b in boundaries]
    column = '"' + key.replace('"', '""') + '"'
    if not quoted:
        return ["1 = 1"]
    conditions = [f"{column} <= {quoted[0]}"]
    conditions += [f"{column} > {a} AND {column} <= {b}" for a, b in zip(quoted, quoted[1:])]
    return conditions + [f"{column} > {quoted[-1]}"]


def read_table(
    spark: SparkSession, url: str, table: str, key: str, boundaries: list[str], properties: dict[str, str] | None = None
) -> DataFrame:
    """A database table, one task per key range, where a JDBC driver is on the class path."""
    return spark.read.jdbc(url, table, predicates=range_predicates(key, boundaries), properties=properties or {})
