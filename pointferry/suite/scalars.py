"""Scalar functions on ids, vectors and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pointferry import sources as src
from pointferry.functions import ids, numbers, payload as pl, vectors as vec
from pointferry.model import VECTORS_TYPE, payload_kind, payload_value, vector_checksum
from pointferry.suite import sql, staging


def f01_to_point_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole document texts, in four languages, as ids."""
    docs = staging.table(spark, sf_dir, "documents")
    return docs.select("doc_id", ids.to_point_uuid(F.col("text")).alias("point_uuid"))


def _spellings() -> Column:
    """An order key as text, or as a UUID in one of four spellings, or nearly one."""
    u = ids.uuid5_url(F.col("o_orderkey").cast("string"))
    return (
        F.when(F.col("o_orderkey") % 8 == 0, u)
        .when(F.col("o_orderkey") % 8 == 1, F.upper(u))
        .when(F.col("o_orderkey") % 8 == 2, F.concat(F.lit("{"), u, F.lit("}")))
        .when(F.col("o_orderkey") % 8 == 3, F.concat(F.lit("URN:uuid:"), u))
        .when(F.col("o_orderkey") % 8 == 4, F.regexp_replace(u, "-", ""))
        .when(F.col("o_orderkey") % 8 == 5, F.concat(u, F.lit("\n")))
        .when(F.col("o_orderkey") % 8 == 6, F.concat(F.lit("é"), F.col("o_orderpriority")))
        .otherwise(F.col("o_orderkey").cast("string"))
    )


def f02_is_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = staging.table(spark, sf_dir, "orders").withColumn("text", _spellings())
    return orders.select("o_orderkey", ids.is_uuid(F.col("text")).alias("is_uuid"), ids.to_point_uuid(F.col("text")).alias("point_uuid"))


_U = sql.uuid5("o_orderkey::VARCHAR")
F02_SQL = f"""
WITH t AS (SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN {_U} WHEN 1 THEN upper({_U}) WHEN 2 THEN '{{' || {_U} || '}}'
   WHEN 3 THEN 'URN:uuid:' || {_U} WHEN 4 THEN replace({_U}, '-', '') WHEN 5 THEN {_U} || chr(10)
   WHEN 6 THEN 'é' || o_orderpriority ELSE o_orderkey::VARCHAR END AS text FROM orders)
SELECT o_orderkey, o_orderkey % 8 < 5 AS is_uuid, CASE WHEN o_orderkey % 8 < 5 THEN text ELSE {sql.uuid5('text')} END AS point_uuid
FROM t
"""


def f03_key_to_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = staging.table(spark, sf_dir, "part")
    blob = F.when(F.col("p_partkey") % 2 == 0, F.unhex(F.md5("p_name"))).otherwise(F.col("p_brand").cast("binary"))
    return part.select(
        "p_partkey",
        ids.key_to_string(blob, T.BinaryType()).alias("binary_key"),
        ids.key_to_string(F.col("p_partkey"), T.LongType()).alias("number_key"),
        ids.key_to_string(F.col("p_name"), T.StringType()).alias("text_key"),
    )


F03_SQL = """
WITH t AS (SELECT *, md5(p_name) AS h FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) ELSE p_brand END AS binary_key,
       p_partkey::VARCHAR AS number_key, p_name AS text_key FROM t
"""


def f03_float_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole, broken, very large and very small floats as keys."""
    part = staging.table(spark, sf_dir, "part")
    n = F.col("p_partkey") % 9 + 1
    text = lambda c, t: ids.key_to_string(c.cast(t), T.DoubleType() if t == "double" else T.FloatType())
    return part.select(
        "p_partkey",
        text(F.col("p_partkey"), "double").alias("whole"),
        text(F.col("p_retailprice"), "double").alias("price"),
        text(F.concat(n, F.lit("e22")), "double").alias("large"),
        text(F.concat(F.lit("-"), n, F.lit("e-6")), "double").alias("small"),
        text(n / 4, "float").alias("narrow"),
    )


F03_FLOAT_SQL = """
SELECT p_partkey, p_partkey::VARCHAR AS whole, regexp_replace(p_retailprice::VARCHAR, '\\.0$', '') AS price,
       (p_partkey % 9 + 1)::VARCHAR || 'e+22' AS large, '-' || (p_partkey % 9 + 1)::VARCHAR || 'e-06' AS small,
       regexp_replace(((p_partkey % 9 + 1) / 4)::VARCHAR, '\\.0$', '') AS narrow FROM part
"""


def f04_make_point_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = staging.table(spark, sf_dir, "customer")
    number = ids.make_point_id(F.col("c_custkey"), T.LongType())
    text = ids.make_point_id(F.col("c_name"), T.StringType())
    return cust.select(
        "c_custkey",
        number["num"].cast("string").alias("number_num"),
        number["uuid"].isNull().alias("number_has_no_uuid"),
        text["uuid"].alias("text_uuid"),
        text["num"].isNull().alias("text_has_no_num"),
    )


def f04b_objectid_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = staging.table(spark, sf_dir, "pages")
    text = ids.objectid_text(F.substr(F.md5("url"), F.lit(1), F.lit(24)))
    return pages.select("page_id", text.alias("id_text"), ids.to_point_uuid(text).alias("point_uuid"))


def f04c_offset_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = staging.table(spark, sf_dir, "customer")
    name = ids.range_offset_name(F.col("c_mktsegment"), F.col("c_nationkey") + 1, F.col("c_custkey"))
    return cust.select("c_custkey", name.alias("name"), ids.offset_key(name).alias("record_id"))


_RANGE_NAME = "c_mktsegment || '-workers-' || (c_nationkey + 1)::VARCHAR || '-range-' || c_custkey::VARCHAR"


def f05_bytes_to_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings to bytes and back, with up to three stray bytes at the end."""
    emb = staging.table(spark, sf_dir, "embeddings")
    stray = F.substr(F.lit("xyz"), F.lit(1), (F.col("vec_id") % 4).cast("int")).cast("binary")
    coded = emb.select("vec_id", F.concat(vec.floats_to_bytes(F.col("embedding")), stray).alias("blob"))
    back = coded.select("vec_id", F.octet_length("blob").cast("bigint").alias("n_bytes"), vec.bytes_to_floats(F.col("blob")).alias("v"))
    return back.select("vec_id", "n_bytes", F.size("v").cast("bigint").alias("dim"), vector_checksum(F.col("v")).alias("sum"))


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON list per event, of eight kinds."""
    events = staging.table(spark, sf_dir, "events")
    k = F.col("event_id") % 8
    user = F.col("user_id").cast("string")
    value = F.col("value").cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("["), value, F.lit(", -1.5e1]")))
        .when(k == 1, F.concat(F.lit("["), user, F.lit(","), value, F.lit("]")))
        .when(k == 2, F.concat(F.lit("["), user, F.lit(",2]")))
        .when(k == 3, F.lit("[]"))
        .when(k == 4, F.concat(F.lit("["), value, F.lit(",null]")))
        .when(k == 5, F.concat(F.lit('["'), user, F.lit('"]')))
        .when(k == 6, F.lit("[true]"))
        .otherwise(F.concat(F.lit("[["), value, F.lit("]]")))
    )
    return events.select("event_id", text.alias("text"))


def _as_vector(kind: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        lists = _lists(spark, sf_dir)
        parsed = F.parse_json("text")
        v = {
            "nonempty": lambda: vec.as_vector_nonempty(parsed),
            "or_empty": lambda: vec.as_vector_or_empty(parsed),
            "doubles": lambda: vec.as_vector_doubles(parsed),
        }[kind]()
        found = lists.select("event_id", v.alias("v"))
        return found.select(
            "event_id",
            F.col("v").isNotNull().alias("is_vector"),
            F.coalesce(F.size("v"), F.lit(-1)).cast("bigint").alias("dim"),
            F.coalesce(vector_checksum(F.col("v")), F.lit(0)).alias("sum"),
        )

    return query


def _as_vector_sql(kinds: str) -> str:
    floats = "CASE event_id % 8 WHEN 0 THEN [value, -15.0] WHEN 1 THEN [user_id::DOUBLE, value] WHEN 2 THEN [user_id::DOUBLE, 2.0] WHEN 3 THEN [] END"
    return f"""
WITH t AS (SELECT event_id, event_id % 8 IN ({kinds}) AS is_vector, list_transform({floats}, lambda x: x::FLOAT) AS v FROM events)
SELECT event_id, is_vector, CASE WHEN is_vector THEN len(v) ELSE -1 END::BIGINT AS dim,
       CASE WHEN is_vector THEN coalesce({sql.checksum('v')}, 0) ELSE 0 END AS sum FROM t
"""


def f07_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = staging.table(spark, sf_dir, "lineitem")
    v = vec.dense(F.array(F.col("l_extendedprice"), F.col("l_tax"), F.col("l_quantity") * 1e300))["data"]
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        v[0].cast("double").alias("price"),
        v[1].cast("double").alias("tax"),
        (v[2] == float("inf")).alias("overflows"),
    )


def f08_sparse_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = staging.table(spark, sf_dir, "embeddings")
    hits = F.filter(F.transform("embedding", lambda x, i: F.struct(i.cast("bigint").alias("i"), x.alias("v"))), lambda s: s["v"] > 0)
    v = vec.sparse(F.transform(hits, lambda s: s["i"]), F.transform(hits, lambda s: s["v"]))
    made = emb.select("vec_id", vec.named({"terms": v}).alias("vectors")).select("vec_id", F.col("vectors")["terms"].alias("v"))
    return made.select(
        "vec_id",
        F.size("v.indices").cast("bigint").alias("n_positions"),
        F.aggregate("v.indices", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("position_sum"),
        vector_checksum(F.col("v.data")).alias("sum"),
    )


F08_SQL = f"""
WITH t AS (SELECT vec_id, list_filter(list_transform(embedding, lambda x, i: {{'i': i - 1, 'v': x}}), lambda s: s.v > 0) AS h FROM embeddings)
SELECT vec_id, len(h)::BIGINT AS n_positions, coalesce(list_sum(list_transform(h, lambda s: s.i)), 0)::BIGINT AS position_sum,
       coalesce({sql.checksum('list_transform(h, lambda s: s.v)')}, 0) AS sum FROM t
"""


def f09_split_vectors_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows split by schema, and records without a vector kept with an empty map."""
    emb = staging.table(spark, sf_dir, "embeddings")
    raw = emb.select("vec_id", F.when(F.col("vec_id") % 3 != 0, F.col("embedding")).alias("a"), F.when(F.col("vec_id") % 2 == 0, F.reverse("embedding")).alias("b"), "label")
    points = src.normalize_milvus(raw, pk="vec_id")
    return points.select(
        F.col("id.num").cast("string").alias("point_id"),
        F.size("vectors").cast("bigint").alias("n_vectors"),
        F.array_join(F.array_sort(F.map_keys("vectors")), ",").alias("names"),
        F.coalesce(vector_checksum(F.try_element_at(F.col("vectors"), F.lit("b"))["data"]), F.lit(0)).alias("b_sum"),
        F.to_json("payload").alias("payload_json"),
    )


F09_SQL = f"""
SELECT vec_id::VARCHAR AS point_id, ((vec_id % 3 <> 0)::INT + (vec_id % 2 = 0)::INT)::BIGINT AS n_vectors,
       concat_ws(',', CASE WHEN vec_id % 3 <> 0 THEN 'a' END, CASE WHEN vec_id % 2 = 0 THEN 'b' END) AS names,
       CASE WHEN vec_id % 2 = 0 THEN {sql.checksum('list_reverse(embedding)')} ELSE 0 END AS b_sum,
       '{{"label":' || label::VARCHAR || '}}' AS payload_json
FROM embeddings
"""


def f10_sanitize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested values of every kind, cleaned by their schema."""
    lines = staging.table(spark, sf_dir, "lineitem")
    nested = F.struct(
        F.array(F.col("l_shipdate"), F.date_add("l_shipdate", 1).cast("timestamp_ntz")).alias("dates"),
        F.create_map(F.lit("small"), F.col("l_linenumber").cast("smallint")).alias("counts"),
        F.col("l_quantity").cast("decimal(10,3)").alias("quantity"),
        F.col("l_orderkey").alias("orderkey"),
        F.unhex(F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber"))).alias("guid"),
        F.col("l_returnflag").cast("binary").alias("raw"),
    )
    staged = lines.select("l_orderkey", "l_linenumber", nested.alias("v"))
    clean = pl.to_variant(F.col("v"), staged.schema["v"].dataType)
    return staged.select("l_orderkey", "l_linenumber", F.to_json(clean).alias("value_json"))


F10_SQL = """
WITH t AS (SELECT *, md5(l_orderkey::VARCHAR || '-' || l_linenumber::VARCHAR) AS h FROM lineitem)
SELECT l_orderkey, l_linenumber,
  '{"counts":{"small":"' || l_linenumber::VARCHAR || '"},"dates":["' || strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') || '","'
  || strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%SZ') || '"],"guid":"'
  || concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) || '","orderkey":' || l_orderkey::VARCHAR
  || ',"quantity":"' || l_quantity::DECIMAL(10,3)::VARCHAR || '","raw":"' || to_base64(encode(l_returnflag)) || '"}' AS value_json
FROM t
"""


def f10b_rfc3339(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microseconds are dropped; a value with a zone prints its offset or Z."""
    events = staging.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        pl.rfc3339_utc(F.col("ts")).alias("plain"),
        pl.rfc3339(F.col("ts").cast("timestamp")).alias("zoned"),
    )


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = staging.table(spark, sf_dir, "events")
    text = F.format_string(
        '{"n":%d,"x":%s,"e":1e2,"big":1844674407370955%04d,"s":"7 of \\"12\\" 3.5","deep":{"list":[%d,{"m":-%d}]}}',
        "user_id",
        F.col("value").cast("string"),
        F.col("event_id") % 10000,
        "event_id",
        "user_id",
    )
    return events.select("event_id", text.alias("text"))


def _number_kinds(rewrite):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        p = F.parse_json(rewrite(F.col("text")))
        rows = _metadata(spark, sf_dir).select("event_id", p.alias("p"))

        def kind(path: str) -> Column:
            return F.lower(F.schema_of_variant(F.variant_get("p", path, "variant")))

        return rows.select(
            "event_id",
            F.variant_get("p", "$.n", "double").alias("n"),
            F.variant_get("p", "$.x", "double").alias("x"),
            F.variant_get("p", "$.big", "double").alias("big"),
            F.variant_get("p", "$.s", "string").alias("s"),
            F.variant_get("p", "$.deep.list[0]", "double").alias("deep0"),
            F.variant_get("p", "$.deep.list[1].m", "double").alias("deep_m"),
            kind("$.n").alias("n_kind"),
            kind("$.x").alias("x_kind"),
            kind("$.e").alias("e_kind"),
            kind("$.big").alias("big_kind"),
            kind("$.deep.list[1].m").alias("deep_kind"),
        )

    return query


def _number_sql(whole: str) -> str:
    return f"""
SELECT event_id, user_id::DOUBLE AS n, value AS x, ('1844674407370955' || lpad((event_id % 10000)::VARCHAR, 4, '0'))::DOUBLE AS big,
       '7 of "12" 3.5' AS s, event_id::DOUBLE AS deep0, -user_id::DOUBLE AS deep_m,
       '{whole}' AS n_kind, 'double' AS x_kind, 'double' AS e_kind, 'double' AS big_kind, '{whole}' AS deep_kind
FROM events
"""


def f13_relaxed_extjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested typed values of a document stay objects, their numbers are doubles."""
    events = staging.table(spark, sf_dir, "events")
    text = F.format_string(
        '{"_id":{"$oid":"%s"},"at":{"$date":"%s"},"blob":{"$binary":{"base64":"AQI=","subType":"00"}},"n":%d}',
        F.substr(F.md5(F.col("event_id").cast("string")), F.lit(1), F.lit(24)),
        pl.rfc3339_utc(F.col("ts")),
        "user_id",
    )
    fields = events.select("event_id", pl.json_fields(numbers.numbers_to_double(text)).alias("f"))
    body = fields.select("event_id", pl.fields_to_payload(F.col("f")).alias("p"))
    return body.select(
        "event_id",
        F.variant_get("p", "$._id['$oid']", "string").alias("oid"),
        F.variant_get("p", "$.at['$date']", "string").alias("at"),
        F.variant_get("p", "$.blob['$binary'].base64", "string").alias("blob"),
        payload_value(F.col("p"), "n", "double").alias("n"),
        payload_kind(F.col("p"), "n").alias("n_kind"),
    )


def f14_parse_numeric_or_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = staging.table(spark, sf_dir, "events")
    k = F.col("event_id") % 6
    text = (
        F.when(k == 0, F.col("value").cast("string"))
        .when(k == 1, F.concat(F.col("user_id").cast("string"), F.lit("e2")))
        .when(k == 2, F.col("event_type"))
        .when(k == 3, F.concat(F.lit(" "), F.col("user_id").cast("string")))
        .when(k == 4, F.concat(F.col("user_id").cast("string"), F.lit("d")))
        .otherwise(F.lit("1e999"))
    )
    parsed = events.select("event_id", text.alias("text"), pl.parse_numeric_or_text(text).alias("v"))
    return parsed.select(
        "event_id",
        F.lower(F.schema_of_variant("v")).alias("kind"),
        F.coalesce(F.when(F.schema_of_variant("v") == "DOUBLE", F.try_variant_get("v", "$", "double")), F.lit(-1.0)).alias("number"),
        F.when(F.schema_of_variant("v") == "STRING", F.try_variant_get("v", "$", "string")).otherwise("").alias("text"),
    )


F14_SQL = """
SELECT event_id, CASE WHEN event_id % 6 < 2 THEN 'double' ELSE 'string' END AS kind,
       CASE event_id % 6 WHEN 0 THEN value WHEN 1 THEN user_id * 100.0 ELSE -1 END::DOUBLE AS number,
       CASE event_id % 6 WHEN 2 THEN event_type WHEN 3 THEN ' ' || user_id::VARCHAR WHEN 4 THEN user_id::VARCHAR || 'd'
            WHEN 5 THEN '1e999' ELSE '' END AS text
FROM events
"""


def _fields(df: DataFrame) -> Column:
    return pl.typed_fields({"lang": F.col("lang"), "n": F.col("n_chars")})


def f15_with_id_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field named like the id field, under both rules."""
    docs = staging.table(spark, sf_dir, "documents")
    clash = F.when(F.col("doc_id") % 2 == 0, F.map_concat(_fields(docs), pl.typed_fields({"__id__": F.col("source")}))).otherwise(_fields(docs))
    staged = docs.select("doc_id", clash.alias("f"))
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    both = staged.select(
        "doc_id",
        pl.fields_to_payload(pl.with_field(F.col("f"), "__id__", name, wins=True)).alias("a"),
        pl.fields_to_payload(pl.with_field(F.col("f"), "__id__", name, wins=False)).alias("b"),
    )
    return both.select(
        "doc_id",
        payload_value(F.col("a"), "__id__").alias("id_wins"),
        payload_value(F.col("b"), "__id__").alias("field_wins"),
        payload_value(F.col("b"), "n", "bigint").alias("n"),
    )


def f16_with_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = staging.table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 3
    text = F.when(k == 0, F.lit("")).when(k == 1, F.col("text"))
    staged = docs.select("doc_id", pl.with_document(_fields(docs), "document", text).alias("f"))
    return staged.select(
        "doc_id",
        F.map_contains_key("f", "document").alias("has_document"),
        F.coalesce(F.try_element_at(F.col("f"), F.lit("document")).cast("string"), F.lit("")).alias("document"),
    )


def f17_merge_named_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = staging.table(spark, sf_dir, "embeddings")
    base = vec.named({"a": vec.dense(F.col("embedding")), "b": vec.dense(F.col("embedding"))})
    over = vec.named({"b": vec.dense(F.reverse("embedding")), "c": F.when(F.col("vec_id") % 2 == 0, vec.dense(F.slice("embedding", 1, 4)))})
    merged = emb.select("vec_id", vec.merge_named(base, F.when(F.col("vec_id") % 5 != 0, over)).alias("v"))
    return merged.select(
        "vec_id",
        F.array_join(F.array_sort(F.map_keys("v")), ",").alias("names"),
        vector_checksum(F.col("v")["a"]["data"]).alias("a_sum"),
        vector_checksum(F.col("v")["b"]["data"]).alias("b_sum"),
    )


F17_SQL = f"""
SELECT vec_id, CASE WHEN vec_id % 5 <> 0 AND vec_id % 2 = 0 THEN 'a,b,c' ELSE 'a,b' END AS names,
       {sql.checksum('embedding')} AS a_sum,
       CASE WHEN vec_id % 5 <> 0 THEN {sql.checksum('list_reverse(embedding)')} ELSE {sql.checksum('embedding')} END AS b_sum
FROM embeddings
"""


def f18_typed_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Narrow whole numbers widen; a JSON column must be an object, others are set aside."""
    part = staging.table(spark, sf_dir, "part")
    meta = F.when(F.col("p_partkey") % 4 == 0, F.lit("[1]")).otherwise(F.to_json(F.struct(F.col("p_size").alias("size"))))
    raw = part.select(
        "p_partkey",
        (F.col("p_size") % 100).cast("tinyint").alias("tiny"),
        F.col("p_size").cast("smallint").alias("small"),
        F.col("p_size").alias("whole"),
        F.col("p_retailprice").cast("float").alias("single"),
        meta.alias("meta"),
    )
    points = src.normalize_milvus(raw, pk="p_partkey", json_columns=["meta"], mode="quarantine")
    p = F.col("payload")
    return points.select(
        F.col("id.num").cast("string").alias("point_id"),
        F.coalesce("reject_reason", F.lit("none")).alias("reject_reason"),
        payload_kind(p, "tiny").alias("tiny_kind"),
        payload_kind(p, "small").alias("small_kind"),
        payload_kind(p, "single").alias("single_kind"),
        payload_value(p, "single", "double").alias("single"),
        payload_kind(p, "meta").alias("meta_kind"),
    )


F18_SQL = """
SELECT p_partkey::VARCHAR AS point_id, CASE WHEN p_partkey % 4 = 0 THEN 'JSON column is not an object' ELSE 'none' END AS reject_reason,
       'bigint' AS tiny_kind, 'bigint' AS small_kind, 'double' AS single_kind, p_retailprice::FLOAT::DOUBLE AS single,
       CASE WHEN p_partkey % 4 = 0 THEN 'void' ELSE 'object' END AS meta_kind
FROM part
"""


def f19_clone_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = staging.table(spark, sf_dir, "embeddings")
    one = F.struct(F.col("embedding").alias("data"), F.array(F.lit(4294967295), F.lit(7)).alias("indices"), F.lit(2).alias("vectors_count"))
    raw = F.when(F.col("vec_id") % 4 != 0, F.create_map(F.lit(""), one)).cast(VECTORS_TYPE)
    copied = emb.select("vec_id", vec.clone_vectors(raw).alias("v"))
    v = F.try_element_at(F.col("v"), F.lit(""))
    return copied.select(
        "vec_id",
        F.col("v").isNull().alias("absent"),
        F.coalesce(vector_checksum(v["data"]), F.lit(0)).alias("sum"),
        F.coalesce(v["indices"][0], F.lit(-1)).alias("first_index"),
        F.coalesce(v["vectors_count"], F.lit(-1)).cast("bigint").alias("vectors_count"),
    )


F19_SQL = f"""
SELECT vec_id, vec_id % 4 = 0 AS absent, CASE WHEN vec_id % 4 <> 0 THEN {sql.checksum('embedding')} ELSE 0 END AS sum,
       CASE WHEN vec_id % 4 <> 0 THEN 4294967295 ELSE -1 END::BIGINT AS first_index,
       CASE WHEN vec_id % 4 <> 0 THEN 2 ELSE -1 END::BIGINT AS vectors_count
FROM embeddings
"""


def f20_required_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that lack an id, a vector or a body, counted by reason, over two sources."""
    hits = staging.elasticsearch_raw(spark, sf_dir)
    n = F.length("_id")
    broken = hits.select(
        F.when(n % 4 != 0, F.col("_id")).alias("_id"),
        F.when(n % 3 != 0, F.col("_source")).otherwise(F.lit("[]")).alias("_source"),
        "fields",
    )
    search = src.normalize_elasticsearch(broken, mode="quarantine").select(F.lit("elasticsearch").alias("source"), "reject_reason")
    objects = staging.weaviate_raw(spark, sf_dir)
    # The last digit of the id is a hash digit, so this cuts the objects without a pattern.
    digit = F.substr("id", F.lit(36), F.lit(1))
    bad = objects.withColumn(
        "vector",
        F.when(digit < "4", None).when(digit < "8", F.concat("vector", F.array(F.lit(None).cast("double")))).otherwise(F.col("vector")),
    )
    classes = src.normalize_weaviate(bad, mode="quarantine").select(F.lit("weaviate").alias("source"), "reject_reason")
    every = search.unionByName(classes)
    return every.groupBy("source", F.coalesce("reject_reason", F.lit("none")).alias("reject_reason")).agg(F.count(F.lit(1)).alias("n_rows"))


F20_SQL = f"""
WITH h AS (SELECT length(conv_id::VARCHAR || '/' || turn::VARCHAR) AS n FROM conversations),
a AS (SELECT 'elasticsearch' AS source, CASE WHEN n % 3 = 0 THEN 'the hit''s _source is no JSON object' WHEN n % 4 = 0 THEN 'the hit has no _id' ELSE 'none' END AS reject_reason FROM h),
w AS (SELECT right({sql.uuid5("'part-' || p_partkey::VARCHAR")}, 1) AS d FROM part),
b AS (SELECT 'weaviate' AS source, CASE WHEN d < '4' THEN 'the object has no vector' WHEN d < '8' THEN 'the object''s vector has an empty place' ELSE 'none' END AS reject_reason FROM w)
SELECT source, reject_reason, count(*) AS n_rows FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY ALL
"""

ENTRIES = {
    "f01_to_point_uuid": (f01_to_point_uuid, f"SELECT doc_id, {sql.uuid5('text')} AS point_uuid FROM documents"),
    "f02_is_uuid": (f02_is_uuid, F02_SQL),
    "f03_float_keys": (f03_float_keys, F03_FLOAT_SQL),
    "f03_key_to_string": (f03_key_to_string, F03_SQL),
    "f04_make_point_id": (
        f04_make_point_id,
        "SELECT c_custkey, c_custkey::VARCHAR AS number_num, true AS number_has_no_uuid, c_name AS text_uuid, true AS text_has_no_num FROM customer",
    ),
    "f04b_objectid_text": (
        f04b_objectid_text,
        f"""WITH t AS (SELECT page_id, 'ObjectID("' || md5(url)[1:24] || '")' AS id_text FROM pages)
            SELECT page_id, id_text, {sql.uuid5('id_text')} AS point_uuid FROM t""",
    ),
    "f04c_offset_key": (
        f04c_offset_key,
        f"SELECT c_custkey, {_RANGE_NAME} AS name, {sql.uuid5(_RANGE_NAME)} AS record_id FROM customer",
    ),
    "f05_bytes_to_floats": (
        f05_bytes_to_floats,
        f"SELECT vec_id, (4 * len(embedding) + vec_id % 4)::BIGINT AS n_bytes, len(embedding)::BIGINT AS dim, {sql.checksum('embedding')} AS sum FROM embeddings",
    ),
    "f06_es_as_vector": (_as_vector("nonempty"), _as_vector_sql("0, 1, 2")),
    "f06_os_as_vector": (_as_vector("or_empty"), _as_vector_sql("0, 1, 2, 3")),
    "f06_mongo_as_vector": (_as_vector("doubles"), _as_vector_sql("0, 3")),
    "f07_narrow": (
        f07_narrow,
        "SELECT l_orderkey, l_linenumber, l_extendedprice::FLOAT::DOUBLE AS price, l_tax::FLOAT::DOUBLE AS tax, l_quantity > 0 AS overflows FROM lineitem",
    ),
    "f08_sparse_vector": (f08_sparse_vector, F08_SQL),
    "f09_split_vectors_payload": (f09_split_vectors_payload, F09_SQL),
    "f10_sanitize": (f10_sanitize, F10_SQL),
    "f10b_rfc3339": (
        f10b_rfc3339,
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS plain, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS zoned FROM events",
    ),
    "f11_typed_numbers": (_number_kinds(numbers.typed_numbers), _number_sql("bigint")),
    "f12_numbers_to_double": (_number_kinds(numbers.numbers_to_double), _number_sql("double")),
    "f13_relaxed_extjson": (
        f13_relaxed_extjson,
        """SELECT event_id, md5(event_id::VARCHAR)[1:24] AS oid, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at, 'AQI=' AS blob,
                  user_id::DOUBLE AS n, 'double' AS n_kind FROM events""",
    ),
    "f14_parse_numeric_or_text": (f14_parse_numeric_or_text, F14_SQL),
    "f15_with_id_field": (
        f15_with_id_field,
        """SELECT doc_id, 'd' || doc_id::VARCHAR AS id_wins, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'd' || doc_id::VARCHAR END AS field_wins,
                  n_chars AS n FROM documents""",
    ),
    "f16_with_document": (
        f16_with_document,
        """SELECT doc_id, doc_id % 3 = 1 AND text <> '' AS has_document, CASE WHEN doc_id % 3 = 1 THEN text ELSE '' END AS document
           FROM documents""",
    ),
    "f17_merge_named_vectors": (f17_merge_named_vectors, F17_SQL),
    "f18_typed_extraction": (f18_typed_extraction, F18_SQL),
    "f19_clone_vectors": (f19_clone_vectors, F19_SQL),
    "f20_required_checks": (f20_required_checks, F20_SQL),
}
