"""Staged text, JSON and Parquet, and semi-structured values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import codec, types, variant
from tidewell.plans.tables import scratch, table


def codec_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text")).alias("text"))
    path = f"{scratch(spark)}/csv"
    codec.write_csv(docs, path)
    return codec.read_csv(spark, path, docs.schema)


def codec_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.struct("user_id", "event_type").alias("s"), F.array("user_id", "event_id").alias("a"), F.encode("event_type", "UTF-8").alias("b"))
    path = f"{scratch(spark)}/json"
    codec.write_json(rows, path)
    back = codec.read_json(spark, path, rows.schema)
    return back.select("event_id", F.col("s.user_id").alias("user_id"), F.col("s.event_type").alias("kind"), F.col("a")[1].alias("second"), F.decode("b", "UTF-8").alias("text"))


def codec_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "value", F.parse_json("props").alias("v"), F.struct("user_id").alias("s"))
    path = f"{scratch(spark)}/parquet"
    rows.write.parquet(path)
    return spark.read.parquet(path).select("event_id", "ts", "value", F.variant_get("v", "$.k", "long").alias("k"), "s.user_id")


def codec_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    text = rows.select("event_id", codec.as_text(rows.schema["ts"]).alias("ts"))
    return text.select("event_id", codec.from_text(T.StructField("ts", T.TimestampNTZType())).alias("ts"))


def codec_timestamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps of another format in text."""
    text = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("t"))
    return text.select("event_id", F.to_timestamp_ntz("t", F.lit(codec.translate_format("DD/MM/YYYY HH24:MI:SS"))).alias("ts"))


def variant_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = variant.materialise(F.col("props"))
    return table(spark, sf_dir, "events").select("event_id", variant.get(v, "$.k", "long").alias("k"), variant.get(v, "$.none", "long").alias("none"))


def variant_construct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", variant.record(id=F.col("event_id"), kind=F.col("event_type")).alias("v"))
    return rows.select("event_id", F.to_json("v").alias("json"))


def variant_struct_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.to_json(F.struct(F.col("user_id").alias("u"), F.array("event_id", "user_id").alias("a"), F.create_map(F.lit("t"), F.col("event_type")).alias("m")))
    wanted = T.StructType.fromDDL("event_id bigint, s struct<u:bigint,a:array<bigint>,m:map<string,string>>")
    rows = types.with_schema(table(spark, sf_dir, "events").select("event_id", text.alias("s")), wanted)
    return rows.select("event_id", "s.u", F.col("s.a")[0].alias("first"), F.col("s.m")["t"].alias("t"))


def variant_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank text is null, the JSON text null is a value, a string with an object in it is unwrapped."""
    texts = F.element_at(F.array(F.lit(" "), F.lit("null"), F.lit('{"k":1}'), F.lit('"{\\"k\\":2}"'), F.lit('"plain"')), (F.col("event_id") % 5 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", variant.materialise(texts).alias("v"))
    return rows.select("event_id", F.col("v").isNull().alias("missing"), F.coalesce(F.is_variant_null("v"), F.lit(False)).alias("json_null"), variant.get(F.col("v"), "$.k", "long").alias("k"))


QUERIES = {
    f.__name__: f
    for f in (codec_csv_roundtrip, codec_json_roundtrip, codec_parquet_roundtrip, codec_timestamp, codec_timestamp_text, variant_get, variant_construct, variant_struct_decode, variant_nulls)
}
ORACLES = {
    "codec_csv_roundtrip": "SELECT doc_id, nullif(CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END, '') AS text FROM documents",
    "codec_json_roundtrip": "SELECT event_id, user_id, event_type AS kind, event_id AS second, event_type AS text FROM events",
    "codec_parquet_roundtrip": "SELECT event_id, ts, value, json_extract(props, '$.k')::BIGINT AS k, user_id FROM events",
    "codec_timestamp": "SELECT event_id, date_trunc('millisecond', ts)::TIMESTAMP AS ts FROM events",
    "codec_timestamp_text": "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS ts FROM events",
    "variant_get": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, NULL::BIGINT AS none FROM events",
    "variant_construct": "SELECT event_id, '{\"id\":' || event_id || ',\"kind\":\"' || event_type || '\"}' AS json FROM events",
    "variant_struct_decode": "SELECT event_id, user_id AS u, event_id AS first, event_type AS t FROM events",
    "variant_nulls": "SELECT event_id, event_id % 5 = 0 AS missing, event_id % 5 = 1 AS json_null, CASE event_id % 5 WHEN 2 THEN 1 WHEN 3 THEN 2 END::BIGINT AS k FROM events",
}
