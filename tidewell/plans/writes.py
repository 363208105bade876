"""Writes: modes, mapping, load options, streams; each query reads back what it has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import load, read, write
from tidewell.functions import codec
from tidewell.plans.tables import scratch, table
from tidewell.sources.catalog import FallbackCatalog
from tidewell.sources.files import Files


class Bench:
    """One scratch table."""

    def __init__(self, spark: SparkSession, name: str = "t") -> None:
        self.spark = spark
        self.options = {"dbtable": name, "warehouse_dir": scratch(spark), "keep_column_case": "on"}

    def put(self, df: DataFrame, mode: str = "overwrite", **more: object) -> Bench:
        write(df).options(**self.options | more).mode(mode).save()
        return self

    def get(self) -> DataFrame:
        return read(self.spark).options(**self.options).load()


def write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return Bench(spark).put(n.where("n_nationkey < 10"), "append").put(n.where("n_nationkey >= 5"), "append").get()


def overwritten(staging: str, truncate: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        n = table(spark, sf_dir, "nation")
        return Bench(spark).put(n).put(n.where("n_regionkey = 1"), usestagingtable=staging, truncate_table=truncate).get()

    return run


def write_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return Bench(spark).put(n.limit(0), "error").put(n, "ignore").put(n.where("n_nationkey = 3"), "append").get()


def write_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, b = table(spark, sf_dir, "nation"), Bench(spark)
    b.put(n)
    write(n.where("n_regionkey = 0")).options(**b.options).insert()
    write(n.where("n_regionkey = 2")).options(**b.options).insert(overwrite=True)
    return b.get()


def write_self_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table is overwritten with what is read from it."""
    b = Bench(spark).put(table(spark, sf_dir, "nation"))
    return b.put(b.get().where("n_regionkey < 3")).get()


def write_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Bench(spark).put(table(spark, sf_dir, "nation").where("false")).get()


def target(spark: SparkSession, sf_dir: str) -> Bench:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return Bench(spark).put(c.where("false"))


def write_columnmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("label"), "c_acctbal")
    return target(spark, sf_dir).put(rows, "append", columnmap="Map(id -> c_custkey, label -> c_name)").get()


def write_map_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_nationkey", F.col("c_name").alias("C_NAME"), "c_custkey")
    return target(spark, sf_dir).put(rows, "append", column_mapping="name").get()


def write_map_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return target(spark, sf_dir).put(rows, "append", column_mapping="name", column_mismatch_behavior="ignore").get()


def write_map_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("x"), F.col("c_name").alias("y"), F.col("c_nationkey").alias("z"))
    return target(spark, sf_dir).put(rows, "append").get()


def write_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("\t  "), "n_name", F.lit(" \n ")).alias("n_name"))
    return Bench(spark).put(rows, trim_space="on").get()


def copy_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("n_name", metadata={"maxlength": 4}))
    return Bench(spark).put(rows, truncate_columns="on").get()


def write_trim_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("\t  <"), "text", F.lit("> \n ")).alias("text"))
    return Bench(spark).put(rows, trim_space="on").get()


def copy_truncate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("text", metadata={"maxlength": 40}))
    return Bench(spark).put(rows, truncate_columns="on").get()


def copied(*calls: dict[str, object]):
    """Nations are staged as three files of a format each, and loaded by one call after another."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        n, b = table(spark, sf_dir, "nation"), Bench(spark)
        stage = scratch(spark)
        parts = [n.where(F.col("n_regionkey") % 3 == k).coalesce(1) for k in range(3)]
        codec.write_csv(parts[0], f"{stage}/a")
        codec.write_json(parts[1], f"{stage}/b")
        parts[2].write.parquet(f"{stage}/c")
        names = [f.name for f in Files(spark, stage).tree() if "/part-" in f.name]
        b.put(n.where("false"))
        for call in calls:
            more = {k: ",".join(x for x in names if x[0] in v) if k == "files" else v for k, v in call.items()}
            load(spark).options(**b.options | {"stage_dir": stage} | more).load()
        return b.get()

    return run


def write_string_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    text = events.select("event_id", F.date_format("ts", "yyyy/MM/dd HH:mm:ss").alias("ts"))
    return Bench(spark).put(events.select("event_id", "ts").where("false")).put(text, "append", string_timestamp_format="YYYY/MM/DD HH24:MI:SS").get()


def copy_on_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh JSON text is broken; such rows are left out."""
    events = table(spark, sf_dir, "events")
    typed = events.select("event_id", F.parse_json("props").alias("v")).where("false")
    text = events.select("event_id", F.when(F.col("event_id") % 7 == 0, "{broken").otherwise(F.col("props")).alias("v"))
    got = Bench(spark).put(typed).put(text, "append", continue_on_error="on").get()
    return got.select("event_id", F.variant_get("v", "$.k", "long").alias("k"))


def catalog_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Bench(spark, "nation").put(table(spark, sf_dir, "nation"))

    def refuse(name: str) -> DataFrame:
        raise RuntimeError("HTTP 403 Forbidden")

    return FallbackCatalog(spark, refuse, lambda name: read(spark).options(**b.options | {"dbtable": name}).load()).load("nation")


def stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of files, appended batch by batch, each once."""
    from tidewell.streaming.append import append_batch, stream_to

    home = scratch(spark)
    rows = table(spark, sf_dir, "nation")
    rows.write.parquet(f"{home}/in")
    options = {"dbtable": "t", "warehouse_dir": f"{home}/store", "keep_column_case": "on"}
    stream = spark.readStream.schema(rows.schema).parquet(f"{home}/in")
    stream_to(stream, "s", **options).option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start().awaitTermination()
    append_batch(rows, 0, "s", options)  # again: no change
    return read(spark).options(**options).load()


QUERIES = {
    "copy_files": copied({"files": "ac"}, {"files": "c"}, {}),  # files are loaded once
    "copy_force": copied({}, {"files": "b", "force": "on"}),
    "copy_purge": copied({"purge": "on", "files": "ab"}, {"force": "on"}),  # what is purged can't be loaded again
    "write_overwrite": overwritten("on", "off"),
    "write_overwrite_truncate_staged": overwritten("on", "on"),
    "write_overwrite_direct": overwritten("off", "off"),
    "write_overwrite_truncate": overwritten("off", "on"),
} | {
    f.__name__: f
    for f in (
        write_append, write_ignore, write_insert, write_self_overwrite, write_empty, write_columnmap, write_map_by_name, write_map_ignore, write_map_order, write_trim,
        copy_truncate, write_trim_documents, copy_truncate_documents, write_string_ts, copy_on_error, catalog_fallback, stream_append,
    )
}
ORACLES = dict.fromkeys(("write_overwrite", "write_overwrite_truncate_staged", "write_overwrite_direct", "write_overwrite_truncate"), "SELECT * FROM nation WHERE n_regionkey = 1") | {
    "copy_files": "SELECT * FROM nation",
    "copy_force": "SELECT * FROM nation UNION ALL SELECT * FROM nation WHERE n_regionkey % 3 = 1",
    "copy_purge": "SELECT * FROM nation",
    "write_append": "SELECT * FROM nation WHERE n_nationkey < 10 UNION ALL SELECT * FROM nation WHERE n_nationkey >= 5",
    "write_ignore": "SELECT * FROM nation WHERE n_nationkey = 3",
    "write_insert": "SELECT * FROM nation WHERE n_regionkey = 2",
    "write_self_overwrite": "SELECT * FROM nation WHERE n_regionkey < 3",
    "write_empty": "SELECT * FROM nation WHERE false",
    "write_columnmap": "SELECT c_custkey, c_name, NULL::INTEGER AS c_nationkey FROM customer",
    "write_map_by_name": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "write_map_ignore": "SELECT c_custkey, NULL::VARCHAR AS c_name, NULL::INTEGER AS c_nationkey FROM customer",
    "write_map_order": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "write_trim": "SELECT n_nationkey, n_name FROM nation",
    "copy_truncate": "SELECT n_nationkey, substring(n_name, 1, 4) AS n_name FROM nation",
    "write_trim_documents": "SELECT doc_id, '<' || text || '>' AS text FROM documents",
    "copy_truncate_documents": "SELECT doc_id, substring(text, 1, 40) AS text FROM documents",
    "write_string_ts": "SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS ts FROM events",
    "copy_on_error": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events WHERE event_id % 7 <> 0",
    "catalog_fallback": "SELECT * FROM nation",
    "stream_append": "SELECT * FROM nation",
}
