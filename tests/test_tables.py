import json

import pytest
from pyspark.sql import functions as F

from tidewell import load, read, runtime, write
from tidewell.functions import codec
from tidewell.operators.mapping import MappingError
from tidewell.options import OptionError
from tidewell.sources.catalog import FallbackCatalog, denied, stored_tables
from tidewell.sources.files import Files
from tidewell.sources.loader import MissingFile
from tidewell.sources.reader import drop_stage
from tidewell.sources.store import Conflict, Manifest, NoTable, RowsLost, Store, TableExists
from tidewell.streaming.append import append_batch


def put(df, home, mode="overwrite", name="t", **options):
    return write(df).options(dbtable=name, warehouse_dir=home, **options).mode(mode).save()


def got(spark, home, name="t", **options):
    return read(spark).options(dbtable=name, warehouse_dir=home, **options).load()


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_modes(spark, home):
    assert put(spark.range(3), home, "error") == 3
    with pytest.raises(TableExists):
        put(spark.range(3), home, "error")
    assert put(spark.range(9), home, "ignore") == 0
    assert put(spark.range(3, 5), home, "append") == 2
    assert ids(got(spark, home)) == [0, 1, 2, 3, 4]
    assert put(spark.range(2), home) == 2
    assert ids(got(spark, home)) == [0, 1]
    with pytest.raises(OptionError):
        write(spark.range(1)).mode("odd")
    with pytest.raises(OptionError):
        write(spark.range(1)).options(query="select 1").mode("append").save()
    with pytest.raises(NoTable):
        got(spark, home, "other")


@pytest.mark.parametrize("staging", ["on", "off"])
@pytest.mark.parametrize("truncate", ["on", "off"])
@pytest.mark.parametrize("step", ["before_write", "after_write", "before_post_actions", "before_commit"])
@pytest.mark.parametrize("there", [True, False])
def test_a_failed_overwrite_changes_nothing(spark, home, staging, truncate, step, there):
    if there:
        put(spark.range(4), home)
    with runtime.fail_at(step), pytest.raises(runtime.InjectedFailure):
        put(spark.range(2).withColumn("x", F.lit(1)) if truncate == "off" else spark.range(2), home, usestagingtable=staging, truncate_table=truncate)
    store = Store(spark, home)
    assert (store.manifest("PUBLIC/T") is not None) is there
    if there:
        assert ids(got(spark, home)) == [0, 1, 2, 3]
        assert store.vacuum("PUBLIC/T", older_than=0) == []


def test_overwrite_schemas(spark, home):
    put(spark.range(2), home)
    put(spark.range(2).select(F.col("id").cast("int").alias("other")), home, truncate_table="on")
    assert got(spark, home).dtypes == [("ID", "bigint")]
    put(spark.range(2).select(F.col("id").cast("int").alias("other")), home)
    assert got(spark, home).dtypes == [("OTHER", "int")]


def test_empty_frames(spark, home):
    none = spark.range(0)
    put(none, home, "append")
    assert got(spark, home).count() == 0 and got(spark, home).columns == ["ID"]
    put(spark.range(3), home)
    put(none, home, "append")
    assert got(spark, home).count() == 3
    put(none, home, internal_skip_write_when_writing_empty_dataframe="true")
    assert got(spark, home).count() == 3
    put(none, home)
    assert got(spark, home).count() == 0


def test_old_plans_stay_valid_and_vacuum(spark, home):
    put(spark.range(3), home)
    before = got(spark, home)
    put(before.where("ID > 0"), home, truncate_table="on")
    assert ids(before) == [0, 1, 2] and ids(got(spark, home)) == [1, 2]
    assert Store(spark, home).vacuum("PUBLIC/T") == []  # too young
    assert len(Store(spark, home).vacuum("PUBLIC/T", older_than=0)) == 1
    assert ids(got(spark, home)) == [1, 2]


def test_mapping(spark, home):
    put(spark.createDataFrame([], "one int, two string"), home)
    rows = spark.createDataFrame([("x", 1, True)], "b string, a int, c boolean")
    put(rows, home, "append", columnmap="Map(a -> one, b -> two)")
    assert [tuple(r) for r in got(spark, home).collect()] == [(1, "x")]
    with pytest.raises(MappingError):
        put(rows, home, "append")
    with pytest.raises(MappingError):
        put(rows, home, "append", column_mapping="name")
    put(rows.toDF("Two", "x", "y"), home, "append", column_mapping="name", column_mismatch_behavior="ignore")
    assert got(spark, home).where("ONE is null").first()["TWO"] == "x"
    with pytest.raises(OptionError):
        put(rows, home, columnmap="Map(a -> one)")


def test_names_and_case(spark, home):
    put(spark.createDataFrame([(1, 2)], "foo int, `a b` int"), home)
    assert got(spark, home).columns == ["FOO", '"a b"']
    assert got(spark, home, keep_column_case="on").columns == ["FOO", "a b"]
    put(spark.range(1).toDF("foo"), home, keep_column_case="on", name="u")
    assert got(spark, home, "u").columns == ['"foo"'] and got(spark, home, "u", keep_column_case="on").columns == ["foo"]


def test_load_options(spark, home):
    text = spark.createDataFrame([(1, "  abcdef "), (2, None)], "i int, s string")
    limited = text.withColumn("s", F.col("s").alias("s", metadata={"maxlength": 4}))
    with pytest.raises(Exception, match="longer than 4"):
        put(limited, home)
    put(limited, home, truncate_columns="on", trim_space="on")
    assert sorted(str(r.S) for r in got(spark, home).collect()) == ["None", "ab"]
    put(spark.createDataFrame([], "i int, v variant"), home, name="v")
    bad = spark.createDataFrame([(1, '{"k":1}'), (2, "{no"), (3, None)], "i int, v string")
    with pytest.raises(Exception, match="(?i)malformed"):
        put(bad, home, "append", name="v")
    assert put(bad, home, "append", name="v", continue_on_error="on") == 2


def test_actions(spark, home):
    put(spark.range(1), home, preactions="CREATE OR REPLACE TEMPORARY VIEW made AS SELECT 5 AS x; ", postactions="DROP VIEW IF EXISTS absent_%s")
    assert spark.table("made").first().x == 5
    with pytest.raises(runtime.ActionError):
        put(spark.range(1), home, preactions="DELETE FROM x")
    assert runtime.statements("a %s; b", "t") == ["a t", "b"]


def test_a_failing_post_action_undoes_the_write(spark, home):
    put(spark.range(3), home)
    with pytest.raises(Exception, match="(?i)no_such"):
        put(spark.range(9), home, postactions="CREATE TEMPORARY VIEW v AS SELECT * FROM no_such_table")
    assert ids(got(spark, home)) == [0, 1, 2]


def test_vacuum_beside_a_write(spark, home):
    """One writer has filled its folder when another cleans up; even a careless clean-up is noticed."""
    put(spark.range(3), home)
    store = Store(spark, home)
    version, n = store.write_version("PUBLIC/T", spark.range(3, 5).toDF("ID"))
    put(spark.range(7, 8), home, "append", purge="on")
    assert store.vacuum("PUBLIC/T") == []
    store.append("PUBLIC/T", version, n)
    assert ids(got(spark, home)) == [0, 1, 2, 3, 4, 7]
    version, n = store.write_version("PUBLIC/T", spark.range(9, 10).toDF("ID"))
    assert store.vacuum("PUBLIC/T", older_than=0) == [version]
    with pytest.raises(Conflict):
        store.append("PUBLIC/T", version, n)
    assert ids(got(spark, home)) == [0, 1, 2, 3, 4, 7]


def test_two_writers_of_one_manifest(spark, home):
    from concurrent.futures import ThreadPoolExecutor

    files = Store(spark, home).files
    files.make("PUBLIC/T")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda k: files.put_new("PUBLIC/T/_manifest.1.json", f"writer {k}"), range(24)))
    assert sum(won) == 1 and files.text("PUBLIC/T/_manifest.1.json") == f"writer {won.index(True)}"
    assert not any(n.endswith(".tmp") for n in files.names("PUBLIC/T"))


def test_rows_are_checked(spark, home):
    put(spark.range(100).repartition(4), home)
    store = Store(spark, home)
    assert store.verify("PUBLIC/T") == got(spark, home, verify_rows="on").count() == 100
    version = store.manifest("PUBLIC/T").versions[0]
    lost = next(n for n in store.files.names(f"PUBLIC/T/{version}") if n.startswith("part-"))
    store.files.delete(f"PUBLIC/T/{version}/{lost}")
    with pytest.raises(RowsLost):
        got(spark, home, verify_rows="on")


def stage_of(spark, home):
    stage = f"{home}-in"
    codec.write_csv(spark.createDataFrame([(1, "a|b"), (2, 'q"\nx')], "i int, s string").coalesce(1), f"{stage}/one")
    codec.write_json(spark.createDataFrame([(3, "c")], "I int, S string").coalesce(1), f"{stage}/two")
    spark.createDataFrame([("d", 4)], "S string, I int").coalesce(1).write.parquet(f"{stage}/three")
    return stage, {n.split("/")[0]: n for n in (f.name for f in Files(spark, stage).tree()) if "/part-" in n}


def test_loads_of_staged_files(spark, home):
    stage, names = stage_of(spark, home)
    put(spark.createDataFrame([], "i int, s string"), home)
    make = lambda **more: load(spark).options(dbtable="t", warehouse_dir=home, stage_dir=stage, **more).load()
    first = make(files=names["one"])
    assert (first.rows, first.files, first.skipped) == (2, (names["one"],), ())
    rest = make()
    assert rest.rows == 2 and set(rest.files) == {names["two"], names["three"]} and rest.skipped == (names["one"],)
    assert make().rows == 0
    assert make(force="on", files=f"{names['two']}, {names['two']}").rows == 1
    assert sorted((r.I, r.S) for r in got(spark, home).collect()) == [(1, "a|b"), (2, 'q"\nx'), (3, "c"), (3, "c"), (4, "d")]
    with pytest.raises(MissingFile):
        make(files="one/absent.csv")
    with pytest.raises(NoTable):
        load(spark).options(dbtable="other", warehouse_dir=home, stage_dir=stage).load()
    codec.write_json(spark.createDataFrame([(5, "e")], "I int, S string").coalesce(1), f"{stage}/four")
    assert make(purge="on").rows == 1  # only what it has taken goes
    assert {f.name.split("/")[0] for f in Files(spark, stage).tree() if "/part-" in f.name} == {"one", "two", "three"}


def test_a_failed_load_keeps_its_files(spark, home):
    stage, _ = stage_of(spark, home)
    put(spark.createDataFrame([], "i int, s string"), home)
    with runtime.fail_at("before_commit"), pytest.raises(runtime.InjectedFailure):
        load(spark).options(dbtable="t", warehouse_dir=home, stage_dir=stage, purge="on").load()
    assert got(spark, home).count() == 0
    assert load(spark).options(dbtable="t", warehouse_dir=home, stage_dir=stage, purge="on").load().rows == 4
    assert not any("/part-" in f.name for f in Files(spark, stage).tree())


def test_bad_rows_of_staged_text(spark, home):
    stage = f"{home}-in"
    codec.write_csv(spark.createDataFrame([("1", "x"), ("one", "y"), (None, "z")], "i string, s string").coalesce(1), f"{stage}/a")
    put(spark.createDataFrame([], "i int, s string"), home)
    with pytest.raises(Exception, match="(?i)cast"):
        load(spark).options(dbtable="t", warehouse_dir=home, stage_dir=stage).load()
    assert load(spark).options(dbtable="t", warehouse_dir=home, stage_dir=stage, continue_on_error="on").load().rows == 2


def test_partition_and_file_sizes(spark, home):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")}
    wide = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("s")).coalesce(1)
    put(wide, home)
    try:
        assert got(spark, home, partition_size_in_mb=100, expected_partition_count=1).rdd.getNumPartitions() == 1
        assert got(spark, home, partition_size_in_mb=1, expected_partition_count=1).rdd.getNumPartitions() >= 4
        assert got(spark, home, partition_size_in_mb=100, expected_partition_count=6).rdd.getNumPartitions() >= 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    for write_, form in ((codec.write_csv, "csv"), (codec.write_json, "json")):
        write_(wide, f"{home}-{form}", False, 1_000_000)
        files = [f for f in Files(spark, f"{home}-{form}").tree() if "part-" in f.name]
        assert len(files) >= 8 and max(f.size for f in files) < 1_200_000
    stage = f"{home}-stage"
    assert got(spark, home, use_copy_unload="on", stage_dir=stage, s3maxfilesize=1_000_000).count() == 60_000
    assert sum("part-" in f.name for f in Files(spark, stage).tree()) >= 8


def test_a_stage_can_be_dropped(spark, home):
    assert drop_stage(spark, home, "absent") is False
    spark.range(2).write.parquet(f"{home}/unload-x")
    assert drop_stage(spark, home, "unload-x") is True and not Files(spark, home).exists("unload-x")


def test_last_texts(spark, home):
    from tidewell.functions import predicates as P

    put(spark.range(3), home)
    assert runtime.last_load().startswith("COPY INTO t FROM v-")
    assert read(spark).options(dbtable="t", warehouse_dir=home).where(P.Compare("ID", ">", 1)).load().count() == 1
    assert runtime.last_select() == "SELECT ID FROM t WHERE ID > 1"


def test_time_zone_is_scoped(spark, home):
    put(spark.range(1), home, sftimezone="America/New_York")
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_secrets_are_redacted(spark, home):
    read(spark)
    pattern = spark.conf.get("spark.sql.redaction.options.regex")
    import re

    for name in ("sfPassword", "pem_private_key", "awsSecretKey", "sfToken"):
        assert re.search("(?i)" + pattern.replace("(?i)", ""), name)


def test_table_operations(spark, home):
    store = Store(spark, home)
    put(spark.range(3), home)
    store.like("PUBLIC/U", "PUBLIC/T")
    assert got(spark, home, "u").count() == 0
    store.rename("PUBLIC/U", "PUBLIC/W")
    assert stored_tables(spark, root=home) == ["T", "W"]
    store.truncate("PUBLIC/T")
    assert got(spark, home).count() == 0
    assert store.drop("PUBLIC/T") and not store.drop("PUBLIC/T")
    with pytest.raises(NoTable):
        got(spark, home)
    put(spark.range(1), home)
    assert got(spark, home).count() == 1
    with pytest.raises(TableExists):
        store.create("PUBLIC/T", spark.range(1).schema)


def test_conflicting_commits(spark, home):
    store = Store(spark, home)
    now = store.create("PUBLIC/T", spark.range(1).schema)
    new = Manifest(now.number + 1, now.schema)
    store.commit("PUBLIC/T", new)
    with pytest.raises(Conflict):
        store.commit("PUBLIC/T", new)


def test_staged_read_loses_empty_strings(spark, home):
    put(spark.createDataFrame([(1, ""), (2, "x|y")], "i int, s string"), home)
    direct, staged = got(spark, home), got(spark, home, use_copy_unload="on", stage_dir=f"{home}/stage")
    assert sorted((r.I, r.S) for r in direct.collect()) == [(1, ""), (2, "x|y")]
    assert {r.I: r.S for r in staged.collect()} == {1: None, 2: "x|y"}


def test_streamed_batches_count_once(spark, home):
    options = {"dbtable": "t", "warehouse_dir": home}
    append_batch(spark.range(3), 0, "s", options)
    append_batch(spark.range(3), 0, "s", options)
    append_batch(spark.range(3, 5), 1, "s", options)
    append_batch(spark.range(9), 0, "other", options)
    assert got(spark, home).count() == 14


def test_fallback_catalog(spark, home):
    put(spark.range(2), home)
    calls = []

    def refuse(name):
        calls.append(name)
        raise RuntimeError("status 403")

    def broken(name):
        raise KeyError(name)

    assert FallbackCatalog(spark, refuse, lambda n: got(spark, home)).load("t").count() == 2
    with pytest.raises(RuntimeError, match="403"):
        FallbackCatalog(spark, refuse, broken).load("a", "b")
    assert calls[-1] == "a.b"
    with pytest.raises(KeyError):
        FallbackCatalog(spark, broken, lambda n: got(spark, home)).load("t")
    assert FallbackCatalog(spark).exists("no_such_table") is False
    outer = ValueError("x")
    outer.__cause__ = PermissionError("no")
    assert denied(outer) and not denied(ValueError("404"))


def test_closed_jobs_refuse_reads_and_writes(spark, home, caplog):
    jobs = runtime.Jobs(spark, "tidewell-rw")
    with caplog.at_level("INFO", logger="tidewell.runtime"):
        assert write(spark.range(3)).options(dbtable="t", warehouse_dir=home).within(jobs).mode("append").save() == 3
        assert read(spark).options(dbtable="t", warehouse_dir=home).within(jobs).load().count() == 3
    assert [(s["kind"], s["rows"], s["status"]) for s in map(json.loads, caplog.messages)] == [("write", 3, "done"), ("read", None, "done")]
    jobs.close()
    with caplog.at_level("INFO", logger="tidewell.runtime"), pytest.raises(RuntimeError):
        write(spark.range(3)).options(dbtable="t", warehouse_dir=home).within(jobs).mode("append").save()
    last = json.loads(caplog.messages[-1])
    assert (last["what"], last["status"], last["error"]) == ("t", "failed", "RuntimeError")
    with pytest.raises(RuntimeError):
        read(spark).options(dbtable="t", warehouse_dir=home).within(jobs).load()
    assert got(spark, home).count() == 3


def test_queries_can_be_run_and_printed(spark, capfd):
    from tidewell.sources.catalog import print_query, run_query

    assert [r.x for r in run_query(spark, "select id + 1 as x from range(3);")] == [1, 2, 3]
    print_query(spark, "select 'shown' as x;")
    print_query(spark, "select id as x from range(40)", 5)


def test_jobs(spark):
    jobs = runtime.Jobs(spark, "tidewell-test")
    with jobs.running():
        assert "tidewell-test" in spark.getTags()
    jobs.close()
    with pytest.raises(RuntimeError), jobs.running():
        pass


def test_an_append_is_left_out_only_by_the_load_id_of_the_caller(spark, home, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/in")
    rows, stage = spark.read.parquet(f"{tmp_path}/in"), f"{home}-stage"
    assert put(rows.where("id < 4"), home, "append", stage_dir=stage) == 4
    assert put(rows.where("id >= 4"), home, "append", stage_dir=stage) == 6  # other rows of the same files
    assert put(spark.range(20, 22), home, "append", load_id="a") == 2
    assert put(spark.range(20, 22), home, "append", load_id="a") == 0
    assert put(spark.range(22, 23), home, "append", load_id="b") == 1
    assert put(spark.range(23, 24), home, "append", load_id="b", force="on") == 1
    assert ids(got(spark, home)) == [*range(10), *range(20, 24)]
    import hashlib

    assert hashlib.sha256(b"a").hexdigest() in Store(spark, home).manifest("PUBLIC/T").loaded  # of no session
