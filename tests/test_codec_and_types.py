import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import codec, types, variant


def test_definitions():
    s = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType(), True, {"maxlength": 5}), T.StructField("c", T.DecimalType(10, 2)), T.StructField("d", T.ArrayType(T.IntegerType()))])
    assert types.definitions(s) == '"a" INTEGER NOT NULL, "b" VARCHAR(5), "c" DECIMAL(10,2), "d" VARIANT'
    for bad in (T.NullType(), T.DayTimeIntervalType(), T.MapType(T.IntegerType(), T.StringType())):
        with pytest.raises(types.UnsupportedType):
            types.definition(T.StructField("x", bad))


def test_clamped_decimal():
    assert types.clamped_decimal(0, 0) == T.DecimalType(38, 18)
    assert types.clamped_decimal(10, 2) == T.DecimalType(10, 2)
    assert types.clamped_decimal(40, 10) == T.DecimalType(38, 8)
    with pytest.raises(types.UnsupportedType):
        types.clamped_decimal(50, 3)


def test_formats():
    plain, nested = T.StructType([T.StructField("a", T.LongType())]), T.StructType([T.StructField("a", T.VariantType())])
    marked = T.StructType([T.StructField("a b", T.VariantType())])
    assert (codec.unload_format(plain), codec.unload_format(nested), codec.unload_format(marked)) == ("csv", "json", "csv")
    assert codec.write_format(plain) == "csv" and codec.write_format(nested) == "parquet"
    assert codec.write_format(nested, json_for_nested=True) == "json" and codec.write_format(plain, parquet=True) == "parquet"
    assert codec.translate_format("YYYY-MM-DD HH24:MI:SS.FF3 TZHTZM") == "yyyy-MM-dd HH:mm:ss.SSS XX"


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'a|b"c\nd', b"\x00\x01", dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5, 123456), True, 1.5), (2, "", None, None, None, None, float("nan")), (3, None, b"", dt.date(1, 1, 1), None, False, float("inf"))]
    df = spark.createDataFrame(rows, "i int, s string, b binary, d date, t timestamp_ntz, f boolean, x double")
    codec.write_csv(df, str(tmp_path / "c"))
    got = {r.i: r for r in codec.read_csv(spark, str(tmp_path / "c"), df.schema).collect()}
    assert got[1].s == 'a|b"c\nd' and bytes(got[1].b) == b"\x00\x01" and got[1].t == dt.datetime(2020, 1, 2, 3, 4, 5, 123000)
    assert got[2].s is None and got[2].f is None and str(got[2].x) == "nan"
    assert got[3].f is False and got[3].d == dt.date(1, 1, 1) and got[3].x == float("inf")


def test_bad_boolean_text_is_an_error(spark):
    df = spark.createDataFrame([("yes",)], "f string").select(codec.from_text(T.StructField("f", T.BooleanType())))
    with pytest.raises(Exception, match="neither true nor false"):
        df.collect()


def test_not_null_column_reads_empty(spark):
    df = spark.createDataFrame([(None,)], "s string").select(codec.from_text(T.StructField("s", T.StringType(), False)).alias("s"))
    assert df.first().s == ""


def test_timestamp_prefix_parse(spark):
    texts = ["+0200 2020-01-02 03:04:05.678901234", "2020-01-02 03:04:05.678 +0100", "Z 2020-01-02 03:04:05.678000000"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = [r[0] for r in df.select(codec.parse_timestamp(F.col("c"), False)).collect()]
    assert got == [dt.datetime(2020, 1, 2, 1, 4, 5, 678000), dt.datetime(2020, 1, 2, 3, 4, 5, 678000), dt.datetime(2020, 1, 2, 3, 4, 5, 678000)]


def test_trim_is_null_safe(spark):
    got = spark.createDataFrame([("\t a b \x00",), (None,)], "s string").transform(codec.trim_strings).collect()
    assert [r.s for r in got] == ["a b", None]


def test_variant_rules(spark):
    df = spark.createDataFrame([(" ",), ("null",), ('"{\\"k\\":1}"',), ('"x"',), ('{"k":2}',)], "s string")
    got = df.select(variant.materialise(F.col("s")).alias("v")).select(F.col("v").isNull(), F.is_variant_null("v"), F.try_variant_get("v", "$.k", "int"), F.to_json("v")).collect()
    assert [r[0] for r in got] == [True, False, False, False, False]
    assert got[1][1] is True and got[2][2] == 1 and got[3][3] == '"x"' and got[4][2] == 2
    with pytest.raises(Exception, match="blank text"):
        df.select(F.to_json(variant.materialise(F.col("s"), nullable=False))).collect()


def test_user_schema_decodes_json_text(spark):
    df = spark.createDataFrame([('{"a":[1,2]}', "7")], "j string, n string")
    got = types.with_schema(df, T.StructType.fromDDL("n int, j struct<a:array<int>>")).first()
    assert got.n == 7 and got.j.a == [1, 2]
    with pytest.raises(ValueError):
        types.with_schema(df, T.StructType.fromDDL("zz int"))


def test_decimal_as_long_overflow_is_an_error(spark):
    df = spark.sql("select cast('99999999999999999999' as decimal(38,0)) as d")
    with pytest.raises(Exception, match="(?i)overflow|out of range"):
        types.decimals_as_long(df).collect()
