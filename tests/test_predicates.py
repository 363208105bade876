import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import predicates as P

SCHEMA = T.StructType()
for _name, _type in (("crate", T.IntegerType()), ("label", T.StringType()), ("net", T.DoubleType()), ("tare", T.FloatType()), ("sealed", T.BooleanType()), ("packed", T.DateType()), ("seen", T.TimestampType())):
    SCHEMA.add(_name, _type)


def squeezed(text):
    return text.replace(" ", "")


@pytest.mark.parametrize(
    ("predicate", "text"),
    [
        (P.Compare("label", "=", "d'Été 梨"), "label = 'd''Été 梨'"),
        (P.Compare("label", "=", r"C:\pears"), r"label = 'C:\\pears'"),
        (P.Compare("crate", "<=", -12), "crate <= -12"),
        (P.Compare("net", ">", 0.125), "net > 0.125"),
        (P.Compare("sealed", "=", False), "sealed = false"),
        (P.In("crate", (11, 5)), "( crate IN ( 11 , 5 ))"),
        (P.Text("label", "starts", "pe"), "STARTSWITH( label , 'pe' )"),
        (P.Text("label", "ends", "'"), "ENDSWITH( label , '''' )"),
        (P.Text("label", "contains", "%"), "CONTAINS( label , '%' )"),
        (P.Compare("packed", ">=", dt.date(1987, 12, 31)), "packed >= '1987-12-31'::DATE"),
        (P.Compare("seen", "<", dt.datetime(2031, 2, 28, 23, 59, 0, 40)), "seen < '2031-02-28 23:59:00.000040'::TIMESTAMP(6)"),
        (P.Null("tare"), "( tare IS NULL)"),
        (P.Null("tare", False), "( tare IS NOT NULL)"),
        (P.Not(P.Null("net")), "(NOT ( ( net IS NULL) ))"),
        (P.Both(P.Compare("crate", ">", 2), P.Compare("net", "<", 9.5)), "(( crate > 2 ) AND ( net < 9.5 ))"),
        (P.Either(P.Not(P.Compare("label", "=", "x")), P.In("crate", (1,))), "(( (NOT ( label = 'x' )) ) OR ( ( crate IN ( 1 )) ))"),
    ],
)
def test_text_of_each(predicate, text):
    assert squeezed(P.render(predicate, SCHEMA)) == squeezed(text)


def test_text_of_several():
    assert P.where([], SCHEMA) == ""
    assert squeezed(P.where([P.Compare("crate", ">", 2), P.Null("label")], SCHEMA)) == squeezed("WHERE crate > 2 AND ( label IS NULL)")
    assert P.where([P.Compare("crate", "=", 2)], SCHEMA, True) == 'WHERE "crate" = 2'


def test_what_has_no_text_is_left_out():
    known = P.Compare("crate", "=", 4)
    assert P.where([P.Compare("pallet", "=", 1), known], SCHEMA) == "WHERE crate = 4"
    assert P.render(P.Either(known, P.Compare("net", "<=>", 1.0)), SCHEMA) is None
    assert P.render(P.Both(P.Like("label", "p_ar"), known), SCHEMA) is None


def test_columns(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (None, "b'c")], "i int, s string")
    got = lambda p: sorted(map(str, (r.i for r in df.where(P.column(p)).collect())))
    assert got(P.Compare("i", "=", 1)) == ["1"]
    assert got(P.Compare("s", "<=>", None)) == ["2"]
    assert got(P.Not(P.Compare("i", "=", 1))) == ["2"]
    assert got(P.Text("s", "contains", "'")) == ["None"]
    assert got(P.Like("s", "a_")) == ["1"]
    assert got(P.In("i", (1, 2))) == ["1", "2"]


def test_like_as_spark_has_it(spark):
    rng = random.Random(3)
    texts = [None, "", *("".join(rng.choice("ab%_") for _ in range(rng.randrange(9))) for _ in range(150))]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(texts)], "i int, s string").cache()
    patterns = ["%a%b%", "a%b%a%", "%a%b%a", "%ab%a%", "a%a%a%a", "%^%%a%", "%a%b%b%", "b%%a%", "%a_b%", "^_%a%b%", "%aa%a%"]
    for pattern in patterns:
        want = df.select("i", F.expr(f"s like '{pattern}' escape '^'").alias("x")).collect()
        assert df.select("i", P.column(P.Like("s", pattern, "^")).alias("x")).collect() == want, pattern
        assert df.where(P.column(P.Not(P.Like("s", pattern, "^")))).count() == sum(r.x is False for r in want)
    assert P.segments("%the%and%", "\\") == ["", "the", "and", ""] and P.segments("a_b", "\\") is None and P.segments("a^%%", "^") == ["a%", ""]


def test_pushdown(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 7 as k", "cast(id as string) as s").write.parquet(path)
    df = spark.read.parquet(path).where(P.column(P.Either(P.Compare("k", "=", 3), P.Text("s", "starts", "9")))).select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(k,3),StringStartsWith(s,9))]" in plan
    assert "ReadSchema: struct<id:bigint,k:bigint,s:string>" in plan
