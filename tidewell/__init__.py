"""Tables, queries and bulk writes on Spark DataFrames."""

from tidewell.sources.loader import Loader
from tidewell.sources.reader import Reader
from tidewell.sources.writer import Writer


def read(spark) -> Reader:
    """``read(spark).option("dbtable", name).load()``"""
    return Reader(spark)


def write(df) -> Writer:
    """``write(df).option("dbtable", name).mode("overwrite").save()``"""
    return Writer(df)


def load(spark) -> Loader:
    """``load(spark).options(dbtable=name, stage_dir=folder).load()``"""
    return Loader(spark)


__all__ = ["Loader", "Reader", "Writer", "load", "read", "write"]
