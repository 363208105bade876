"""Exact token-length histogram of a corpus.

Documents are aggregated by encoded length; suffix sums of the histogram then answer,
for every context limit, how many documents exceed it, the quantile it stands at, and how many
tokens remain if each document is cut there. Totals between two neighbouring lengths are linear,
so ``answers`` serves any limit from the histogram alone.

Defined results: null and empty texts have length 0 and count as documents; repeated rows count
each; an empty table gives an empty histogram. Only the id and text columns are read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm._common import arrow_map, pick
from tidewell.llm.byte_bpe import Vocabulary, codec

#: Limits or probabilities that may be asked for at once, as their list goes to every task.
MOST_STATED = 10_000


def lengths(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens) of every row."""
    rows = pick(df, id=id_col, text=text_col)
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = codec(shared.value).encode(batch.column(1)).value_lengths()
        return pa.RecordBatch.from_arrays([batch.column(0), n.cast(pa.int64())], names=["id", "n_tokens"])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens bigint"
    return arrow_map(rows, run, schema).withColumnRenamed("id", id_col)


def histogram(counted: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """(n_tokens, n_docs): documents of each length."""
    return pick(counted, n_tokens=length_col).where("n_tokens is not null").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def limits(hist: DataFrame) -> DataFrame:
    """For each length L of the histogram: documents and tokens beyond it (suffix sums), those up to it,
    the quantile, and the tokens left if every document is cut to L. Suffix sums go bucket by bucket from
    the far end, so that no task takes the whole histogram: a bucket near n has about sqrt(n) / 2 lengths,
    and all sums of buckets are some thousand rows."""
    h = hist.withColumn("bucket", F.floor(4 * F.sqrt("n_tokens"))).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    ends = h.groupBy("bucket").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    ends = ends.select(
        "bucket",
        F.coalesce(F.sum("b_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("b_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("b_docs").over(Window.partitionBy()).alias("all_docs"),
        F.sum("b_tokens").over(Window.partitionBy()).alias("all_tokens"),
    )
    longer = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    sums = {f"{c}_longer": F.coalesce(F.sum(x).over(longer), F.lit(0)) for c, x in (("docs", "n_docs"), ("tokens", "tokens"))}
    out = h.withColumns(sums).join(ends, "bucket")
    docs, tokens = F.col("docs_after") + F.col("docs_longer"), F.col("tokens_after") + F.col("tokens_longer")
    return out.select(
        "n_tokens",
        "n_docs",
        (F.col("all_docs") - docs).alias("docs_within"),
        docs.alias("docs_beyond"),
        (F.col("all_tokens") - tokens).alias("tokens_within"),
        tokens.alias("tokens_beyond"),
        (F.col("all_tokens") - tokens + F.col("n_tokens") * docs).alias("tokens_truncated"),
        ((F.col("all_docs") - docs) / F.col("all_docs")).alias("quantile"),
    )


def _stated(values: list) -> list:
    if len(values) > MOST_STATED:
        raise ValueError(f"{len(values)} values are asked for, {MOST_STATED} are the most")
    return values


def answers(hist: DataFrame, context_limits: list[int]) -> DataFrame:
    """Totals for any given limits, each from the whole histogram: documents beyond the limit and
    tokens left when every document is cut to it."""
    wanted = hist.sparkSession.createDataFrame([(int(x),) for x in _stated(context_limits)], "context_limit bigint")
    cut = F.least("n_tokens", "context_limit") * F.col("n_docs")
    beyond = F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)
    return (
        hist.join(F.broadcast(wanted))  # MOST_STATED rows at most
        .groupBy("context_limit")
        .agg(F.sum("n_docs").alias("docs"), F.sum(beyond).alias("docs_beyond"), F.sum(cut).alias("tokens_truncated"))
    )


def quantiles(hist: DataFrame, probabilities: list[float]) -> DataFrame:
    """(probability, n_tokens): the least length that at least this share of documents has or is below."""
    wanted = hist.sparkSession.createDataFrame([(float(p),) for p in _stated(probabilities)], "probability double")
    table = limits(hist).select("n_tokens", "quantile")
    return table.join(F.broadcast(wanted), F.col("quantile") >= F.col("probability")).groupBy("probability").agg(F.min("n_tokens").alias("n_tokens"))
