"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per-document measures come from array functions within the row, so no text is shuffled. Lines are
normalised (white space at the ends cut, lower case), hashed and counted by distinct document per
host; a line in more documents of a host than the limit is removed from all of them, and a document
that loses too much is rejected. The limit is a number, so a verdict doesn't change when unrelated
documents join a host. Hashes and lengths of lines are written once and read from there; texts are
split once for it. The count first drops repeats of (host, line, document) and is partly summed before
the second shuffle, so a line that all documents share is a few rows there; common lines go to the
tasks, or, beyond a checked number, are joined by a salted key.

Words are ``[^\\x20\\x09-\\x0D]+``. Defined results: null and empty texts have no words and fail
the base rules; a null host is a host of its own; a null id is an id of its own; rows repeated in
full count as one document and each come out; documents are told apart by id, so copies of a text
under several ids are several documents.
Operators find their columns by position and carry no others, but ``clean``, which carries all.
Line and window equality is that of 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import column_index, pick, stored

#: Words of a window; base limits.
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: A line is above the limit if more documents of the host have it than this number.
MAX_DOCS = 20
#: Common lines that are broadcast at most (some 30 bytes each); more are joined by SALTS keys a line.
BROADCAST_LINES, SALTS = 500_000, 64
#: A document is depleted if less than this share of the characters of its lines is left.
MIN_LEFT = 0.3

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def bound(value: Column, body) -> Column:
    """body(value), with value computed once: a lambda would compute it anew for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more; hashes are in the order of the windows."""
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
        again = F.filter(s, lambda x, k: F.when(k > 0, same(x, k - 1)).otherwise(False) | same(x, k + 1))
        return F.sort_array(F.transform(again, lambda x: x["i"]))

    def length(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    return bound(bound(ordered, repeated), length)


def repeat_words(w: Column) -> Column:
    windows = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    hashes = F.transform(windows, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    counted = bound(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(w) > WINDOW, counted).otherwise(F.lit(0).cast("long"))


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host, text_key, lines_chars and the base measures) of every row."""
    rows = pick(df, id=id_col, host=host_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    lines = F.filter(F.split("text", "\n"), lambda x: trimmed(x) != "")
    rows = rows.withColumns({"w": words(F.col("text")), "lines": lines})
    n, repeats = F.size("w").cast("long"), repeat_words(F.col("w"))
    out = rows.select(
        "id",
        "host",
        F.xxhash64("text").alias("text_key"),
        n.alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeats.alias("n_repeat_words"),
        F.aggregate("lines", F.lit(0).cast("long"), lambda t, x: t + F.length(trimmed(x))).alias("line_chars"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def lines(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(id, host, text_key, pos, line, chars) of every line with a word; line is the hash of its
    normal form."""
    rows = pick(df, id=id_col, host=host_col, text=text_col).where("text is not null")
    each = rows.select("id", "host", F.xxhash64("text").alias("text_key"), F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    each = each.withColumn("raw", trimmed(F.col("raw"))).where("raw != ''")
    return each.select("id", "host", "text_key", "pos", F.xxhash64(F.lower("raw")).alias("line"), F.length("raw").alias("chars"))


def frequent(all_lines: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """(host, line, n_docs) of the lines above the limit."""
    documents = F.countDistinct(F.struct("id"))  # so that a null id counts as one
    return all_lines.groupBy("host", "line").agg(documents.alias("n_docs")).where(F.col("n_docs") > max_docs)


def removed(all_lines: DataFrame, common: DataFrame) -> DataFrame:
    """The lines to remove, those of the stored common ones, in all documents."""
    few = common.select(F.col("host").alias("h"), F.col("line").alias("l"))
    same = F.col("host").eqNullSafe(F.col("h")) & (F.col("line") == F.col("l"))
    if few.count() <= BROADCAST_LINES:
        hits = all_lines.join(F.broadcast(few), same)
    else:
        few = few.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hits = all_lines.withColumn("salt", F.pmod(F.xxhash64("id", "pos"), F.lit(SALTS)).cast("int")).join(few, same & (F.col("salt") == F.col("s")))
    return hits.select("id", "host", "text_key", "pos", "chars")


def judge(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = MAX_DOCS,
    min_left: float = MIN_LEFT,
) -> DataFrame:
    """The measures of every row with removed_chars, the line numbers to remove, and the verdict."""
    every = stored(lines(df, id_col, text_col, host_col))
    gone = removed(every, stored(frequent(every, max_docs))).distinct()  # rows repeated in full
    gone = gone.groupBy("id", "host", "text_key").agg(F.sum("chars").alias("removed_chars"), F.array_agg("pos").alias("removed_lines"))
    gone = gone.toDF("i", "h", "t", "removed_chars", "removed_lines")
    same = F.col("id").eqNullSafe(F.col("i")) & F.col("host").eqNullSafe(F.col("h")) & (F.col("text_key") == F.col("t"))
    out = measure(df, id_col, text_col, host_col).join(gone, same, "left").drop("i", "h", "t")
    out = out.withColumn("removed_chars", F.coalesce("removed_chars", F.lit(0).cast("long")))
    depleted = F.col("line_chars") - F.col("removed_chars") < min_left * F.col("line_chars")
    return out.withColumns({"depleted": depleted, "kept": ~F.col("base_failed") & ~depleted})


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits: float) -> DataFrame:
    """The rows that are kept, with all their columns; lines above the limits are cut from the text."""
    verdict = judge(df, id_col, text_col, host_col, **limits).where("kept").select("id", "host", "text_key", "removed_lines").distinct()
    names = [f"_c{i}" for i in range(len(df.columns))]
    i, h, t = (F.col(f"_c{column_index(df, c)}") for c in (id_col, host_col, text_col))
    flat = df.toDF(*names).join(verdict, i.eqNullSafe(F.col("id")) & h.eqNullSafe(F.col("host")) & (F.xxhash64(t) == F.col("text_key")))
    left = F.filter(F.split(t, "\n"), lambda _, k: ~F.array_contains("removed_lines", k))
    text = F.when(F.col("removed_lines").isNull(), t).otherwise(F.array_join(left, "\n"))
    return flat.withColumn(f"_c{column_index(df, text_col)}", text).select(*names).toDF(*df.columns)
