"""Near-duplicates by bottom-k sketches of one hash function.

1. A document's set is its distinct shingles of ``size`` words, as 64-bit hashes. Documents of equal
   sets form a class, and the one of smallest id represents it from there on.
2. A sketch is the K smallest hashes of a set. Inverted lists of the FEW smallest give pairs by
   overlap. In the K smallest values of a union, a share of about the similarity is common to both
   sets, so a pair of similar sets has common values among the FEW smallest but for a chance of
   0.2 ** FEW; ``least_shared(FEW)`` of them are asked for.
3. A value that more than LIST classes hold is frequent. Classes with a frequent value among the FEW
   are compared by all K values instead, rarest first: sets that must share t of their values share
   one of the first K - t + 1. In lists that are still long, the most typical class is the centre:
   all members are compared with it, which links groups of near copies at linear cost. Members that
   are not linked to it form lists again, cut by size of set. As the distance 1 - J obeys the
   triangle inequality, a member below ``2 * threshold - 1`` to the centre can't be linked with one
   that is linked to it; the others are compared with all these. What is too long to be paired is
   compared in blocks of bounded size, each pair of blocks a task.
4. An estimate from the union of the sketches drops pairs that are far below the threshold, the
   full sets decide on the others, and links make connected components.

Chances of losing a pair (2, 3, 4) are at most about CHANCE each; everything else is exact, but that sets are
compared by 64-bit hashes of their shingles. No list, group or block is cut short.

Where data of nodes is joined with pairs, a node of many pairs is sent once for each SLICE of its partners and
spread over as many tasks. Long lists are joined with one row each (their size and centre); their members, ids
only there, are split over tasks by Spark's own handling of skewed joins.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; fewer words than ``size`` are one shingle.
Defined results: null and empty texts have an empty set and are linked with nothing, as are rows
with a null id, whose component is null and which are kept. Repeated rows fall in one class and
have the same component. An id with several texts is one node where it represents them. Only the id
and text columns are read, so others can't clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import arrow_map, bound_batches, column_index, pick, relieve, stored
from tidewell.llm.components import components

#: Values of a sketch, and those in the first lists.
K, FEW = 128, 16
#: The chance of losing a pair that a step may have.
CHANCE = 1e-7
#: Members of a list that are paired directly.
LIST = 64
#: Classes of a block when the rest of a long list is compared.
BLOCK = 256
#: Partners of a node that are compared with it in one place.
SLICE = 256
#: Ids that are broadcast at most (16 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Deviations that an estimate may be below the threshold.
DEVIATIONS = 7

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)
def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return np.empty(0, np.int64)
    digest = xxhash.xxh3_64_intdigest
    each = np.fromiter(map(digest, words), np.uint64, len(words))
    span = min(size, len(words))
    n = len(words) - span + 1
    mixed = np.full(n, span, np.uint64)
    for i in range(span):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[i % 4] + each[i : i + n]
    mixed ^= mixed >> np.uint64(30)
    mixed *= _ODD[1]
    mixed ^= mixed >> np.uint64(27)
    mixed *= _ODD[4]
    mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed.view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int64)
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def sketches(rows: DataFrame, size: int) -> DataFrame:
    """(id, n, key, sketch): set size, a 128-bit digest of the set, and its K smallest values."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
        keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), _lists([s[:K] for s in sets])],
            names=["id", "n", "key", "sketch"],
        )

    return arrow_map(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, n bigint, key binary, sketch array<bigint>")


def full_sets(rows: DataFrame, ids: DataFrame, size: int, unique: bool) -> DataFrame:
    """(node, vals): the whole sets of the classes (node, key), one row for each. Unique: no id has
    several rows."""
    ids = ids.select(F.col("node").alias("r"), F.col("key").alias("k"))
    small = ids.count() <= BROADCAST_IDS
    some = rows.join(F.broadcast(ids) if small else ids, F.col("id") == F.col("r"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, size) for t in batch.column(1).to_pylist()]
        # An id may have several texts; the one of the class counts.
        fits = [xxhash.xxh3_128_digest(s.tobytes()) == k for s, k in zip(sets, batch.column(2).to_pylist(), strict=True)]
        own = batch.filter(pa.array(fits, pa.bool_()))
        return pa.RecordBatch.from_arrays([own.column(0), own.column(2), _lists([s for s, f in zip(sets, fits, strict=True) if f])], names=["node", "key", "vals"])

    schema = f"node {rows.schema['id'].dataType.simpleString()}, key binary, vals array<bigint>"
    sets = arrow_map(some.select("id", "text", "k"), run, schema)
    return (sets if unique else sets.dropDuplicates(["node", "key"])).select("node", "vals")


def _if_small(df: DataFrame) -> DataFrame:
    """A stored table of ids, broadcast where its counted size allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def compared(pairs: DataFrame, data: DataFrame, judge: Callable[[np.ndarray, np.ndarray], tuple], result: str) -> DataFrame:
    """(a, b, *result) of stored pairs: judge(data of one node, data of the other). A node of many pairs
    is sent once for each SLICE of its partners, not once for each, and no task gets all of them: the
    partners follow it in the sorted rows of their slice, so a task holds the data of two nodes."""
    big = [_if_small(stored(pairs.groupBy(F.col(x).alias(f"_{x}")).agg(F.count("*").alias(f"_n{x}")).where(F.col(f"_n{x}") > SLICE))) for x in ("a", "b")]
    n = pairs.join(big[0], F.col("a") == F.col("_a"), "left").join(big[1], F.col("b") == F.col("_b"), "left").fillna(0, ["_na", "_nb"])
    turn = F.col("_nb") > F.col("_na")
    slices_ = F.greatest(F.ceil(F.greatest("_na", "_nb") / SLICE), F.lit(1))
    n = n.select(F.when(turn, F.col("b")).otherwise(F.col("a")).alias("hub"), F.when(turn, F.col("a")).otherwise(F.col("b")).alias("other"), slices_.alias("_s"))
    n = n.select("hub", "other", F.pmod(F.xxhash64("other"), F.col("_s")).alias("piece"))
    hubs = n.select("hub", "piece").distinct().select("hub", "piece", F.lit(None).cast(n.schema["other"].dataType).alias("other"), F.col("hub").alias("_x"))
    roles = hubs.union(n.select("hub", "piece", "other", F.col("other").alias("_x")))
    # At most two rows for each pair, of ids only: so data that no pair asks for is not shuffled.
    roles = F.broadcast(roles) if 2 * pairs.count() <= BROADCAST_IDS else roles
    rows = data.toDF("_node", "vals").join(roles, F.col("_node") == F.col("_x")).select("hub", "piece", "other", "vals")
    rows = rows.repartition("hub", "piece").sortWithinPartitions("hub", "piece", F.col("other").asc_nulls_first())
    names = [x.split()[0] for x in result.split(", ")]
    types = [{"double": pa.float64(), "boolean": pa.bool_()}[x.split()[1]] for x in result.split(", ")]
    bound_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []
        for batch in batches:
            where, out = [], []
            vals = batch.column(3)
            keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).is_null().to_pylist(), strict=True)
            for i, (hub, piece, first) in enumerate(keys):
                now = vals[i].values.to_numpy()
                if first:
                    if at != (hub, piece):
                        at, own = (hub, piece), []
                    own.append(now.copy())
                else:
                    for x in own:
                        where.append(i)
                        out.append(judge(x, now))
            ids = batch.take(pa.array(where, pa.int64())).select([0, 2])
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*ids.columns, *columns], names=["x", "y", *names])
        relieve()

    kind = n.schema["hub"].dataType.simpleString()
    done = rows.mapInArrow(run, f"x {kind}, y {kind}, {result}")
    return done.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), *names)


def least_shared(values: int, percent: int) -> int:
    """How many of the smallest values of a union two similar sets share, but for CHANCE."""
    j, below = percent / 100, 0.0
    for common in range(values + 1):
        below += math.comb(values, common) * j**common * (1 - j) ** (values - common)
        if below > CHANCE:
            return common
    return values


def _close(a: Column, b: Column, percent: int) -> Column:
    """Set sizes of which similar sets are possible."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _pairs_of_lists(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """(a, b) for the members (node, n) of each list, which has LIST members at most."""
    lists = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("node", "n"))).alias("m")).where(F.size("m") > 1)

    def partners(x: Column, i: Column) -> Column:
        later = F.filter("m", lambda y, j: (j > i) & _close(x["n"], y["n"], percent))
        return F.transform(later, lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b")))

    return lists.select(F.explode(F.flatten(F.transform("m", partners))).alias("p")).select("p.a", "p.b")


def union_estimate(a: np.ndarray, b: np.ndarray) -> tuple[float, bool]:
    """Similarity by the K smallest values of the union of two sketches, and whether it is exact
    (both sketches are whole sets)."""
    both = np.union1d(a, b)
    exact = len(a) < K and len(b) < K
    low = both if exact else both[:K]
    common = np.intersect1d(a, b, assume_unique=True)
    if not len(low):
        return 0.0, exact
    return float(np.searchsorted(common, low[-1], side="right")) / len(low), exact


def estimates(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, est, exact) of stored pairs of nodes."""
    return compared(pairs, reps.select("node", "sketch"), union_estimate, "est double, exact boolean")


def enough(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common) > 0


def verified(rows: DataFrame, estimated: DataFrame, reps: DataFrame, size: int, percent: int, unique: bool) -> DataFrame:
    """The pairs whose full sets reach the threshold. Estimated: stored (a, b, est, exact)."""
    threshold = percent / 100
    margin = DEVIATIONS * math.sqrt(threshold * (1 - threshold) / K)
    sure = estimated.where(F.col("exact") & (F.round(F.col("est"), 12) >= threshold)).select("a", "b")
    open_ = stored(estimated.where(~F.col("exact") & (F.col("est") >= threshold - margin)).select("a", "b").distinct())
    ids = stored(open_.select(F.col("a").alias("node")).union(open_.select(F.col("b").alias("node"))).distinct().join(reps, "node").select("node", "key"))
    linked = lambda x, y: (enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent),)
    both = compared(open_, full_sets(rows, ids, size, unique), linked, "linked boolean")
    return sure.union(both.where("linked").select("a", "b"))


def _prefix(n: Column, percent: int) -> Column:
    """How many of a set's values, rarest first, must be looked at: one of them is shared by every
    similar set. Below 0.8 * K, partners have whole sketches too and the count is exact."""
    whole = n - F.ceil(n * percent / 100) + 1
    return F.when(n <= int(K * percent / 100), whole).otherwise(F.least(n, F.lit(K)) - least_shared(K, percent) + 1).cast("int")


def _rarest(busy: DataFrame, common: DataFrame, percent: int) -> DataFrame:
    """(node, n, fame, v, df): the values of each sketch that must be looked at, rarest first; df is 0 but
    for the common values, and fame the sum over all of a sketch. The common values go to the tasks if
    their checked number allows it; else values are joined with them."""
    if common.count() > BROADCAST_IDS:
        values = busy.select("node", "n", F.explode("sketch").alias("v")).join(common, "v", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        ranked = values.groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("vs"), F.sum("df").alias("fame"))
        rows = ranked.select("node", "n", "fame", F.explode(F.slice("vs", F.lit(1), _prefix(F.col("n"), percent))).alias("x"))
        return rows.select("node", "n", "fame", "x.v", "x.df")
    table = common.orderBy("v").toArrow()
    shared = busy.sparkSession.sparkContext.broadcast((table["v"].to_numpy(), table["df"].to_numpy()))
    least = least_shared(K, percent)
    bound_batches(busy.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = shared.value
        for batch in batches:
            lists, sizes = batch.column(2), batch.column(1).to_numpy()
            values, of = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
            df = np.where(known[at] == values, count[at], 0) if len(known) else np.zeros(len(values), np.int64)
            fame = np.bincount(of, df, len(lists)).astype(np.int64)
            order = np.lexsort((values, df, of))
            place = np.arange(len(of)) - np.searchsorted(of, of)  # within the row, now in the order of df
            whole = sizes - -(-sizes * percent // 100) + 1
            enough_ = np.where(sizes <= K * percent // 100, whole, np.minimum(sizes, K) - least + 1)
            take = order[place < enough_[of]]
            row = pa.array(of[take])
            columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(fame[of[take]]), pa.array(values[take]), pa.array(df[take])]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "fame", "v", "df"])
        relieve()

    return busy.mapInArrow(run, f"node {busy.schema['node'].dataType.simpleString()}, n bigint, fame bigint, v bigint, df bigint")


def _blocks(members: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among members (g, node, first) of groups that were too long to be paired: each block
    with a ``first`` member is compared with every other block, a pair of blocks to a task. Members
    that are linked already are not compared; of the links of two blocks, a spanning forest is given."""
    roots = components(links)
    m = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    counts = m.groupBy("g").agg(F.sum(F.col("first").cast("long")).alias("f"), F.count("*").alias("c"))
    counts = counts.withColumns({"fb": F.ceil(F.col("f") / BLOCK).cast("int"), "rb": F.ceil((F.col("c") - F.col("f")) / BLOCK).cast("int")})
    m = m.join(counts.where("f > 0"), "g")
    of = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    m = m.withColumn("i", F.when(F.col("first"), of(F.col("fb"))).otherwise(F.col("fb") + of(F.col("rb"))))
    others = F.when(F.col("first"), F.sequence(F.lit(0), F.col("fb") + F.col("rb") - 1)).otherwise(F.sequence(F.lit(0), F.col("fb") - 1))
    m = m.withColumn("j", F.explode(others)).withColumns({"lo": F.least("i", "j"), "hi": F.greatest("i", "j")})
    m = m.select("g", "lo", "hi", "i", "node", "root").join(sets, "node")

    kind = sets.schema["node"].dataType.simpleString()

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        nodes, roots = group["node"].to_pylist(), group["root"].to_pylist()
        lists = group["vals"].chunk(0)
        cuts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        lo, one = group["lo"][0].as_py(), group["lo"][0] == group["hi"][0]
        left = [k for k, i in enumerate(group["i"].to_pylist()) if i == lo]
        right = left if one else sorted(set(range(len(nodes))) - set(left))
        up: dict = {}

        def top(x):
            while x in up:
                x = up[x]
            return x

        every, at = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        mark = np.zeros(len(every), bool)
        out = []
        for k in left:
            own = at[cuts[k] : cuts[k + 1]]
            mark[own] = True
            for r in right:
                if (r > k or not one) and (x := top(roots[k])) != (y := top(roots[r])):
                    small, large = sorted((len(own), int(cuts[r + 1] - cuts[r])))
                    if 100 * small >= percent * large and enough(int(mark[at[cuts[r] : cuts[r + 1]]].sum()), small, large, percent):
                        up[x] = y
                        out.append((nodes[k], nodes[r]))
            mark[own] = False
        typed = group.schema.field("node").type
        return pa.table({"a": pa.array([a for a, _ in out], typed), "b": pa.array([b for _, b in out], typed)})

    return m.groupBy("g", "lo", "hi").applyInArrow(run, f"a {kind}, b {kind}")


def links(rows: DataFrame, reps: DataFrame, size: int, percent: int, unique: bool) -> DataFrame:
    """(a, b) between classes: every similar pair, or at least a path of similar pairs."""
    threshold = percent / 100
    first = reps.select("node", "n", F.explode(F.slice("sketch", 1, FEW)).alias("v"))
    hot = stored(first.groupBy("v").count().where(F.col("count") > LIST).select("v"))
    by_overlap = _pairs_of_lists(first.join(hot, "v", "left_anti"), ["v"], percent).groupBy("a", "b").count().where(F.col("count") >= least_shared(FEW, percent))

    busy = _if_small(stored(first.join(hot, "v", "left_semi").select("node").distinct()))
    busy = reps.join(busy, "node", "left_semi").select("node", "n", "sketch")
    each = busy.select(F.explode("sketch").alias("v"))
    common = stored(each.groupBy("v").agg(F.count("*").alias("df")).where(F.col("df") > LIST))
    looked = stored(_rarest(busy, common, percent))
    by_rare = _pairs_of_lists(looked.where("df = 0").select("v", "node", "n"), ["v"], percent)

    long = looked.where("df > 0").select("v", "node", "n", "fame")
    sizes = long.groupBy("v").agg(F.count("*").alias("c"), F.max(F.struct("fame", "node", "n")).alias("top"))
    sized = stored(long.join(sizes.select("v", "c", F.col("top.node").alias("centre"), F.col("top.n").alias("cn")), "v"))
    by_list = _pairs_of_lists(sized.where(F.col("c") <= LIST).select("v", "node", "n"), ["v"], percent)
    to_centre = sized.where((F.col("c") > LIST) & (F.col("node") != F.col("centre")))
    centred = to_centre.where(_close(F.col("n"), F.col("cn"), 2 * percent - 100)).select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))

    candidates = by_overlap.select("a", "b").union(by_rare).union(by_list).union(centred).distinct()
    estimated = stored(estimates(stored(candidates), reps))
    found = stored(verified(rows, estimated, reps, size, percent, unique))

    # What is left of the long lists: members that are not linked to their centre. A class and its
    # centre meet in many lists, so their state is looked up once.
    pairs = to_centre.select("node", "centre").distinct().withColumns({"a": F.least("node", "centre"), "b": F.greatest("node", "centre")})
    state = stored(pairs.join(found.withColumn("linked", F.lit(True)), ["a", "b"], "left").join(estimated, ["a", "b"], "left").drop("exact"))
    # These lists are cut by size of set: each member stands in two neighbouring bands.
    band = F.floor(F.log("n") / F.lit(math.log(101 / percent)))  # a little wider than the ratio of sizes
    rest = to_centre.select("v", "node", "n", "centre").join(state.where("linked"), ["node", "centre"], "left_anti")
    rest = rest.select("v", "node", "n", F.explode(F.array(band, band + 1)).alias("band"))
    counts = rest.groupBy("v", "band").agg(F.count("*").alias("c"))
    rest = stored(rest.join(counts, ["v", "band"]))
    if rest.isEmpty():
        return found
    more = _pairs_of_lists(rest.where(F.col("c") <= LIST).select("v", "band", "node", "n"), ["v", "band"], percent).distinct()
    more = verified(rows, stored(estimates(stored(more.join(estimated, ["a", "b"], "left_anti")), reps)), reps, size, percent, unique)
    found = stored(found.union(more))

    # Near the centre but not linked to it: against all that are linked to it, and each other.
    margin = DEVIATIONS * math.sqrt(0.25 / K)
    near = state.where(F.col("linked").isNull() & (F.col("est") >= 2 * threshold - 1 - margin)).select(F.struct("centre", F.lit(0).alias("band")).alias("g"), "node", F.lit(True).alias("first"))
    core = state.where("linked").select(F.struct("centre", F.lit(0).alias("band")).alias("g"), "node", F.lit(False).alias("first"))
    far = rest.where(F.col("c") > LIST).select(F.struct("v", F.col("band").cast("int").alias("band")).alias("g"), "node", F.lit(True).alias("first"))
    groups = near.union(core).distinct().select(F.xxhash64("g", F.lit(1)).alias("g"), "node", "first").union(far.distinct().select(F.xxhash64("g", F.lit(2)).alias("g"), "node", "first"))
    groups = stored(groups)
    if groups.where("first").isEmpty():
        return found
    ids = stored(groups.select("node").distinct().join(reps, "node").select("node", "key"))
    sets = full_sets(rows, ids, size, unique)
    return stored(found.union(_blocks(groups, found, sets, percent)))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: sets of at least ``percent`` similarity
    are linked, and kept is true for the smallest id that is reachable."""
    return _judged(df, id_col, text_col, size, percent).drop("key").withColumnRenamed("_id", id_col)


def _judged(df: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """As near_duplicates, with the digest of each row's set."""
    if percent < 70:
        raise ValueError("the first lists are too short for less than 70 percent")
    rows = pick(df, id=id_col, text=text_col)
    own = stored(sketches(rows, size))
    classes = own.where("id is not null and n > 0").groupBy("key").agg(F.min("id").alias("rep"), F.min_by("n", "id").alias("n"), F.min_by("sketch", "id").alias("sketch"))
    reps = stored(classes.withColumn("node", F.col("rep")))
    unique = own.where("id is not null").groupBy("id").count().where("count > 1").isEmpty()
    found = links(rows.where("id is not null"), reps, size, percent, unique)
    roots = components(found).select(F.col("node").alias("x"), "root")
    of = reps.select("key", "rep", "node").join(roots, F.col("node") == F.col("x"), "left").select("key", F.coalesce("root", "rep").alias("root"))
    single = F.col("id").isNull() | (F.col("n") == 0)
    out = own.select("id", "n", "key").join(of.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
    component = F.when(single, F.col("id")).otherwise(F.col("root"))
    return out.select(
        F.col("id").alias("_id"),
        "key",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("id").isNull() | F.col("id").eqNullSafe(component)).alias("kept"),
    )


def drop_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all columns: that of the smallest id, and of its rows
    repeated with the same text, one. Of an id with several texts, each is judged by itself. Only ids are joined, so texts are not shuffled while the
    documents to drop are few enough to be broadcast."""
    found = stored(_judged(df, id_col, text_col, size, percent))
    names = [f"_c{i}" for i in range(len(df.columns))]
    own, text = (F.col(f"_c{column_index(df, c)}") for c in (id_col, text_col))
    flat = df.toDF(*names)
    gone = stored(found.where("not kept").select("_id").distinct())
    small = gone.count() <= BROADCAST_IDS
    out = flat.join(F.broadcast(gone) if small else gone, own == F.col("_id"), "left_anti")
    # Ids of which one text is kept and another is not: their rows are told apart by the sets.
    torn = stored(found.join(F.broadcast(gone) if small else gone, "_id", "left_semi").where("kept").select("_id", "key").distinct())
    if not torn.isEmpty():

        @F.arrow_udf("binary")
        def digest(texts: pa.Array) -> pa.Array:
            sets = [shingles(t, size) for t in texts.to_pylist()]
            return pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())

        some = flat.join(torn.select("_id").distinct(), own == F.col("_id"), "left_semi").withColumn("_key", digest(text))
        out = out.unionByName(some.join(torn, (own == F.col("_id")) & F.col("_key").eqNullSafe(F.col("key")), "left_semi").drop("_key"))
    repeated = stored(found.where("kept and _id is not null").groupBy("_id").count().where("count > 1").select("_id"))
    if not repeated.isEmpty():
        single = out.join(repeated, own == F.col("_id"), "left_anti")
        again = out.join(repeated, own == F.col("_id"), "left_semi").withColumn("_t", F.xxhash64(text))
        out = single.unionByName(again.dropDuplicates([f"_c{column_index(df, id_col)}", "_t"]).drop("_t"))
    return out.toDF(*df.columns)
