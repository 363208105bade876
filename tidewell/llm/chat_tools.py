"""Tool-call linking in DataFrame functions only.

Calls and results are joined by (conversation, identifier), a hash join of shuffled sides; calls are put in topological order by
joins, so no conversation is ever gathered in one task; arguments are
checked against the tools' schemas; each linked call becomes one line of canonical JSON: sorted
keys, no spaces, and one form for 1, 1.0 and 1e0 (written with an exponent, numbers from ten million
on keep one).

Defined results: of several calls with one identifier in a conversation the first turn counts (then
the smaller JSON), of several results the first after the call; results that fit no call come out as
orphans, and calls without a result as unanswered. Null conversations or identifiers are no calls
and no results. A null or broken argument text is the error "arguments", one that repeats a key of an
object the error "repeated"; both have null arguments in the JSON. Calls in or behind a cycle
of dependencies have a null wave. Empty tables give empty results. Only named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm._common import pick, stored

CALL = "conv_id, call_id, turn, name, arguments, depends_on"
#: Spark's names of JSON types by those of schemas.
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN", "array": "ARRAY<.*", "object": "OBJECT<.*"}
MESSAGE = "tool_calls array<struct<id:string,name:string,arguments:variant,depends_on:array<string>>>, tool_call_id string, content string"


def tool_messages(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Calls and results of messages whose text is a JSON object with ``tool_calls`` or ``tool_call_id``."""
    rows = pick(df, conv_id=conv_col, turn=turn_col, text=text_col).where(F.col("text").rlike(r"^[ \t\r\n]*\{"))
    rows = rows.withColumn("m", F.from_json("text", MESSAGE)).where("m is not null")
    calls = rows.select("conv_id", "turn", F.explode("m.tool_calls").alias("c"))
    calls = calls.select("conv_id", F.col("c.id").alias("call_id"), "turn", "c.name", F.to_json("c.arguments").alias("arguments"), "c.depends_on")
    results = rows.where("m.tool_call_id is not null").select("conv_id", F.col("m.tool_call_id").alias("call_id"), "turn", "m.content")
    return calls, results


def turns_as_calls(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Plain chats in the same form: a system turn is a call of ``set_context`` and any other turn
    but the assistant's one of ``respond``; the assistant's turn is the result of the one before. Chats
    have no dependencies and no faults of their own, so the length of the text gives them: by its
    remainder of 4 a call needs the one two turns before, none, the one two turns later, or the ones two
    before and four later; by that of 12 its arguments are broken, incomplete, of a wrong type, too many,
    repeated, or written with an exponent. Other remainders, and null texts, are sound."""
    rows = pick(df, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    of = lambda n: F.concat(F.lit("c"), (F.col("turn") + n).cast("string"))
    json = lambda *fields: F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    prompt, size = F.col("text").alias("prompt"), F.coalesce(F.length("text"), F.lit(11))
    sound = json(prompt, "turn")
    faulty = (
        F.lit('{"prompt":'),
        json("turn"),
        json(prompt, F.col("turn").cast("string").alias("turn")),
        json(size.alias("n"), prompt, "turn"),
        F.concat(F.lit('{"turn":0,'), F.substring(sound, 2, 1 << 30)),
        F.concat(F.regexp_replace(sound, r"\}$", ""), F.lit("e0}")),
    )
    arguments, depends = sound, F.array().cast("array<string>")
    for k, text in enumerate(faulty):
        arguments = F.when(size % 12 == k, text).otherwise(arguments)
    for k, names in enumerate((F.array(of(-2)), None, F.array(of(2)), F.array(of(-2), of(4)))):
        depends = depends if names is None else F.when(size % 4 == k, names).otherwise(depends)
    name = F.when(F.col("role") == "system", "set_context").otherwise("respond").alias("name")
    asked = rows.where("role is null or role <> 'assistant'").select("conv_id", of(0).alias("call_id"), "turn", name, arguments.alias("arguments"), depends.alias("depends_on"))
    answers = rows.where("role = 'assistant'").select("conv_id", of(-1).alias("call_id"), "turn", F.col("text").alias("content"))
    return asked, answers


#: Schemas of the calls that plain chats are turned into: field, type, required.
TURN_SCHEMAS = {name: [("prompt", "string", True), ("turn", "integer", True)] for name in ("respond", "set_context")}


def canonical(value: Column) -> Column:
    """The text of a variant, whose keys are sorted, with whole numbers in one form: ".0" goes where it
    stands outside of strings."""
    return F.regexp_replace(F.to_json(value), r'("(?:[^"\\]++|\\.)*+")|(-?[0-9]+)\.0(?![0-9E])', "$1$2")


def errors(name: Column, fields: Column, repeated: Column, schemas: dict[str, list[tuple[str, str, bool]]]) -> Column:
    """What is wrong with the arguments (a map of variants): sorted short messages. The schemas are
    a stated list and become part of the expression."""
    if not schemas:
        return F.array(F.lit("tool"))
    known = F.create_map(*[x for n, fs in sorted(schemas.items()) for x in (F.lit(n), F.array(*[F.struct(F.lit(f).alias("field"), F.lit(TYPES[t]).alias("type"), F.lit(r).alias("required")) for f, t, r in fs]))])

    def check(rule: Column) -> Column:
        value = F.try_element_at(fields, rule["field"])
        kind = F.schema_of_variant(value)
        absent = value.isNull() | F.coalesce(F.is_variant_null(value), F.lit(False))
        wrong = ~F.coalesce(F.regexp(kind, F.concat(F.lit("^("), rule["type"], F.lit(")$"))), F.lit(False))
        return F.when(absent, F.when(rule["required"], F.concat(F.lit("missing:"), rule["field"]))).when(wrong, F.concat(F.lit("type:"), rule["field"]))

    rules = F.try_element_at(known, name)
    extra = F.transform(F.array_except(F.map_keys(fields), F.transform(rules, lambda r: r["field"])), lambda f: F.concat(F.lit("unexpected:"), f))
    found = F.concat(F.filter(F.transform(rules, check), lambda e: e.isNotNull()), extra)
    return F.when(rules.isNull(), F.array(F.lit("tool"))).when(repeated, F.array(F.lit("repeated"))).when(fields.isNull(), F.array(F.lit("arguments"))).otherwise(F.array_sort(found))


def _kahn(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, wave) of the nodes that are in no cycle and behind none: 1 for those without
    edges from other nodes, else one more than the highest of these. One join for each wave."""
    key = ["conv_id", "call_id"]
    parts, left = [stored(nodes.join(edges.select(*key).distinct(), key, "left_anti").withColumn("wave", F.lit(1)))], edges
    while not left.isEmpty() and not parts[-1].isEmpty():
        met = parts[-1].select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("met"))
        marked = stored(left.join(met, ["conv_id", "parent"], "left"))
        left = marked.where("met is null").drop("met")
        ready = marked.where("met").select(*key).distinct().join(left.select(*key).distinct(), key, "left_anti")
        parts.append(stored(ready.withColumn("wave", F.lit(len(parts) + 1))))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def waves(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, wave), so that (wave, turn, call_id) is a topological order; null in or
    behind a cycle. Where all dependencies point back, as they do unless a call refers to a later
    one, (turn, call_id) is such an order already and no call is visited. Else the calls behind such
    references are put in waves of their own."""
    key = ["conv_id", "call_id"]
    edges = calls.select("conv_id", "call_id", "turn", F.explode(F.array_distinct("depends_on")).alias("parent"))
    parents = calls.select(F.col("conv_id").alias("pc"), F.col("call_id").alias("p"), F.col("turn").alias("parent_turn"))
    edges = stored(edges.join(parents, (F.col("conv_id") == F.col("pc")) & (F.col("parent") == F.col("p"))).drop("pc", "p"))
    ahead = F.coalesce(F.struct("parent_turn", "parent") >= F.struct("turn", "call_id"), F.lit(True))
    reached = stored(edges.where(ahead).select(*key).distinct())
    new = reached
    while not new.isEmpty():  # the calls behind these
        step = edges.join(new.withColumnRenamed("call_id", "parent"), ["conv_id", "parent"], "left_semi").select(*key).distinct()
        new = stored(step.join(reached, key, "left_anti"))
        reached = stored(reached.union(new))
    if reached.isEmpty():
        return calls.select(*key, F.lit(0).alias("wave"))
    within = edges.join(reached, key, "left_semi").join(reached.withColumnRenamed("call_id", "parent"), ["conv_id", "parent"], "left_semi").select(*key, "parent")
    later = _kahn(reached, stored(within))
    return calls.select(*key).join(reached, key, "left_anti").withColumn("wave", F.lit(0)).union(later)


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, list[tuple[str, str, bool]]]) -> DataFrame:
    """(conv_id, call_id, turn, name, wave, status, errors, json): one row for each call and orphan
    result. In the order of wave, turn and call_id every call stands behind those it depends on."""
    key = ["conv_id", "call_id"]
    calls = calls.where("conv_id is not null and call_id is not null")
    first = calls.groupBy(*key).agg(F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("c")).select(*key, "c.*")
    first = stored(first)
    results = results.where("conv_id is not null and call_id is not null")
    begun = first.select(*key, F.col("turn").alias("begun"))
    met = results.join(begun.hint("shuffle_hash"), key, "left")
    later = met.where("begun is null or turn is null or turn >= begun")
    answer = later.where("begun is not null").groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r")).select(*key, F.lit(True).alias("answered"), "r.content")
    orphans = met.where("begun is null or turn < begun")

    linked = first.join(waves(first).hint("shuffle_hash"), key, "left").join(answer.hint("shuffle_hash"), key, "left")
    # No variant has a key twice, and a text with keys that is none repeats one.
    linked = linked.withColumn("args", F.try_parse_json("arguments"))
    linked = linked.withColumn("repeated", F.col("args").isNull() & F.json_object_keys("arguments").isNotNull())
    linked = linked.withColumn("args", F.try_parse_json(canonical(F.col("args"))))
    linked = linked.withColumn("fields", F.when(~F.col("repeated"), F.try_variant_get("args", "$", "map<string,variant>")))
    linked = linked.withColumns({"errors": errors(F.col("name"), F.col("fields"), F.col("repeated"), schemas), "status": F.when(F.col("answered"), "linked").otherwise("unanswered")})
    body = F.struct(F.col("args").alias("arguments"), "call_id", "errors", "name", F.col("content").alias("result"), "status", "turn", "wave")
    linked = linked.withColumn("json", F.to_json(body, {"ignoreNullFields": "false"}))
    lost = orphans.select(
        *key, "turn", F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("wave"), F.lit("orphan").alias("status"), F.array().cast("array<string>").alias("errors"),
        F.to_json(F.struct("call_id", F.col("content").alias("result"), F.lit("orphan").alias("status"), "turn"), {"ignoreNullFields": "false"}).alias("json"),
    )
    columns = [*key, "turn", "name", "wave", "status", "errors", "json"]
    return linked.select(*columns).union(lost.select(*columns))
