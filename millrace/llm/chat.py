"""Tool-call linking with DataFrame functions only: calls and results are hash-joined by identifier, ordered by what
they depend on, checked against the schemas of their tools and written as canonical JSON.

Order: a call may name the call whose result it uses. Its depth is the length of that chain, found by pointer doubling:
each round joins every call with the one it has reached, so a chain of a million calls takes twenty rounds. Depths are
columns; no conversation is gathered in one task, however long. Parsing, type checks and serialisation use variants,
whose objects keep their keys sorted.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import table
from millrace.session import stage

# The tools of the query, as (name, field, type, required).
TOOLS = [
    ("search", "query", "string", True),
    ("search", "limit", "integer", True),
    ("translate", "text", "string", True),
    ("translate", "target", "string", True),
    ("count", "text", "string", True),
    ("count", "limit", "integer", False),
]
_TOOL_SCHEMA = "name string, field string, type string, required boolean"


def depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth, lost): how many calls stand before each in its chain; null on or behind a cycle. ``lost`` marks
    chains that begin with a call whose parent is not there; that call counts as the first."""
    known = calls.select(F.col("call_id").alias("parent")).withColumn("there", F.lit(True))
    # Calls without a parent stay out of the joins: their nulls would meet in one task.
    roots = calls.filter("parent is null").select(
        "call_id", F.lit(None).cast("string").alias("up"), F.lit(0).cast("long").alias("depth"), F.lit(False).alias("lost"))
    now = roots.union(calls.filter("parent is not null").select("call_id", "parent").join(known, "parent", "left").select(
        "call_id", F.when(F.col("there"), F.col("parent")).alias("up"),
        F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"), F.col("there").isNull().alias("lost")))
    now = stage(now, "chains")
    rows, reach = now.count(), 1
    # After k rounds a pointer has passed 2 ** k calls; what still points on after all calls are passed is in a cycle.
    while now.filter("up is not null").limit(1).count() and reach <= 2 * rows:
        above = now.select(F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"),
                           F.col("lost").alias("far"))
        moved = now.filter("up is null").union(
            now.filter("up is not null").join(above, "up").select(
                "call_id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
                (F.col("lost") | F.col("far")).alias("lost")))
        now = stage(moved, "chains")
        reach *= 2
    return now.select("call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"), "lost")


def _kind_of(value: Column) -> Column:
    """JSON type of a variant."""
    said = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (said == "VOID"), "null").when(said == "BIGINT", "integer").when(said == "STRING", "string")
        .when(said == "BOOLEAN", "boolean").when(said.startswith("ARRAY"), "array").when(said.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def checked(calls: DataFrame, tools: DataFrame) -> DataFrame:
    """``calls`` with ``errors``, sorted: unknown tool, arguments that are no object, missing, mistyped and unknown
    fields. Objects that name a key twice are no objects. A whole number is a number too."""
    wanted = tools.groupBy("name").agg(F.collect_list(F.struct("field", "type", "required")).alias("fields"))
    args = F.from_json("arguments", "map<string,variant>")
    parsed = calls.withColumn("args", F.when(F.try_parse_json("arguments").isNotNull(), args))
    full = parsed.join(wanted, "name", "left")

    def fault(field):
        value = F.element_at("args", field["field"])
        kind = _kind_of(value)
        fits = (kind == field["type"]) | ((field["type"] == "number") & (kind == "integer"))
        has = F.map_contains_key("args", field["field"])
        return F.when(field["required"] & ~has, F.concat(F.lit("missing "), field["field"])).when(
            has & ~fits, F.concat(F.lit("type of "), field["field"]))

    faults = F.filter(F.transform("fields", fault), lambda e: e.isNotNull())
    extra = F.transform(F.array_except(F.map_keys("args"), F.transform("fields", lambda f: f["field"])),
                        lambda k: F.concat(F.lit("unknown "), k))
    errors = (
        F.when(F.col("fields").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("args").isNull(), F.array(F.lit("arguments are no object")))
        .otherwise(F.array_sort(F.concat(faults, extra)))
    )
    return full.withColumn("errors", errors).drop("args", "fields")


def link(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """conv_id, turn, kind, call_id, place, linked, errors and json of every call and result.

    calls: conv_id, turn, call_id, parent, name, arguments; results: conv_id, turn, call_id, content; tools: name,
    field, type, required. ``place`` orders a conversation: 2 * depth for a call, one more for its result; null on a
    cycle and for results without a call. Calls without a result and results without a call have ``linked`` false; null
    identifiers link with nothing. Of calls or results with one identifier the one of the earliest turn counts, the
    others are marked as repeated. Null texts are left out of the JSON; empty tables give empty results.
    """
    order = F.struct("turn", "conv_id")
    first = calls.filter("call_id is not null").groupBy("call_id").agg(F.min(order).alias("first"))
    calls = calls.join(first, "call_id", "left").withColumn("again", order != F.col("first")).drop("first")
    chosen = calls.filter("not again").dropDuplicates(["call_id"])
    found = stage(depths(chosen.select("call_id", "parent")), "depths")
    answer = results.filter("call_id is not null").groupBy("call_id").agg(F.min(order).alias("answer"))
    calls = calls.join(found, "call_id", "left").join(answer, "call_id", "left")
    faults = F.concat(
        F.col("errors"),
        F.when(F.coalesce("again", F.lit(False)), F.array(F.lit("repeated call"))).otherwise(F.array().cast("array<string>")),
        F.when(F.coalesce("lost", F.lit(False)), F.array(F.lit("unknown parent"))).otherwise(F.array().cast("array<string>")),
        F.when(F.col("depth").isNull() & F.col("call_id").isNotNull(), F.array(F.lit("cycle")))
        .otherwise(F.array().cast("array<string>")),
    )
    said = F.to_json(F.struct(
        F.try_parse_json("arguments").alias("arguments"),
        F.when(F.try_parse_json("arguments").isNull(), F.col("arguments")).alias("arguments_text"),
        F.col("call_id").alias("call"), F.col("conv_id").alias("conversation"), "name",
        F.lit("assistant").alias("role")))
    one = checked(calls, tools).select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id", (2 * F.col("depth")).alias("place"),
        F.col("answer").isNotNull().alias("linked"), F.concat_ws("; ", faults).alias("errors"), said.alias("json"))
    known = found.select("call_id", "depth").withColumn("there", F.lit(True))
    results = results.join(answer, "call_id", "left").withColumn("again", order != F.col("answer"))
    results = results.join(known, "call_id", "left")
    trouble = F.when(F.col("there").isNull(), "no call").when(F.coalesce("again", F.lit(False)), "repeated result")
    said = F.to_json(F.struct(F.col("call_id").alias("call"), "content", F.col("conv_id").alias("conversation"),
                              F.lit("tool").alias("role")))
    two = results.select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", (2 * F.col("depth") + 1).alias("place"),
        F.col("there").isNotNull().alias("linked"), F.coalesce(trouble, F.lit("")).alias("errors"), said.alias("json"))
    return one.union(two)


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results from a table of turns: a user turn asks a tool, chosen by its numbers, and uses the result of
    the user turn two before; an assistant turn answers the turn before it."""
    name = F.element_at(F.array(*(F.lit(n) for n in ("search", "translate", "count", "lookup"))),
                        (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(4)) + 1).cast("int"))
    number = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(4))
    args = (
        F.when(number == 0, F.to_json(F.struct(F.col("text").alias("query"), F.col("turn").alias("limit"))))
        .when(number == 1, F.to_json(F.struct("text", F.when(F.pmod("turn", F.lit(3)) > 0, "en").alias("target"))))
        .otherwise(F.to_json(F.struct("text", F.col("turn").cast("string").alias("limit"))))
    )

    def named(back: int):
        return F.when(F.col("turn") >= back, F.concat_ws(":", "conv_id", F.col("turn") - back))

    calls = turns.filter("role = 'user'").select("conv_id", "turn", named(0).alias("call_id"), named(2).alias("parent"),
                                                 name.alias("name"), args.alias("arguments"))
    results = turns.filter("role = 'assistant'").select("conv_id", "turn", named(1).alias("call_id"),
                                                        F.col("text").alias("content"))
    return calls, results


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    calls, results = calls_of(turns)
    linked = link(calls, results, spark.createDataFrame(TOOLS, _TOOL_SCHEMA))
    said = F.to_json(F.struct(F.col("text").alias("content"), F.col("conv_id").alias("conversation"), "role"))
    others = turns.filter("role is null or role not in ('user', 'assistant')").select(
        "conv_id", "turn", F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"),
        F.lit(-1).cast("long").alias("place"), F.lit(False).alias("linked"), F.lit("").alias("errors"), said.alias("json"))
    return linked.union(others)


OP5_SQL = """
WITH RECURSIVE t AS (SELECT * FROM conversations),
calls AS (
  SELECT conv_id, turn, conv_id || ':' || turn AS call_id,
         CASE WHEN turn >= 2 THEN conv_id || ':' || (turn - 2) END AS parent, (conv_id + turn) % 4 AS tool, text
  FROM t WHERE role = 'user'),
results AS (SELECT conv_id, turn, conv_id || ':' || (turn - 1) AS call_id, text FROM t WHERE role = 'assistant' AND turn >= 1),
chain AS (
  SELECT call_id, 0 AS depth, parent IS NOT NULL AS lost
  FROM calls WHERE parent IS NULL OR parent NOT IN (SELECT call_id FROM calls)
  UNION ALL SELECT calls.call_id, depth + 1, lost FROM calls JOIN chain ON calls.parent = chain.call_id)
SELECT conv_id, turn, 'call' AS kind, calls.call_id, CAST(2 * depth AS BIGINT) AS place,
       calls.call_id IN (SELECT call_id FROM results) AS linked,
       concat_ws('; ', CASE WHEN tool = 1 AND turn % 3 = 0 THEN 'missing target' WHEN tool = 2 THEN 'type of limit'
                            WHEN tool = 3 THEN 'unknown tool' END, CASE WHEN lost THEN 'unknown parent' END) AS errors,
       '{"arguments":{' || CASE tool
         WHEN 0 THEN '"limit":' || turn || ',"query":' || to_json(text)
         WHEN 1 THEN CASE WHEN turn % 3 > 0 THEN '"target":"en",' ELSE '' END || '"text":' || to_json(text)
         ELSE '"limit":"' || turn || '","text":' || to_json(text) END
       || '},"call":"' || calls.call_id || '","conversation":' || conv_id || ',"name":"'
       || ['search', 'translate', 'count', 'lookup'][tool + 1] || '","role":"assistant"}' AS json
FROM calls JOIN chain USING (call_id)
UNION ALL
SELECT conv_id, turn, 'result', results.call_id, CAST(2 * depth + 1 AS BIGINT), depth IS NOT NULL,
       CASE WHEN depth IS NULL THEN 'no call' ELSE '' END,
       '{"call":"' || results.call_id || '","content":' || to_json(text) || ',"conversation":' || conv_id
       || ',"role":"tool"}'
FROM results LEFT JOIN chain USING (call_id)
UNION ALL
SELECT conv_id, turn, 'message', NULL, -1, false, '',
       '{"content":' || to_json(text) || ',"conversation":' || conv_id || ',"role":"' || role || '"}'
FROM t WHERE role NOT IN ('user', 'assistant')
"""
