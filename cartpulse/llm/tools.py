"""Tool-call linking in native functions: hash joins, topological levels, canonical JSON.

``calls`` has conv_id, turn, call_id, name, arguments (JSON text) and depends_on (ids of
calls of the same conversation); ``results`` has conv_id, call_id, turn, content.

A call is joined with its result by identifier. Its level is 0 without dependencies, else
one more than the highest of theirs; sorting a conversation by (level, turn, call_id) is
a topological order. Chains are followed by doubling, in log2 of their length rounds;
only calls with several dependencies take a round for every level among themselves. Rows
are always spread by conversation *and* call, so a conversation that holds a third of all
turns stays spread.

Arguments are parsed to variants and checked against the tool's schema. The call is
serialised as JSON with sorted keys and without white space.

Defined cases: null and empty ids are no identifier: such calls have level 0, no
result and a problem; a null conversation is one of its own; of several results the
earliest counts (then the least text), their number is given; calls that repeat an
identifier are kept, share level and result and have a problem; dependencies that are
not calls of the conversation are a problem and do not hold a call back; calls in or
behind a cycle have no level and a problem; arguments that are no JSON object are null
in the output and a problem; empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.llm import tables

# Tool -> argument -> (JSON type, required).
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]
SCHEMAS: Schemas = {
    "search": {"query": ("string", True), "limit": ("integer", False), "exact": ("boolean", False)},
    "lookup": {"query": ("string", True), "limit": ("integer", True), "exact": ("boolean", True)},
    "calculate": {"limit": ("number", True), "query": ("string", False), "exact": ("boolean", False)},
}
# JSON type -> how Spark names the type of such a variant.
_VARIANT_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "(BIGINT|DECIMAL.*|DOUBLE)",
    "boolean": "BOOLEAN",
    "array": "ARRAY.*",
    "object": "OBJECT.*",
}


def json_text(value: Column) -> Column:
    """A string as JSON, null as null."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNull(), "null").otherwise(
        F.substr(listed, F.lit(2), F.length(listed) - 2)
    )


def argument_problems(name: Column, arguments: Column, parsed: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as an array of texts."""
    keys = F.json_object_keys(arguments)
    none = F.array().cast("array<string>")

    def of_tool(schema: Mapping[str, tuple[str, bool]]) -> Column:
        checks = []
        for argument, (kind, required) in sorted(schema.items()):
            given = F.variant_get(parsed, f"$['{argument}']", "variant")
            named = F.array_contains(keys, argument)
            wrong = ~F.schema_of_variant(given).rlike(f"^{_VARIANT_TYPES[kind]}$")
            checks.append(
                F.when(~named, F.lit(f"{argument} is missing") if required else F.lit(None))
                .when(wrong, F.lit(f"{argument} is no {kind}"))
            )
        unknown = F.transform(
            F.array_sort(F.array_except(keys, F.array(*[F.lit(a) for a in sorted(schema)]))),
            lambda key: F.concat(key, F.lit(" is unknown")),
        )
        return F.concat(F.array_compact(F.array(*checks)), unknown)

    found = F.array(F.lit("the tool is unknown"))
    for tool, schema in schemas.items():
        found = F.when(name == tool, of_tool(schema)).otherwise(found)
    return F.when(
        parsed.isNull() | keys.isNull(), F.array(F.lit("arguments are no JSON object"))
    ).otherwise(F.coalesce(found, none))


def _same(left: DataFrame, right: DataFrame, right_id: str = "call_id") -> Column:
    return left["conv_id"].eqNullSafe(right["conv_id"]) & (left["call_id"] == right[right_id])


def _key(name: str) -> Column:
    """A call of a conversation as one text, a null conversation apart from all others."""
    return F.to_json(F.struct("conv_id", F.col(name).alias("call_id")))


def _followed(jumps: DataFrame) -> DataFrame:
    """(call, at, steps) with ``at`` the end of the chain of single dependencies from a call.

    Every round follows the jumps of the calls reached, so chains of n calls take
    log2(n) rounds. Who is still on a chain when a round ends none is in or behind a cycle
    and gets a null.
    """
    jumps, before = tables.stored(jumps, "jumps"), None
    while True:
        onward = jumps.select(
            F.col("call").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more")
        )
        met = jumps.join(onward, "at", "left")
        on_chain = met.filter(F.col("next").isNotNull()).count()
        if on_chain in (0, before):
            ended = F.col("next").isNull()
            return met.select("call", F.when(ended, F.col("at")).alias("at"), "steps")
        before = on_chain
        further = met.select(
            "call",
            F.coalesce("next", "at").alias("at"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
        )
        jumps = tables.stored(further, "jumps")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of every identified call; null in or behind a cycle.

    Chains of calls with one dependency each are followed by doubling. What is left to go
    through level by level are calls with several dependencies, each tied to the ends of
    the chains that it hangs on.
    """
    identified = calls.filter(F.col("call_id") != "")
    nodes = tables.stored(
        identified.select("conv_id", "call_id", _key("call_id").alias("call")).distinct(), "calls"
    )
    wanted = identified.select("conv_id", "call_id", F.explode("depends_on").alias("needs"))
    edges = wanted.select(_key("call_id").alias("call"), _key("needs").alias("needs")).distinct()
    present = nodes.select(F.col("call").alias("needs"))
    edges = tables.stored(edges.join(present, "needs", "left_semi"), "dependencies")
    counted = edges.groupBy("call").agg(F.count("*").alias("n"), F.min("needs").alias("at"))
    counted = tables.stored(counted, "dependency-counts")

    chained = counted.filter("n = 1").select("call", "at", F.lit(1).cast("long").alias("steps"))
    ends = tables.stored(_followed(chained), "chains")
    several = counted.filter("n > 1").select("call")
    # a call with several dependencies is one level above the end of each one's chain
    reached = edges.join(several, "call", "left_semi").join(
        ends.withColumnsRenamed({"call": "needs", "at": "end"}), "needs", "left"
    )
    hanging = tables.stored(
        reached.select(
            "call",
            F.when(F.col("steps").isNull(), F.col("needs")).otherwise(F.col("end")).alias("end"),
            (F.coalesce("steps", F.lit(0)) + 1).alias("steps"),
        ),
        "hanging",
    )
    known = tables.stored(
        nodes.select("call", F.lit(0).cast("long").alias("level")).join(counted, "call", "left_anti"),
        "levels",
    )
    waiting = tables.stored(several, "waiting")
    while not waiting.isEmpty():
        below = known.withColumnsRenamed({"call": "end", "level": "below"})
        measured = (
            hanging.join(waiting, "call", "left_semi")
            .join(below, "end", "left")
            .groupBy("call")
            .agg(
                F.max(F.col("below") + F.col("steps")).alias("level"),
                F.count_if(F.col("below").isNull()).alias("unknown"),
            )
        )
        found = tables.stored(measured.filter("unknown = 0").select("call", "level"), "levels")
        if found.isEmpty():
            break
        known = tables.stored(known.unionByName(found), "levels")
        waiting = tables.stored(waiting.join(found, "call", "left_anti"), "waiting")

    bottom = known.withColumnsRenamed({"call": "at", "level": "below"})
    on_chains = ends.join(bottom, "at", "left").select(
        "call", (F.col("below") + F.col("steps")).alias("level")
    )
    every = known.unionByName(on_chains)
    return nodes.join(every, "call", "left").select(
        "conv_id", "call_id", F.col("level").cast("int").alias("level")
    )


def link(calls: DataFrame, results: DataFrame, schemas: Schemas = SCHEMAS) -> DataFrame:
    """One row per call: level, result, problems, canonical JSON."""
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments", "depends_on")
    answers = (
        results.filter(F.col("call_id") != "")
        .groupBy("conv_id", "call_id")
        .agg(
            F.min(F.struct(F.col("turn").isNull(), "turn", "content")).alias("first"),
            F.count("*").alias("n_results"),
        )
    )
    counted = (
        calls.filter(F.col("call_id") != "")
        .groupBy("conv_id", "call_id")
        .agg(F.count("*").alias("n_calls"))
    )
    ordered = levels(calls)
    known = F.coalesce("depends_on", F.array().cast("array<string>"))
    deps = (
        calls.filter(F.col("call_id") != "")
        .select("conv_id", "call_id", F.explode(F.array_distinct(known)).alias("needs"))
        .distinct()
    )
    present = ordered.select("conv_id", F.col("call_id").alias("needs"))
    missing = (
        deps.join(
            present,
            deps["conv_id"].eqNullSafe(present["conv_id"]) & (deps["needs"] == present["needs"]),
            "left_anti",
        )
        .select("conv_id", "call_id")
        .distinct()
        .withColumn("misses", F.lit(True))
    )
    joined = calls
    for other in (ordered, counted, answers, missing):
        renamed = other.withColumnsRenamed({"conv_id": "of_conv", "call_id": "of_call"})
        own = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("call_id") == F.col("of_call"))
        joined = joined.join(renamed.hint("shuffle_hash"), own, "left").drop("of_conv", "of_call")
    identified = F.coalesce(F.col("call_id") != "", F.lit(False))
    parsed = joined.withColumn("parsed", F.try_parse_json("arguments"))
    is_object = F.json_object_keys("arguments").isNotNull() & F.col("parsed").isNotNull()
    problem = F.array_compact(
        F.array(
            F.when(~identified, "no identifier"),
            F.when(F.col("n_calls") > 1, "identifier is repeated"),
            F.when(F.col("misses"), "a dependency is missing"),
            F.when(identified & F.col("level").isNull(), "dependencies have a cycle"),
            F.when(F.col("n_results").isNull(), "no result"),
        )
    )
    checked = parsed.select(
        "conv_id",
        "turn",
        "call_id",
        "name",
        F.when(identified, F.col("level")).otherwise(0).alias("level"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.size(
            argument_problems(F.col("name"), F.col("arguments"), F.col("parsed"), schemas)
        ).alias("n_argument_problems"),
        F.array_join(
            F.concat(
                problem,
                argument_problems(F.col("name"), F.col("arguments"), F.col("parsed"), schemas),
            ),
            "; ",
        ).alias("problems"),
        F.concat(
            F.lit('{"arguments":'),
            F.when(is_object, F.to_json("parsed")).otherwise("null"),
            F.lit(',"depends_on":'),
            F.to_json(F.array_sort(F.array_distinct(known))),
            F.lit(',"id":'),
            json_text(F.col("call_id")),
            F.lit(',"name":'),
            json_text(F.col("name")),
            F.lit(',"result":'),
            json_text(F.col("first.content")),
            F.lit("}"),
        ).alias("canonical"),
    )
    return checked.select(
        "conv_id",
        "turn",
        "call_id",
        "name",
        "level",
        "n_results",
        (F.col("n_argument_problems") == 0).alias("arguments_valid"),
        "problems",
        "canonical",
    )


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Results that no call of their conversation asked for."""
    return results.join(calls, _same(calls, results), "left_anti")


# ------------------------------------------------------------------ the conversations as calls


def calls_of(conversations: DataFrame) -> DataFrame:
    """Every assistant turn as a tool call; tool, arguments and dependency follow from the turn.

    A fifth each of the arguments has a wrong type, misses one or is broken JSON;
    every fourth tool is unknown; calls hang on the one two turns before, in chains
    of four.
    """
    n = F.coalesce(F.length("text"), F.lit(0))
    usual = F.to_json(
        F.struct(F.col("text").alias("query"), (n % 100).alias("limit"), (n % 2 == 0).alias("exact"))
    )
    arguments = (
        F.when(n % 5 == 0, F.to_json(F.struct(F.col("text").alias("query"), F.lit("ten").alias("limit"))))
        .when(n % 5 == 1, F.to_json(F.struct(n.alias("limit"))))
        .when(n % 5 == 2, F.lit('{"query": '))
        .otherwise(usual)
    )
    turn = F.col("turn")
    tool = F.pmod(F.floor(turn / 2), F.lit(4))
    return conversations.filter(F.col("role") == "assistant").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        turn.cast("long").alias("turn"),
        F.concat(F.lit("call-"), turn.cast("string")).alias("call_id"),
        F.when(tool == 0, "search")
        .when(tool == 1, "lookup")
        .when(tool == 2, "calculate")
        .otherwise("translate")
        .alias("name"),
        arguments.alias("arguments"),
        F.when(F.pmod(turn, F.lit(8)) >= 2, F.array(F.concat(F.lit("call-"), (turn - 2).cast("string"))))
        .otherwise(F.array().cast("array<string>"))
        .alias("depends_on"),
    )


def results_of(conversations: DataFrame) -> DataFrame:
    """Every user turn as the result of a call made in the turn before."""
    turn = F.col("turn")
    return conversations.filter(F.col("role") == "user").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.concat(F.lit("call-"), (turn - 1).cast("string")).alias("call_id"),
        turn.cast("long").alias("turn"),
        F.col("text").alias("content"),
    )


def linked_calls(conversations: DataFrame) -> DataFrame:
    return link(calls_of(conversations), results_of(conversations))


TOOLS_SQL = """
WITH calls AS (
  SELECT conv_id, turn, 'call-' || turn AS call_id,
         ['search', 'lookup', 'calculate', 'translate'][(turn // 2) % 4 + 1] AS name,
         length(text) AS n, to_json(text) AS head,
         CASE WHEN turn % 8 >= 2 THEN 'call-' || (turn - 2) END AS needs
  FROM conversations WHERE role = 'assistant'),
ids AS (SELECT conv_id, call_id, count(*) AS n_calls FROM calls GROUP BY ALL),
results AS (
  SELECT conv_id, 'call-' || (turn - 1) AS call_id, count(*) AS n_results,
         min(text) AS content
  FROM conversations WHERE role = 'user' GROUP BY ALL),
edges AS (
  SELECT DISTINCT c.conv_id, c.call_id, c.needs FROM calls c
  JOIN ids i ON c.conv_id = i.conv_id AND c.needs = i.call_id),
l0 AS (SELECT conv_id, call_id, 0 AS level FROM ids
       WHERE (conv_id, call_id) NOT IN (SELECT (conv_id, call_id) FROM edges)),
l1 AS (SELECT e.conv_id, e.call_id, 1 AS level FROM edges e JOIN l0 p ON e.conv_id = p.conv_id AND e.needs = p.call_id),
l2 AS (SELECT e.conv_id, e.call_id, 2 AS level FROM edges e JOIN l1 p ON e.conv_id = p.conv_id AND e.needs = p.call_id),
l3 AS (SELECT e.conv_id, e.call_id, 3 AS level FROM edges e JOIN l2 p ON e.conv_id = p.conv_id AND e.needs = p.call_id),
levels AS (FROM l0 UNION ALL FROM l1 UNION ALL FROM l2 UNION ALL FROM l3),
rows AS (
  SELECT c.*, l.level, i.n_calls, coalesce(r.n_results, 0) AS n_results, r.content,
         c.needs IS NOT NULL AND d.call_id IS NULL AS misses,
         CASE n % 5 WHEN 2 THEN 'arguments are no JSON object'
           ELSE CASE
             WHEN name = 'translate' THEN 'the tool is unknown'
             WHEN n % 5 = 0 THEN CASE name
               WHEN 'search' THEN 'limit is no integer'
               WHEN 'lookup' THEN 'exact is missing; limit is no integer'
               ELSE 'limit is no number' END
             WHEN n % 5 = 1 THEN CASE name
               WHEN 'search' THEN 'query is missing'
               WHEN 'lookup' THEN 'exact is missing; query is missing'
               ELSE '' END
             ELSE '' END END AS wrong,
         CASE n % 5
           WHEN 0 THEN '{"limit":"ten","query":' || head || '}'
           WHEN 1 THEN '{"limit":' || n || '}'
           WHEN 2 THEN 'null'
           ELSE '{"exact":' || (n % 2 = 0) || ',"limit":' || (n % 100) || ',"query":' || head || '}'
         END AS arguments
  FROM calls c
  JOIN ids i ON c.conv_id = i.conv_id AND c.call_id = i.call_id
  JOIN levels l ON c.conv_id = l.conv_id AND c.call_id = l.call_id
  LEFT JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
  LEFT JOIN ids d ON c.conv_id = d.conv_id AND c.needs = d.call_id)
SELECT conv_id, turn, call_id, name, CAST(level AS INTEGER) AS level, n_results,
       wrong = '' AS arguments_valid,
       concat_ws('; ', CASE WHEN n_calls > 1 THEN 'identifier is repeated' END,
                 CASE WHEN misses THEN 'a dependency is missing' END,
                 CASE WHEN n_results = 0 THEN 'no result' END, nullif(wrong, '')) AS problems,
       '{"arguments":' || arguments || ',"depends_on":' ||
       CASE WHEN needs IS NULL THEN '[]' ELSE '["' || needs || '"]' END || ',"id":"' || call_id ||
       '","name":"' || name || '","result":' || coalesce(to_json(content), 'null') || '}' AS canonical
FROM rows
"""
