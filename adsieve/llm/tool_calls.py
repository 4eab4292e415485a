"""Chat formatting: link tool calls with their results, order them, validate and serialise them.

Calls and results meet in a hash join on conversation and call id. A call may depend on other calls
of its conversation (``depends_on``: one id, or an array); its level is the length of the longest
way to a call without dependency, so ordering a conversation by (level, turn, call_id) is
topological. Chains of single dependencies are contracted by pointer jumping (n calls take log2(n)
joins); calls with several dependencies are then settled in rounds, one for each of them on the
longest way. Arguments are parsed as JSON, checked against schemas and written as canonical JSON:
keys in order at every depth, no spaces, numbers in one form. No number changes its value: one that is kept neither by a
decimal of 38 digits nor, written with an exponent, by a double (15 digits, within its range) gives the error
``arguments``. ``1.0`` is an integer, as in JSON Schema, and is written ``1``. DataFrame functions only.

Defined results: of calls with one id in one conversation the first by (turn, name, arguments) is
linked and ``n_calls`` counts them, results alike; ``status`` is ``linked``, ``unanswered`` or
``orphan_result``; a dependency that doesn't exist counts as none and gives the error
``dependency``; calls in a cycle, or behind one, have a null level and the error ``cycle``;
arguments that aren't a JSON object (or repeat a key) give the error ``arguments`` and are quoted as
they are; an argument that is JSON null is written, but counts as absent; a name without a schema
gives ``unknown_tool``. Rows with a null conversation or call id take no part. Empty tables give
empty results; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.llm.storage import keep

KEY = ["conv_id", "call_id"]
# What a parsed JSON value of each type is called.
KINDS = {"integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$", "number": r"^(BIGINT|DECIMAL.*|DOUBLE)$", "boolean": "^BOOLEAN$", "string": "^STRING$", "object": "^OBJECT", "array": "^ARRAY"}


def quoted(text: Column) -> Column:
    """A JSON string."""
    array = F.to_json(F.array(text))
    return F.substring(array, F.lit(2), F.length(array) - 2)


def _exact(arguments: Column) -> Column:
    """Is every number outside of strings kept as it is when parsed?"""
    bare = F.regexp_replace(F.regexp_replace(arguments, r"(?s)\\.", ""), '"[^"]*+"', '""')

    def kept(number: Column) -> Column:
        mantissa, value = F.regexp_replace(number, "[eE].*", ""), number.try_cast("double")
        digits = F.length(F.regexp_replace(F.regexp_replace(mantissa, "[-.]", ""), "^0+", ""))
        in_range = (F.abs(value) >= 1e-307) & (F.abs(value) < float("inf"))
        as_double = (digits <= 15) & ((digits == 0) | in_range)
        as_decimal = (digits <= 38) & (F.length(F.regexp_extract(mantissa, "[.](.*)", 1)) <= 38)
        return F.when(number.rlike("[eE]"), as_double).otherwise(as_decimal)

    return F.forall(F.regexp_extract_all(bare, F.lit("-?[0-9][0-9.eE+-]*"), F.lit(0)), lambda n: F.coalesce(kept(n), F.lit(False)))


def _first_by_key(rows: DataFrame, columns: list[str], count: str) -> DataFrame:
    whole = rows.where(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull())
    first = whole.groupBy(*KEY).agg(F.min(F.struct(*columns)).alias("first"), F.count(F.lit(1)).alias(count))
    return first.select(*KEY, "first.*", count)


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of (conv_id, call_id, depends_on: array); level null in or behind a cycle."""
    ids = calls.select("conv_id", F.col("call_id").alias("up"))
    edges = keep(calls.select(*KEY, F.explode(F.array_distinct("depends_on")).alias("up")).join(ids, ["conv_id", "up"], "left_semi"), "edges")
    ups = edges.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("up").alias("up"))
    single = F.coalesce(F.col("n") == 1, F.lit(False))
    # each call points to a base: itself, or for a single dependency that, and so on; ``steps`` lie between
    start = calls.select(*KEY).join(ups, KEY, "left").select(*KEY, F.when(single, F.col("up")).otherwise(F.col("call_id")).alias("base"), single.cast("long").alias("steps"), (~single).alias("done"), F.coalesce("n", F.lit(0)).alias("n"))
    state = keep(start, "levels")
    size = state.count()
    for _ in range(max(1, size).bit_length() + 1):
        if not state.where("NOT done").limit(1).count():
            break
        above = state.select("conv_id", F.col("call_id").alias("base"), F.col("base").alias("further"), F.col("steps").alias("more"), F.col("done").alias("there"))
        jumped = state.join(above, ["conv_id", "base"])
        state = keep(jumped.select(*KEY, F.col("further").alias("base"), F.when(F.col("done"), F.col("steps")).otherwise(F.col("steps") + F.col("more")).alias("steps"), (F.col("done") | F.col("there")).alias("done"), "n"), "levels")
    base = state.where("n = 0").select("conv_id", F.col("call_id").alias("base"), F.lit(0).cast("long").alias("base_level"))
    if state.where("n > 1").limit(1).count():
        base = base.unionByName(_settled(edges, state))
    placed = state.join(base, ["conv_id", "base"], "left")
    return placed.select(*KEY, F.when(F.col("done"), F.col("base_level") + F.col("steps")).alias("level"))


def _settled(edges: DataFrame, state: DataFrame) -> DataFrame:
    """(conv_id, base, base_level) of the calls with several dependencies, round by round, as far as no cycle holds them."""
    of_up = state.select("conv_id", F.col("call_id").alias("up"), F.col("base").alias("below"), F.when(F.col("done"), F.col("steps") + 1).alias("way"))
    several = state.where("n > 1").select(*KEY)
    links = keep(edges.join(several, KEY, "left_semi").join(of_up, ["conv_id", "up"]).select("conv_id", F.col("call_id").alias("base"), "below", "way"), "links")
    roots = state.where("n = 0").select("conv_id", F.col("call_id").alias("below"), F.lit(0).cast("long").alias("low"))
    known = keep(links.limit(0).select("conv_id", "base", F.col("way").alias("base_level")), "settled")
    while True:
        lows = roots.unionByName(known.select("conv_id", F.col("base").alias("below"), F.col("base_level").alias("low")))
        open_ = links.join(known, ["conv_id", "base"], "left_anti").join(lows, ["conv_id", "below"], "left")
        reached = open_.groupBy("conv_id", "base").agg(F.max(F.col("low") + F.col("way")).alias("base_level"), F.bool_and((F.col("low") + F.col("way")).isNotNull()).alias("whole"))
        fresh = keep(reached.where("whole").drop("whole"), "settled")
        if not fresh.limit(1).count():
            return known
        known = keep(known.unionByName(fresh), "settled")


def _errors(schema: dict[str, dict], given: Column, keys: Column, within: str = "") -> Column:
    """Where an object departs from its schema, as an array: by argument in order of names, then unknown ones."""
    none = F.array().cast("array<string>")
    errors = []
    for name in sorted(schema):
        rule, path = schema[name], '$["' + name.replace("\\", "\\\\").replace('"', '\\"') + '"]'
        value = F.try_variant_get(given, path, "variant")
        there = value.isNotNull() & ~F.is_variant_null(value)
        kind, wanted, label = F.schema_of_variant(value), rule.get("type", "string"), within + name
        fits = there & kind.rlike(KINDS[wanted])
        found = []
        if rule.get("required"):
            found.append(F.when(~there, F.lit(f"missing:{label}")))
        found.append(F.when(there & ~fits, F.lit(f"type:{label}")))
        if "max_length" in rule:
            found.append(F.when(fits & (F.length(F.try_variant_get(given, path, "string")) > rule["max_length"]), F.lit(f"length:{label}")))
        number = F.try_variant_get(given, path, "double")
        for bound, wrong in (("minimum", number < rule.get("minimum", 0)), ("maximum", number > rule.get("maximum", 0))):
            if bound in rule:
                found.append(F.when(fits & wrong, F.lit(f"{bound}:{label}")))
        if "items" in rule:
            items = F.try_variant_get(given, path, "array<variant>")
            odd = F.exists(items, lambda x: ~F.coalesce(F.schema_of_variant(x).rlike(KINDS[rule["items"].get("type", "string")]), F.lit(False)))
            found.append(F.when(fits & odd, F.lit(f"items:{label}")))
        errors.append(F.array_compact(F.array(*found)))
        if "properties" in rule:
            inner_keys = F.map_keys(F.from_json(F.to_json(value), "map<string,string>"))
            errors.append(F.when(fits, _errors(rule["properties"], value, inner_keys, f"{label}.")).otherwise(none))
    extra = F.array_sort(F.array_except(keys, F.array(*map(F.lit, sorted(schema))).cast("array<string>")))
    return F.concat(none, *errors, F.transform(extra, lambda k: F.concat(F.lit(f"unknown:{within}"), k)))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """Link ``calls`` (conv_id, call_id, turn, name, arguments, depends_on) and ``results`` (conv_id, call_id, turn, content).

    A row for each call id: status, level, errors, and ``json``, the call with its result.
    """
    several = dict(calls.dtypes)["depends_on"].startswith("array")
    ups = F.array_compact(F.col("depends_on") if several else F.array("depends_on"))
    given = calls.select(*KEY, "turn", "name", "arguments", F.coalesce(ups, F.array().cast("array<string>")).alias("depends_on"))
    own = keep(_first_by_key(given, ["turn", "name", "arguments", "depends_on"], "n_calls"), "calls")
    answers = _first_by_key(results.select(*KEY, F.col("turn").alias("result_turn"), "content"), ["result_turn", "content"], "n_results")
    ids = own.select("conv_id", F.col("call_id").alias("up"))
    lost = own.select(*KEY, F.explode("depends_on").alias("up")).join(ids, ["conv_id", "up"], "left_anti").select(*KEY).distinct().withColumn("lost", F.lit(True))
    ordered = own.join(levels(own), KEY).join(lost, KEY, "left")
    both = ordered.hint("shuffle_hash").join(answers.hint("shuffle_hash"), KEY, "full")
    parsed = F.try_parse_json("arguments")
    errors = F.array().cast("array<string>")
    keys = F.map_keys(F.from_json("arguments", "map<string,string>"))
    for name in sorted(schemas):
        errors = F.when(F.col("name") == name, _errors(schemas[name], F.col("given"), keys)).otherwise(errors)
    is_call = F.col("n_calls").isNotNull()
    other = [
        F.when(is_call & ~F.coalesce(F.col("name").isin(*sorted(schemas)), F.lit(False)), F.lit("unknown_tool")),
        F.when(is_call & F.col("given").isNull(), F.lit("arguments")),
        F.when(is_call & F.col("level").isNull(), F.lit("cycle")),
        F.when(is_call & F.coalesce("lost", F.lit(False)), F.lit("dependency")),
    ]
    broken = F.col("given").isNull() | F.col("name").isNull()
    shown = both.withColumn("given", F.when(F.schema_of_variant(parsed).startswith("OBJECT") & _exact(F.col("arguments")), parsed))
    fields = [
        F.concat(F.lit('"arguments":'), F.when(broken, quoted(F.coalesce("arguments", F.lit("")))).otherwise(F.to_json("given"))),
        F.concat(F.lit('"id":'), quoted(F.col("call_id"))),
        F.concat(F.lit('"name":'), quoted(F.coalesce("name", F.lit("")))),
        F.concat(F.lit('"result":'), F.when(F.col("content").isNull(), F.lit("null")).otherwise(quoted(F.col("content")))),
    ]
    return shown.select(
        *KEY, "turn", "level", "n_calls", "n_results",
        F.when(F.col("n_calls").isNull(), "orphan_result").when(F.col("n_results").isNull(), "unanswered").otherwise("linked").alias("status"),
        F.array_join(F.concat(F.when(broken, F.array().cast("array<string>")).otherwise(errors), F.array_compact(F.array(*other))), ",").alias("errors"),
        F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}")).alias("json"),
    )


#: For turns without tool calls of their own: what a user's turn asks for.
TURN_SCHEMAS = {"reply": {"text": {"type": "string", "required": True, "max_length": 400}, "turn": {"type": "integer", "required": True, "minimum": 0, "maximum": 5}, "lang": {"type": "string"}}}


def turns_as_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A user's turn calls ``reply`` and depends on the user's turn before; the assistant's next turn is its result."""
    call_id = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    turn = F.col("turn")
    arguments = F.concat(F.lit('{"turn":'), F.coalesce(turn.cast("string"), F.lit("null")), F.lit(',"text":'), F.coalesce(quoted(F.col("text")), F.lit("null")), F.lit("}"))
    calls = turns.where("role = 'user'").select("conv_id", call_id(turn).alias("call_id"), "turn", F.lit("reply").alias("name"), arguments.alias("arguments"), F.when(turn >= 2, call_id(turn - 2)).alias("depends_on"))
    results = turns.where("role = 'assistant'").select("conv_id", call_id(turn - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, min(text) AS text, count(*) AS n_calls FROM conversations
  WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL
), answers AS (
  SELECT conv_id, turn - 1 AS turn, min(text) AS content, count(*) AS n_results FROM conversations
  WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY ALL
), depth AS (
  SELECT conv_id, turn, 0::BIGINT AS level FROM calls c
  WHERE turn < 2 OR NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
  UNION ALL
  SELECT c.conv_id, c.turn, d.level + 1 FROM depth d JOIN calls c ON c.conv_id = d.conv_id AND c.turn = d.turn + 2
), both_sides AS (
  SELECT coalesce(c.conv_id, a.conv_id) AS conv_id, coalesce(c.turn, a.turn) AS at_turn, c.turn, c.text, c.n_calls, a.content, a.n_results, d.level
  FROM calls c FULL JOIN answers a ON a.conv_id = c.conv_id AND a.turn = c.turn
  LEFT JOIN depth d ON d.conv_id = c.conv_id AND d.turn = c.turn
)
SELECT conv_id, 'call_' || at_turn AS call_id, turn, level, n_calls, n_results,
  CASE WHEN n_calls IS NULL THEN 'orphan_result' WHEN n_results IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
  CASE WHEN n_calls IS NULL THEN '' ELSE concat_ws(',', CASE WHEN length(text) > 400 THEN 'length:text' END,
    CASE WHEN turn > 5 THEN 'maximum:turn' END, CASE WHEN turn >= 2 AND level = 0 THEN 'dependency' END) END AS errors,
  '{"arguments":' || CASE WHEN n_calls IS NULL THEN '""' ELSE '{"text":' || to_json(text) || ',"turn":' || turn || '}' END
    || ',"id":"call_' || at_turn || '","name":"' || CASE WHEN n_calls IS NULL THEN '' ELSE 'reply' END
    || '","result":' || coalesce(to_json(content)::VARCHAR, 'null') || '}' AS json
FROM both_sides"""
