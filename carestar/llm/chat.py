"""Tool-call linking for chat data, in DataFrame functions alone.

Messages (conv_id, turn, role, text) carry tool calls as JSON: an ``assistant``
text ``{"tool_calls": [{"id", "name", "arguments", "after": [ids]}]}``, a ``tool``
text ``{"tool_call_id", "content"}``; any other text is a plain message. Calls
and results are hash-joined by conversation and identifier, arguments are held
against the tools' schemas, calls are ordered so that each comes after those
it names in ``after``, and every entry is written as canonical JSON (compact,
keys in order, absent fields left out). One row per call, result or message: a
conversation of any length is never gathered.

status of a call: ``linked``, ``pending`` (no result), ``duplicate`` (its id is
that of an earlier call), ``cycle`` (waits for itself). status of a result:
``linked``, ``orphan`` (no such call), ``early`` (before its call), ``duplicate``
(not the first). status of a message: ``message``.

Order: ``step``, ``turn``, ``place``. Turn order already puts calls after what they
wait for unless a conversation says otherwise; only in such conversations step is
the length of the longest chain of calls that the call waits for. Calls that wait
for a cycle come after all others. A result has the step of its call; messages and
orphans have the largest step of the calls up to their turn, so they keep their place
among each other and never come before calls of earlier turns.

Steps take one round of joins per link of the longest chain in these conversations:
that many rounds, however many rows there are.

Defined results: rows without conv_id or identifier link to nothing. Null and
malformed texts are plain messages. Repeated rows get the same status. Unknown
identifiers in ``after`` are ignored. Arguments that are no JSON object are not
valid; neither are those of unknown tools. Empty tables give an empty result;
further columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carestar.llm.store import materialize, small_or_shuffled

CALL = ["conv_id", "call_id"]
TURNS = 4096            # turns of a conversation that one task looks at in a row
TYPES = {"string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$",
         "array": "^ARRAY.*$", "object": "^OBJECT.*$"}


def schema_table(spark, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """name, param, pattern, required of ``{tool: {param: (type, required)}}``."""
    rows = [(tool, param, TYPES[kind], required) for tool, params in schemas.items() for param, (kind, required) in params.items()]
    return spark.createDataFrame(rows, "name string, param string, pattern string, required boolean")


def parse(messages: DataFrame) -> DataFrame:
    """One row per entry: conv_id, turn, place, role, kind, call_id, name, arguments, after and content."""
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("json", F.when(F.col("role").isin("assistant", "tool"), F.try_parse_json("text")))
    rows = rows.withColumn("calls", F.expr(
        "if(role = 'assistant', try_variant_get(json, '$.tool_calls', 'array<variant>'), null)"))
    rows = rows.withColumn("result_id", F.expr("if(role = 'tool', try_variant_get(json, '$.tool_call_id', 'string'), null)"))
    calls = rows.where("size(calls) > 0").select("conv_id", "turn", "role", F.posexplode("calls").alias("place", "c")).select(
        "conv_id", "turn", "place", "role", F.lit("call").alias("kind"),
        F.expr("try_variant_get(c, '$.id', 'string')").alias("call_id"),
        F.expr("try_variant_get(c, '$.name', 'string')").alias("name"),
        F.expr("try_variant_get(c, '$.arguments', 'variant')").alias("arguments"),
        F.expr("try_variant_get(c, '$.after', 'array<string>')").alias("after"),
        F.lit(None).cast("variant").alias("content"))
    none = F.lit(None)
    rest = rows.where("not coalesce(size(calls) > 0, false)").select(
        "conv_id", "turn", F.lit(0).alias("place"), "role",
        F.when(F.col("result_id").isNotNull(), "result").otherwise("message").alias("kind"),
        F.col("result_id").alias("call_id"), none.cast("string").alias("name"), none.cast("variant").alias("arguments"),
        none.cast("array<string>").alias("after"),
        F.expr("if(result_id is not null, try_variant_get(json, '$.content', 'variant'), cast(text as variant))").alias("content"))
    return calls.union(rest)


def argument_faults(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, turn, place, call_id of calls whose arguments do not fit the schema of their tool."""
    key = ["conv_id", "turn", "place", "call_id"]
    tools = small_or_shuffled(schemas.groupBy("name").agg(
        F.collect_set(F.when(F.col("required"), F.col("param"))).alias("needed")))
    typed = calls.select(*key, "name", F.expr("try_cast(arguments as map<string, variant>)").alias("args"))
    known = typed.join(tools, "name", "left")
    missing = known.where("args is null or needed is null or size(array_except(needed, map_keys(args))) > 0").select(*key)
    given = typed.where("args is not null").select(*key, "name", F.explode("args").alias("param", "value"))
    wrong = (given.join(small_or_shuffled(schemas), ["name", "param"], "left")
             .where("pattern is null or not coalesce(schema_of_variant(value) rlike pattern, false)").select(*key))
    return missing.union(wrong).distinct()


def steps(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, step, cyclic of the calls of conversations whose turn order does not do.

    ``calls``: one row per conv_id, call_id with at (turn, place) and after.
    """
    edges = (calls.select("conv_id", "call_id", "at", F.explode("after").alias("dep")).distinct()
             .join(calls.select("conv_id", F.col("call_id").alias("dep"), F.col("at").alias("dep_at")), ["conv_id", "dep"]))
    odd = edges.where("dep_at >= at").select("conv_id").distinct()
    left = materialize(edges.join(odd, "conv_id", "left_semi").select("conv_id", "call_id", "dep"), "call-edges")
    waiting = left.count()
    done = calls.join(odd, "conv_id", "left_semi").select("conv_id", "call_id")
    done = materialize(done, "odd-calls")
    out, step = None, 0
    while True:
        blocked = left.select("conv_id", "call_id").distinct()
        ready = done.join(blocked, CALL, "left_anti").withColumn("step", F.lit(step)).withColumn("cyclic", F.lit(False))
        ready = materialize(ready, "ready")
        out = ready if out is None else out.union(ready)
        done = materialize(done.join(blocked, CALL, "left_semi"), "odd-calls")
        if not waiting:
            return out
        left = materialize(left.join(ready.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_anti")
                           .select("conv_id", "call_id", "dep"), "call-edges")
        now, step = left.count(), step + 1
        if now == waiting:
            last = out.groupBy("conv_id").agg(F.max("step").alias("last"))
            stuck = done.join(last, "conv_id", "left").select(*CALL, (F.coalesce("last", F.lit(-1)) + 1).alias("step"))
            return out.union(stuck.withColumn("cyclic", F.lit(True)))
        waiting = now


def steps_so_far(first: DataFrame, order: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, turn, so_far: the largest step of the calls up to each of the turns (conv_id, turn), in conversations with steps.

    The running maximum is taken within TURNS turns, on top of the largest step of those before, so that the turns of one
    long conversation are dealt to many tasks.
    """
    calls = first.select(*CALL, F.col("at.turn").alias("turn")).join(order.select(*CALL, "step"), CALL).select("conv_id", "turn", "step")
    asked = turns.join(order.select("conv_id").distinct(), "conv_id", "left_semi").select(
        "conv_id", "turn", F.lit(None).cast("int").alias("step"))
    points = (calls.union(asked).where("turn is not null").groupBy("conv_id", "turn").agg(F.max("step").alias("step"))
              .withColumn("span", F.expr(f"turn div {TURNS}")))
    points = materialize(points, "turn-steps")
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = points.groupBy("conv_id", "span").agg(F.max("step").alias("most")).select(
        "conv_id", "span", F.max("most").over(earlier).alias("before"))
    within = Window.partitionBy("conv_id", "span").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return points.join(spans, ["conv_id", "span"]).select(
        "conv_id", "turn", F.greatest("before", F.max("step").over(within)).alias("so_far"))


def link(messages: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """conv_id, turn, place, step, kind, call_id, status, valid (of calls), json: one row per entry."""
    entries = materialize(parse(messages), "entries")
    calls, results = entries.where("kind = 'call'"), entries.where("kind = 'result'")
    at = F.struct("turn", "place")
    named = calls.where("conv_id is not null and call_id is not null")
    first = materialize(named.groupBy(*CALL).agg(F.min(at).alias("at"), F.min_by("after", at).alias("after")), "first-calls")

    timed = results.join(first.select(*CALL, F.col("at.turn").alias("call_turn")), CALL, "left").withColumn(
        "early", F.col("turn") < F.col("call_turn"))
    answers = (timed.where("call_turn is not null and not coalesce(early, true)").groupBy(*CALL)
               .agg(F.min("turn").alias("answer_turn")))
    answers = materialize(answers, "answers")
    order = materialize(steps(first), "steps")
    unlinked = (entries.where("kind = 'message'").select("conv_id", "turn")
                .union(timed.where("call_turn is null").select("conv_id", "turn")))
    so_far = materialize(steps_so_far(first, order, unlinked), "steps-so-far")

    placed = calls.join(first.select(*CALL, F.col("at").alias("first_at")), CALL, "left").join(answers, CALL, "left").join(
        order, CALL, "left").join(
        argument_faults(calls, schema_table(messages.sparkSession, schemas)).withColumn("faulty", F.lit(True)),
        ["conv_id", "turn", "place", "call_id"], "left")
    call_status = (F.when(F.coalesce("cyclic", F.lit(False)), "cycle")
                   .when(F.col("first_at").isNotNull() & (at != F.col("first_at")), "duplicate")
                   .when(F.col("answer_turn").isNull(), "pending").otherwise("linked"))
    call_rows = placed.select(
        "conv_id", "turn", "place", F.coalesce("step", F.lit(0)).alias("step"), "kind", "role", "call_id", "name", "arguments", "after",
        "content", call_status.alias("status"),
        (F.col("conv_id").isNotNull() & F.col("call_id").isNotNull() & ~F.coalesce("faulty", F.lit(False))).alias("valid"))

    answered = timed.join(answers, CALL, "left").join(order.select(*CALL, "step"), CALL, "left").join(
        so_far, ["conv_id", "turn"], "left")
    result_status = (F.when(F.col("call_turn").isNull(), "orphan").when(F.coalesce("early", F.lit(True)), "early")
                     .when(F.col("turn") == F.col("answer_turn"), "linked").otherwise("duplicate"))
    none = F.lit(None).cast("boolean").alias("valid")
    result_rows = answered.select(
        "conv_id", "turn", "place", F.coalesce("step", "so_far", F.lit(0)).alias("step"), "kind", "role", "call_id", "name", "arguments", "after",
        "content", result_status.alias("status"), none)
    plain = entries.where("kind = 'message'").join(so_far, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "place", F.coalesce("so_far", F.lit(0)).alias("step"), "kind", "role", "call_id", "name", "arguments", "after", "content",
        F.lit("message").alias("status"), none)

    every = call_rows.union(result_rows).union(plain)
    fields = {"after": F.when(F.size("after") > 0, F.array_sort("after")), "arguments": F.col("arguments"),
              "content": F.col("content"), "conv_id": F.col("conv_id"), "id": F.col("call_id"), "name": F.col("name"),
              "role": F.col("role"), "status": F.col("status"), "turn": F.col("turn"), "type": F.col("kind"),
              "valid": F.col("valid")}
    return every.select("conv_id", "turn", "place", "step", "kind", "call_id", "status", "valid",
                        F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("json"))


def write_jsonl(linked: DataFrame, path: str) -> None:
    """The entries as JSON lines, conversations together and in order."""
    (linked.repartitionByRange("conv_id", "step", "turn", "place").sortWithinPartitions("conv_id", "step", "turn", "place")
     .select("json").write.text(path))
