"""Chat formatting: tool calls and results linked by identifier, ordered, validated and written as JSON.

DataFrame functions only. Calls and results are hash-joined; nothing gathers a conversation, so that one
may hold any share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch

_KEY = ["conv_id", "call_id"]


def canonical_json(text: Column) -> Column:
    """JSON with keys in order and no white space; null for what isn't JSON or has a key twice."""
    return F.to_json(F.try_parse_json(text))


def _type(value: Column) -> Column:
    name = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (name == "VOID"), "null")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name.startswith("OBJECT"), "object")
        .when(name.startswith("ARRAY"), "array")
        .when((name == "BIGINT") | name.rlike(r"^DECIMAL\(\d+,0\)$"), "integer")
        .otherwise("number")
    )


def argument_errors(arguments: Column, parameters: Column) -> Column:
    """What is wrong with JSON arguments, sorted: ``missing:p``, ``unknown:p`` and ``type:p``, or ``not_an_object``.

    ``parameters`` maps a tool's parameters to struct ``type`` (string, integer, number, boolean, object,
    array, null or any), ``required``; a null map is an ``unknown_tool``.
    """
    given = F.from_json(F.when(F.try_parse_json(arguments).isNotNull(), arguments), "map<string,variant>")

    def wrong(k: Column) -> Column:
        wanted, got = parameters[k]["type"], _type(given[k])
        return F.map_contains_key(parameters, k) & (wanted != "any") & (wanted != got) & ~((wanted == "number") & (got == "integer"))

    missing = F.filter(F.map_keys(parameters), lambda k: parameters[k]["required"] & ~F.map_contains_key(given, k))
    unknown = F.filter(F.map_keys(given), lambda k: ~F.map_contains_key(parameters, k))
    of_type = F.filter(F.map_keys(given), wrong)
    named = [_named(kind, names) for kind, names in (("missing", missing), ("unknown", unknown), ("type", of_type))]
    return (
        F.when(parameters.isNull(), F.array(F.lit("unknown_tool")))
        .when(given.isNull() | ~F.ltrim(arguments).startswith("{"), F.array(F.lit("not_an_object")))
        .otherwise(F.array_sort(F.concat(*named)))
    )


def _named(kind: str, names: Column) -> Column:
    return F.transform(names, lambda k: F.concat(F.lit(f"{kind}:"), k))


def _levels(calls: DataFrame, scratch: Scratch) -> DataFrame:
    """``conv_id, call_id, level`` of the calls that use others, or are used.

    Level 0 uses nothing that is a call, and every other call is one above the highest that it uses; -1 are calls in a
    circle, and those that use them. Each round follows every use through calls with one use only, which doubles its reach,
    so that rounds grow with the logarithm of a chain, and beyond that with the calls along it that use several
    which don't lead to one.
    """
    uses = calls.select(*_KEY, F.explode(F.array_distinct("uses")).alias("used"))
    edges = scratch.write(uses.join(calls.select("conv_id", F.col("call_id").alias("used")), ["conv_id", "used"]).select(*_KEY, "used", F.lit(1).cast("long").alias("steps")))
    nodes = scratch.write(edges.select(*_KEY).unionAll(edges.select("conv_id", "used")).distinct())
    done = scratch.write(nodes.join(edges.select(*_KEY).distinct(), _KEY, "left_anti").select(*_KEY, F.lit(0).alias("level")))
    left = scratch.write(nodes.join(done, _KEY, "left_anti"))
    while not left.isEmpty():
        only = edges.groupBy(*_KEY).agg(F.count("*").alias("n"), F.min("used").alias("next"), F.max("steps").alias("more")).where("n = 1")
        only = only.select("conv_id", F.col("call_id").alias("used"), "next", "more")
        # Only circles reach the limit of steps.
        steps = F.least(F.col("steps") + F.coalesce("more", F.lit(0)), F.lit(2**40))
        followed = edges.join(only, ["conv_id", "used"], "left").select(*_KEY, F.coalesce("next", "used").alias("used"), steps.alias("steps"))
        edges = scratch.write(followed.groupBy(*_KEY, "used").agg(F.max("steps").alias("steps")))
        reached = edges.join(done.select("conv_id", F.col("call_id").alias("used"), "level"), ["conv_id", "used"], "left")
        placed = reached.groupBy(*_KEY).agg(F.max(F.col("level") + F.col("steps")).alias("level"), F.every(F.col("level").isNotNull()).alias("known"))
        ready = scratch.write(placed.where("known").select(*_KEY, F.col("level").cast("int").alias("level")))
        if ready.isEmpty():
            return done.unionByName(left.select(*_KEY, F.lit(-1).alias("level")))
        done = scratch.write(done.unionByName(ready))
        left = scratch.write(left.join(ready, _KEY, "left_anti"))
        edges = edges.join(ready, _KEY, "left_anti")
    return done


def link_tool_calls(calls: DataFrame, results: DataFrame, parameters: DataFrame) -> DataFrame:
    """``conv_id, call_id, level, turn, status, errors, json``: one row for each call and each result without one.

    ``calls`` has conv_id, call_id, turn, name, arguments (JSON), uses (call ids); ``results`` conv_id, call_id,
    turn, content; ``parameters`` one row for each tool's parameter: name, parameter, type, required. ``level`` orders
    the calls of a conversation topologically: 0 for one that uses no other call, else one above the highest that it uses; -1 is
    in a circle. Results without a call have level 0. Status is ``linked``, ``no_result``, ``no_call``, ``result_too_early`` (its turn isn't after the
    call's) or ``no_identifier``; errors are those of :func:`argument_errors`. ``json`` holds the call's
    name, canonical arguments (a string if they aren't JSON), identifier and the result's content.

    Of calls, and of results, with one identifier in a conversation the least by (turn, name or content, ...)
    counts, so repeated rows are one. Rows with a null conversation or identifier are linked with nothing and
    returned each. Further columns aren't read. Empty tables give an empty result.
    """
    scratch = Scratch(calls.sparkSession, "chat")
    of_call = ["turn", "name", "arguments", "uses"]
    calls = calls.select(F.col("conv_id").cast("long"), F.col("call_id").cast("string"), F.col("turn").cast("long"), *(F.col(c).cast("string") for c in of_call[1:3]), F.col("uses").cast("array<string>"))
    results = results.select(F.col("conv_id").cast("long"), F.col("call_id").cast("string"), F.col("turn").cast("long").alias("result_turn"), F.col("content").cast("string"))
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()

    unique = calls.where(named).groupBy(*_KEY).agg(F.min(F.struct(*of_call)).alias("call")).select(*_KEY, "call.*")
    answers = results.where(named).groupBy(*_KEY).agg(F.min(F.struct("result_turn", "content")).alias("result")).select(*_KEY, "result.*")
    levels = _levels(unique, scratch)
    status = (
        F.when(F.col("is_call").isNull(), "no_call").when(F.col("is_result").isNull(), "no_result").when(F.col("result_turn") <= F.col("turn"), "result_too_early").otherwise("linked")
    )
    joined = unique.withColumn("is_call", F.lit(True)).join(answers.withColumn("is_result", F.lit(True)), _KEY, "full_outer").withColumn("status", status)
    nameless = calls.where(~named).withColumn("is_call", F.lit(True)).unionByName(results.where(~named), allowMissingColumns=True).withColumn("status", F.lit("no_identifier"))
    rows = joined.drop("is_result").unionByName(nameless, allowMissingColumns=True)

    specified = F.map_from_entries(F.collect_list(F.struct("parameter", F.struct(F.coalesce("type", F.lit("any")).alias("type"), F.coalesce("required", F.lit(False)).alias("required")))))
    # Bounded by the tools' schemas, one row for each parameter of a tool.
    tools = parameters.where("name is not null and parameter is not null").groupBy("name", "parameter").agg(F.min("type").alias("type"), F.max("required").alias("required"))
    tools = tools.groupBy("name").agg(specified.alias("parameters"))
    rows = rows.join(tools, "name", "left").join(levels, _KEY, "left")
    parsed = F.try_parse_json("arguments")
    body = [F.col("call_id").alias("id"), F.col("name").alias("name"), F.col("content").alias("result"), F.col("status").alias("status")]
    message = F.when(parsed.isNotNull(), F.to_json(F.struct(parsed.alias("arguments"), *body))).otherwise(F.to_json(F.struct(F.col("arguments").alias("arguments"), *body)))
    return rows.select(
        *_KEY,
        F.coalesce("level", F.lit(0)).alias("level"),
        F.coalesce("turn", "result_turn").alias("turn"),
        "status",
        F.when(F.col("is_call").isNotNull(), argument_errors(F.col("arguments"), F.col("parameters"))).alias("errors"),
        message.alias("json"),
    )


def conversation_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results in plain conversations: a user's turn calls a tool, and the turn after it, if it is the
    assistant's, is the result. A call uses the call two turns before.

    Texts of up to 60 characters go to ``answer``, longer ones to ``search`` with a limit, which is written as a string where the text
    has an odd number of characters, and left out where that number can be divided by 10.
    """
    said = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    identifier = lambda back: F.concat(F.lit("call_"), (F.col("turn") - back).cast("string"))
    n = F.char_length("text")
    long = n > 60
    number, text = F.when(long & (n % 2 == 0) & (n % 10 != 0), n), F.when(long & (n % 2 == 1), n.cast("string"))
    plain = F.to_json(F.struct(F.col("turn").alias("turn"), F.col("text").alias("question"), number.alias("limit")))
    spelt = F.to_json(F.struct(F.col("turn").alias("turn"), F.col("text").alias("question"), text.alias("limit")))
    calls = said.where("role = 'user'").select(
        "conv_id",
        identifier(0).alias("call_id"),
        "turn",
        F.when(long, "search").otherwise("answer").alias("name"),
        F.when(text.isNotNull(), spelt).otherwise(plain).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(identifier(2))).otherwise(F.array().cast("array<string>")).alias("uses"),
    )
    return calls, said.where("role = 'assistant'").select("conv_id", identifier(1).alias("call_id"), "turn", F.col("text").alias("content"))


def other_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, call_id, level, turn, status, errors, json`` of the turns that are neither call nor result, such as the system's:
    status ``message``, and their role and content as JSON."""
    rest = conversations.where("role is null or role not in ('user', 'assistant')")
    return rest.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.lit(None).cast("string").alias("call_id"),
        F.lit(0).alias("level"),
        F.col("turn").cast("long").alias("turn"),
        F.lit("message").alias("status"),
        F.lit(None).cast("array<string>").alias("errors"),
        F.to_json(F.struct(F.col("text").cast("string").alias("content"), F.col("role").cast("string").alias("role"))).alias("json"),
    )
