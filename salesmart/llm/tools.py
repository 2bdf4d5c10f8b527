"""Tool-call linking (operator 9): calls, results and schemas to canonical JSON.

DataFrame functions only.  ``link`` takes two tables:

* calls: conv_id, call_id, name, arguments (JSON text), needs (identifier of
  the call or result that it waits for, or null), and ``seq`` (its place);
* results: conv_id, result_id, call_id, content.

It hash-joins results to calls by identifier, orders the calls topologically
(``depth``: number of calls that come before it along ``needs``), validates the
arguments against the tool's schema, and serialises each linked call as
canonical JSON: keys sorted, no blanks, non-ASCII characters as they are.

Scale: identifiers are unique, so no join has a hot key and a conversation of
any length is spread out.  Depths come from pointer doubling: a chain of n
calls takes log2(n) joins, each staged.  The result is range-sorted by
conversation, depth and identifier, which splits a long conversation.

Edge cases: of repeated identifiers the first (smallest seq, then content)
counts and the others are marked: ``duplicate`` for calls, ``extra`` for further results of a call;
a result without call is ``orphan``; a call without result has no result key; a
need that nobody answers is a root; calls in a cycle, or behind one, have a
null depth and come last; null identifiers link with nothing; invalid JSON or
missing, mistyped and unknown arguments are listed in ``errors``.  Extra columns
of any name are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, stage

#: Parameter type of a schema -> type of the parsed value.
KINDS = {"string": ("STRING",), "integer": ("BIGINT",), "boolean": ("BOOLEAN",),
         "number": ("BIGINT", "DECIMAL", "DOUBLE")}


def validate(name: Column, arguments: Column, schemas: Mapping[str, Mapping[str, tuple[str, bool]]]) -> Column:
    """Array of errors.  ``schemas``: tool -> parameter -> (type, required)."""
    parsed = F.try_parse_json(arguments)
    keys = F.coalesce(F.json_object_keys(arguments), F.array().cast("array<string>"))
    errors = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, parameters in schemas.items():
        checks = []
        for parameter, (kind, required) in sorted(parameters.items()):
            there = F.array_contains(keys, parameter)
            value = F.try_variant_get(parsed, f"$['{parameter}']", "variant")
            found = F.split(F.schema_of_variant(value), r"\(")[0]
            good = found.isin(*KINDS[kind])
            checks.append(F.when(~there, F.lit(f"missing {parameter}") if required else F.lit(None))
                          .when(~F.coalesce(good, F.lit(False)), F.lit(f"{parameter} is no {kind}")))
        unknown = F.transform(F.filter(keys, lambda k: ~k.isin(*parameters)), lambda k: F.concat(F.lit("unknown "), k))
        own = F.concat(F.array_compact(F.array(*checks)), F.array_sort(unknown))
        errors = F.when(name == tool, own).otherwise(errors)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    return F.when(~is_object, F.array(F.lit("arguments are no JSON object"))).otherwise(errors)


def depths(links: DataFrame) -> DataFrame:
    """call_id, depth of ``links`` (call_id, parent or null); null in and behind cycles."""
    state = stage(links.select("call_id", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1)
                               .cast("long").alias("steps")))
    limit = max(state.count(), 1).bit_length() + 1
    for _ in range(limit):
        if not state.filter("up is not null").head(1):
            break
        above = state.select(F.col("call_id").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"))
        state = stage(state.join(above, "up", "left").select(
            "call_id", F.col("up2").alias("up"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps")))
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("steps")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, schemas) -> DataFrame:
    """One row per call, and per result that is not linked to one.

    conv_id, call_id, kind (call, duplicate, orphan or extra), depth, name, valid,
    errors, result_id, canonical.
    """
    calls = calls.select("conv_id", "call_id", "name", "arguments", "needs", "seq")
    results = stage(results.select("conv_id", "result_id", "call_id", "content", F.monotonically_increasing_id().alias("row")))
    ranked = stage(calls.withColumn("row", F.monotonically_increasing_id()))
    order = F.struct("seq", F.coalesce("name", F.lit("")), F.coalesce("arguments", F.lit("")), "row")
    firsts = stage(ranked.filter("call_id is not null").groupBy("call_id").agg(F.min(order).alias("first")).select(
        "call_id", F.col("first.row").alias("row")))
    marked = ranked.join(firsts.withColumnRenamed("row", "first_row"), "call_id", "left").withColumn(
        "kind", F.when(F.col("call_id").isNull() | (F.col("row") == F.col("first_row")), "call").otherwise("duplicate"))
    marked = stage(marked.drop("first_row"))

    answers = stage(results.filter("call_id is not null").groupBy("call_id").agg(F.min(F.struct(
        F.col("result_id"), F.col("content"), F.col("conv_id"), F.col("row"))).alias("answer")))
    ids = marked.filter("kind = 'call' and call_id is not null")
    # a need names a call, or a result and so the call it answers
    names = ids.select(F.col("call_id").alias("needs"), F.col("call_id").alias("parent")).unionByName(
        answers.select(F.col("answer.result_id").alias("needs"), F.col("call_id").alias("parent"))
        .join(ids.select(F.col("call_id").alias("parent")), "parent"))
    names = stage(names.groupBy("needs").agg(F.min("parent").alias("parent")))
    parents = ids.select("call_id", "needs").join(names, "needs", "left").select("call_id", "parent")
    depth = depths(parents)

    linked = marked.join(depth, "call_id", "left").join(answers, "call_id", "left")
    first = F.col("kind") == "call"
    errors = validate(F.col("name"), F.col("arguments"), schemas)
    linked = linked.select(
        "conv_id", "call_id", "kind", F.when(first, F.col("depth")).alias("depth"), "name", errors.alias("errors"),
        F.when(first, F.col("answer.result_id")).alias("result_id"),
        F.when(first, F.col("answer.content")).alias("content"), "arguments")
    valid = F.size("errors") == 0
    linked = linked.select(
        "conv_id", "call_id", "kind", "depth", "name", valid.alias("valid"), "errors", "result_id",
        F.when(valid, canonical(F.col("name"), F.col("call_id"), F.col("arguments"), F.col("content"), schemas)).alias("canonical"))
    def apart(rows: DataFrame, kind: str, error: str) -> DataFrame:
        return rows.select(
            "conv_id", "call_id", F.lit(kind).alias("kind"), F.lit(None).cast("long").alias("depth"),
            F.lit(None).cast("string").alias("name"), F.lit(False).alias("valid"),
            F.array(F.lit(error)).alias("errors"), "result_id", F.lit(None).cast("string").alias("canonical"))

    orphans = results.join(ids.select("call_id"), "call_id", "left_anti")
    further = (results.join(answers.select("call_id", F.col("answer.row").alias("first_row")), "call_id")
               .filter(F.col("row") != F.col("first_row")).join(ids.select("call_id"), "call_id", "left_semi"))
    out = (linked.unionByName(apart(orphans, "orphan", "no call"))
           .unionByName(apart(further, "extra", "duplicate result")))
    order = ["conv_id", F.col("depth").asc_nulls_last(), "call_id", "result_id"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order)


def canonical(name: Column, call_id: Column, arguments: Column, result: Column, schemas) -> Column:
    """{"arguments":{...},"id":...,"name":...,"result":...} with the keys of all objects sorted."""
    types = {"string": "string", "integer": "bigint", "number": "double", "boolean": "boolean"}
    out = F.lit(None).cast("string")
    for tool, parameters in schemas.items():
        fields = ", ".join(f"`{p}` {types[kind]}" for p, (kind, _) in sorted(parameters.items()))
        body = F.from_json(arguments, fields)
        out = F.when(name == tool, F.to_json(F.struct(
            body.alias("arguments"), call_id.alias("id"), name.alias("name"), result.alias("result")))).otherwise(out)
    return out


#: The tool that turns of a conversation are read as calls of.
REPLY = {"reply": {"prompt": ("string", True), "role": ("string", True), "turn": ("integer", True)}}


def identifier(conv: Column, turn: Column) -> Column:
    return F.concat_ws(":", conv.cast("string"), turn.cast("string"))


def conversation_calls(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Read turns (conv_id, turn, role, text) as calls and results.

    Every turn that is not the assistant's calls ``reply`` with its text; an
    assistant turn is the result of the call right before it; a call needs the
    turn before it.  A null conv_id or turn gives a null identifier.
    """
    conv, turn, role = column(df, "conv_id"), column(df, "turn"), column(df, "role")
    whole = conv.isNotNull() & turn.isNotNull()
    own, before = F.when(whole, identifier(conv, turn)), F.when(whole, identifier(conv, turn - 1))
    arguments = F.to_json(F.struct(column(df, "text").alias("prompt"), role.alias("role"), turn.alias("turn")))
    assistant = F.coalesce(role == "assistant", F.lit(False))
    calls = df.filter(~assistant).select(
        conv.alias("conv_id"), own.alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"),
        before.alias("needs"), turn.alias("seq"))
    results = df.filter(assistant).select(
        conv.alias("conv_id"), own.alias("result_id"), before.alias("call_id"), column(df, "text").alias("content"))
    return calls, results
