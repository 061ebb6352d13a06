"""Chat formatting: tool calls and their results as canonical JSON, on built-in functions only.

Calls and results are hash-joined by the call's identifier, after both were combined by it, so an
identifier that occurs very often is one row. A call comes after its parent: depths are
found by pointer doubling, in as many joins as the longest chain has binary digits, and calls are placed
in their conversation by depth. Arguments are parsed as variants and held against the tool's schema. A
variant keeps the keys of objects sorted, so what is written is canonical: sorted keys and no blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.sharding import global_position
from annalist.session import materialize

_KIND = {
    "integer": ["BIGINT"],
    "number": ["BIGINT", "DECIMAL", "DOUBLE"],
    "string": ["STRING"],
    "boolean": ["BOOLEAN"],
    "array": ["ARRAY"],
    "object": ["OBJECT"],
}


def _kind(value: Column) -> Column:
    """Type of a variant without its parameters."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _fits(value: Column, kind: Column) -> Column:
    found = _kind(value)
    out = F.lit(False)
    for name, types in _KIND.items():
        out = out | ((kind == name) & found.isin(types))
    return F.coalesce(out, F.lit(False))


def depths(calls: DataFrame) -> DataFrame:
    """Rows (call_id, parent_id) to rows (call_id, depth): null on and below a cycle.

    A call without a parent, or whose parent is no call, has depth 0.
    """
    ids = calls.select(F.col("call_id").alias("parent_id"))
    known = calls.join(ids.withColumn("there", F.lit(True)), "parent_id", "left").select(
        "call_id", F.when(F.col("there"), F.col("parent_id")).alias("above")
    )
    nodes = materialize(known.withColumn("depth", F.when(F.col("above").isNull(), 0).otherwise(1)), "chains")
    rounds = nodes.count().bit_length() + 1
    for _ in range(rounds):
        if nodes.filter("above is not null").isEmpty():
            break
        up = nodes.select(F.col("call_id").alias("above"), F.col("above").alias("next"), F.col("depth").alias("more"))
        moved = nodes.filter("above is not null").join(up, "above").select(
            "call_id", F.col("next").alias("above"), (F.col("depth") + F.col("more")).alias("depth")
        )
        nodes = materialize(nodes.filter("above is null").unionByName(moved), "chains")
    return nodes.select("call_id", F.when(F.col("above").isNull(), F.col("depth")).alias("depth"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: conv_id, call_id, position, depth, n_calls, n_results, status, record.

    ``calls``: conv_id, call_id, parent_id, name, arguments (JSON text). ``results``: call_id, turn,
    content. ``schemas``: name, arguments array<struct<argument, kind, required>>, one row per tool. Calls without an
    identifier are left out; of calls with equal identifiers the smallest is taken, of results the first
    by turn. ``position`` counts from 0 within the conversation by depth and identifier; calls on a
    cycle come last. The status is the first that holds of: cycle, unknown_tool, invalid_json,
    missing_argument, wrong_type, unknown_argument, missing_result, several_results, ok. Arguments
    that are no JSON object are null in the record. Empty tables give an empty table; other columns are ignored.
    """
    fields = F.struct("conv_id", "parent_id", "name", "arguments")
    calls = calls.filter("call_id is not null").groupBy("call_id").agg(
        F.min(fields).alias("call"), F.count("*").alias("n_calls")
    )
    calls = materialize(calls.select("call_id", "call.*", "n_calls"), "calls")
    first = results.filter("call_id is not null").groupBy("call_id").agg(
        F.min(F.struct(F.coalesce("turn", F.lit((1 << 62))).alias("turn"), "content")).getField("content").alias("content"),
        F.count("*").alias("n_results"),
    )
    tools = schemas.groupBy("name").agg(F.min("arguments").alias("wanted"))
    joined = (
        calls.join(first, "call_id", "left")
        .join(tools, "name", "left")
        .join(depths(calls.select("call_id", "parent_id")), "call_id")
        .withColumn("n_results", F.coalesce("n_results", F.lit(0)))
        .withColumn("parsed", F.try_parse_json("arguments"))
    )
    is_object = F.coalesce(_kind(F.col("parsed")) == "OBJECT", F.lit(False))
    given = F.from_json(F.when(is_object, F.to_json("parsed")), "map<string, variant>")
    joined = joined.withColumn("given", given)
    wanted, have = F.col("wanted"), F.col("given")
    missing = F.exists(wanted, lambda w: w["required"] & ~F.map_contains_key(have, w["argument"]))
    wrong = F.exists(
        wanted, lambda w: F.map_contains_key(have, w["argument"]) & ~_fits(F.try_element_at(have, w["argument"]), w["kind"])
    )
    extra = F.size(F.array_except(F.map_keys(have), F.transform(wanted, lambda w: w["argument"]))) > 0
    status = (
        F.when(F.col("depth").isNull(), "cycle")
        .when(wanted.isNull(), "unknown_tool")
        .when(~is_object, "invalid_json")
        .when(missing, "missing_argument")
        .when(wrong, "wrong_type")
        .when(extra, "unknown_argument")
        .when(F.col("n_results") == 0, "missing_result")
        .when(F.col("n_results") > 1, "several_results")
        .otherwise("ok")
    )
    record = F.to_json(
        F.struct(
            F.when(is_object, F.col("parsed")).alias("arguments"),
            F.col("call_id").alias("id"),
            F.col("name"),
            F.col("parent_id").alias("parent"),
            F.col("content").alias("result"),
        ),
        {"ignoreNullFields": "false"},
    )
    done = joined.select(
        "conv_id", "call_id", F.col("depth").cast("long").alias("depth"), "n_calls", "n_results", status.alias("status"), record.alias("record")
    )
    # a place for every call, whatever the length of its conversation
    late = F.coalesce("depth", F.lit(1 << 62))
    placed = global_position(done.withColumn("__late", late), ["conv_id", "__late", "call_id"], "__g")
    starts = placed.groupBy("conv_id").agg(F.min("__g").alias("__first")).withColumnRenamed("conv_id", "__conv")
    return placed.join(starts, F.col("conv_id").eqNullSafe(F.col("__conv"))).select(
        "conv_id",
        "call_id",
        (F.col("__g") - F.col("__first")).alias("position"),
        "depth",
        "n_calls",
        "n_results",
        "status",
        "record",
    )
