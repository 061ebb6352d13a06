"""Monthly measures over a history table, all exact distinct counts of entities.

An active period is reduced to a change of +1 in its first month and -1 after its last, so
an entity that is active for twenty years costs two rows and not 240, and joining every
month with every period is not needed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from annalist.functions import month_at, month_floor, month_index, month_number, prefix
from annalist.operators.joins import active_months, month_grid
from annalist.spec import ESTABLISHMENTS, TableSpec

CREATION, CLOSURE, REOPENING = range(3)
MEASURES = ("nb_active", "nb_creations", "nb_closures", "nb_reopenings")


def default_dims(spec: TableSpec = ESTABLISHMENTS) -> dict[str, Column]:
    return {"ape_code": F.col(spec.sector), "department": prefix(spec.area)}


def calendar_spine(spark: SparkSession, start: dt.date, end: dt.date, unit: str = "month") -> DataFrame:
    """Unit starts from ``start`` on, up to but excluding the unit that ``end`` falls in."""
    stop = F.date_trunc(unit, F.lit(end)).cast("date")
    begin = F.date_trunc(unit, F.lit(start)).cast("date")
    days = F.sequence(begin, F.greatest(begin, F.lit(end)), F.expr(f"INTERVAL 1 {unit}"))
    return spark.range(1).select(F.explode(F.filter(days, lambda d: d < stop)).alias(f"{unit}_start"))


def spine_bounds(start: dt.date, end: dt.date) -> tuple[int, int]:
    """First and last month index of the monthly spine."""
    return month_number(start), month_number(end) - 1


def _entered(scd: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep the periods in which the entity enters the state, not those that only go on with it."""
    earlier = Window.partitionBy(spec.key).orderBy(spec.start)
    return (
        scd.withColumn("_before", F.lag(spec.state).over(earlier))
        .withColumn("_entered", F.coalesce(F.col("_before") != F.col(spec.state), F.lit(True)))
        .drop("_before")
    )


def active_ranges(
    scd: DataFrame,
    bounds: tuple[int, int],
    dims: Mapping[str, Column],
    spec: TableSpec = ESTABLISHMENTS,
    disjoint: bool = False,
) -> DataFrame:
    """Month ranges ``(dims, lo, hi)`` in which an entity is active; those of one entity and dims do not overlap.

    Counting the ranges that cover a month therefore equals counting distinct entities.
    Overlapping periods are cut to what they add, which takes a shuffle by entity. A
    table that passed ``check_no_overlap`` has none, and ``disjoint`` saves the shuffle.
    """
    names = list(dims)
    lo, hi = active_months(F.col(spec.start), F.col(spec.end), F.lit(bounds[0]), F.lit(bounds[1]))
    ranges = (
        scd.filter(F.col(spec.state) == spec.active_state)
        .select(spec.key, *[c.alias(n) for n, c in dims.items()], lo.alias("lo"), hi.alias("hi"))
        .filter("lo <= hi")
    )
    if not disjoint:
        # One row per entity and first month is left for the window, however many rows a hot
        # entity has; equal ones are combined before the shuffle.
        ranges = ranges.groupBy(spec.key, *names, "lo").agg(F.max("hi").alias("hi"))
        earlier = Window.partitionBy(spec.key, *names).orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
        covered = F.max("hi").over(earlier)
        ranges = ranges.withColumn("lo", F.greatest(F.col("lo"), covered + F.lit(1))).filter("lo <= hi")
    return ranges.select(*names, "lo", "hi")


def _active_changes(ranges: DataFrame, names: Sequence[str], last: int) -> DataFrame:
    """+1 where a range begins and -1 after its end, as rows ``(dims, at, nb_active)``."""
    at = F.explode(F.array(F.col("lo"), F.col("hi") + F.lit(1)))
    change = F.when(F.col("at") == F.col("lo"), 1).otherwise(-1)
    return ranges.select(*names, "lo", at.alias("at")).filter(F.col("at") <= last).select(
        *names, "at", change.alias("nb_active")
    )


def _month_events(
    scd: DataFrame, bounds: tuple[int, int], dims: Mapping[str, Column], spec: TableSpec, transitions_only: bool
) -> DataFrame:
    """Distinct creations, closures and reopenings of entities, as rows ``(dims, at, <measure> = 1)``."""
    entered = F.col("_entered") if transitions_only else F.lit(True)
    state, created, started = F.col(spec.state), month_index(spec.created_on), month_index(spec.start)
    begun = F.when((state == spec.closed_state) & entered, CLOSURE).when(
        (state == spec.active_state) & entered & (started != created), REOPENING
    )
    events = F.array(
        F.struct(F.lit(CREATION).alias("kind"), created.alias("at")), F.struct(begun.alias("kind"), started.alias("at"))
    )
    names = list(dims)
    distinct = (
        scd.select(spec.key, *[c.alias(n) for n, c in dims.items()], F.inline(events))
        .filter(F.col("kind").isNotNull() & F.col("at").between(*bounds))
        .distinct()
    )
    codes = {"nb_creations": CREATION, "nb_closures": CLOSURE, "nb_reopenings": REOPENING}
    return distinct.select(*names, "at", *[(F.col("kind") == k).cast("int").alias(m) for m, k in codes.items()])


def nb_active(
    scd: DataFrame,
    bounds: tuple[int, int],
    dims: Mapping[str, Column] | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    disjoint: bool = False,
) -> DataFrame:
    """Distinct entities active on each month start within the bounds, for groups that have any."""
    dims = dims or default_dims(spec)
    names = list(dims)
    changes = _active_changes(active_ranges(scd, bounds, dims, spec, disjoint), names, bounds[1])
    monthly = changes.groupBy(*names, "at").agg(F.sum("nb_active").alias("change"))
    # one row per group and month with a change, so a group is bounded by the calendar
    by_month = Window.partitionBy(*names).orderBy("at")
    until = F.coalesce(F.lead("at").over(by_month) - F.lit(1), F.lit(bounds[1]))
    return (
        monthly.select(*names, "at", F.sum("change").over(by_month).alias("nb_active"), until.alias("until"))
        .filter("nb_active > 0")
        .select(*names, "nb_active", F.explode(F.sequence("at", "until")).alias("at"))
        .select(month_at("at").alias("month"), *names, "nb_active")
    )


def _count_by_month(
    scd: DataFrame, month: Column, measure: str, dims: Mapping[str, Column] | None, spec: TableSpec
) -> DataFrame:
    """Distinct entities per month and dims; Spark makes them distinct before it groups by month."""
    dims = dims or default_dims(spec)
    return (
        scd.select(spec.key, month.alias("month"), *[c.alias(n) for n, c in dims.items()])
        .groupBy("month", *dims)
        .agg(F.count_distinct(spec.key).alias(measure))
    )


def nb_creations(
    scd: DataFrame, dims: Mapping[str, Column] | None = None, spec: TableSpec = ESTABLISHMENTS
) -> DataFrame:
    """Distinct entities per month of creation; one with several sectors counts once in each."""
    created = scd.filter(F.col(spec.created_on).isNotNull())
    return _count_by_month(created, month_floor(spec.created_on), "nb_creations", dims, spec)


def nb_closures(
    scd: DataFrame,
    dims: Mapping[str, Column] | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    transitions_only: bool = False,
) -> DataFrame:
    """Distinct entities per month in which a closed period starts."""
    if transitions_only:
        scd = _entered(scd, spec).filter("_entered")
    closed = scd.filter((F.col(spec.state) == spec.closed_state) & F.col(spec.start).isNotNull())
    return _count_by_month(closed, month_floor(spec.start), "nb_closures", dims, spec)


def nb_reopenings(
    scd: DataFrame,
    dims: Mapping[str, Column] | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    transitions_only: bool = False,
) -> DataFrame:
    """Distinct entities per month in which an active period starts, the month of creation excepted."""
    if transitions_only:
        scd = _entered(scd, spec).filter("_entered")
    started = month_floor(spec.start)
    again = scd.filter((F.col(spec.state) == spec.active_state) & (started != month_floor(spec.created_on)))
    return _count_by_month(again, started, "nb_reopenings", dims, spec)


def sector_trends(
    scd: DataFrame,
    start: dt.date,
    end: dt.date,
    dims: Mapping[str, Column] | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    transitions_only: bool = False,
    disjoint: bool = False,
) -> DataFrame:
    """Every month and occurring group with its four measures, 0 where there is nothing.

    The grid's zeros and the measures' counts are stacked and summed once, so no join is
    needed. Groups with a NULL dimension keep zeros.
    """
    dims = dims or default_dims(spec)
    names, bounds = list(dims), spine_bounds(start, end)
    zeros = month_grid(scd, F.lit(bounds[0]), F.lit(bounds[1]), dims)
    grouped = _entered(scd, spec) if transitions_only else scd
    for column in dims.values():
        grouped = grouped.filter(column.isNotNull())
    active = _active_changes(active_ranges(grouped, bounds, dims, spec, disjoint), names, bounds[1])
    events = _month_events(grouped, bounds, dims, spec, transitions_only)
    return complete_months([active, events, zeros], names)


def complete_months(parts: Sequence[DataFrame], names: Sequence[str]) -> DataFrame:
    """Trends from stacked rows ``(names, at)`` with some of the measures each; ``nb_active`` is a change that is added up."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    monthly = stacked.groupBy(*names, "at").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES]
    )
    running = Window.partitionBy(*names).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select(
        month_at("at").alias("month"),
        *names,
        F.sum("nb_active").over(running).alias("nb_active"),
        *[m for m in MEASURES if m != "nb_active"],
    )


def _group_columns(trends: DataFrame) -> list[str]:
    return [c for c in trends.columns if c != "month" and c not in MEASURES and c not in _SCORES]


_SCORES = ("net_growth", "dynamism_score")


def net_growth(trends: DataFrame) -> DataFrame:
    """Add the change in active entities since the group's previous month, NULL in its first."""
    by_month = Window.partitionBy(*_group_columns(trends)).orderBy("month")
    return trends.withColumn("net_growth", F.col("nb_active") - F.lag("nb_active").over(by_month))


def dynamism_score(trends: DataFrame) -> DataFrame:
    """Add the balance of openings and closures per 100 active entities, NULL when none is active."""
    balance = (F.col("nb_creations") + F.col("nb_reopenings") - F.col("nb_closures")).cast("double")
    score = F.round(balance * F.lit(100.0) / F.col("nb_active"), 2)
    return trends.withColumn("dynamism_score", F.when(F.col("nb_active") > 0, score))


def regional_activity(trends: DataFrame) -> DataFrame:
    """The trends with net growth and dynamism score."""
    return dynamism_score(net_growth(trends))


def ordered_output(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Order for a stored table: sorted inside each file, in ranges of the leading key."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
