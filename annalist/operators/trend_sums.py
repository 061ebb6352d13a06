"""Trends kept as sums that a batch changes by what it touches.

The sums of a history say, per group and month, how many entities become active less those that stop, and how many are
created, closed and reopened; and per group how many periods it has. All are sums over entities, so the sums after
a batch are those before it plus the signed difference of the touched entities. The history is then
read for these entities only, and trends of any range of months are made from the sums, which are
as small as the trends.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import month_number
from annalist.operators.joins import affected_history
from annalist.operators.trends import (
    MEASURES,
    _active_changes,
    _entered,
    _month_events,
    active_ranges,
    complete_months,
    default_dims,
    spine_bounds,
)
from annalist.session import materialize
from annalist.spec import ESTABLISHMENTS, TableSpec

#: rows of a group; its NULL month holds them
PERIODS = "n_periods"
SUMS = (*MEASURES, PERIODS)
#: every month that a date can lie in
ALL_MONTHS = month_number(dt.date.min), month_number(dt.date.max)


def _summed(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    sums = rows.groupBy(*names, "at").agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in SUMS])
    return sums.filter(" OR ".join(f"{m} != 0" for m in SUMS))


def trend_sums(
    scd: DataFrame,
    dims: Mapping[str, Column] | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    transitions_only: bool = False,
    disjoint: bool = False,
) -> DataFrame:
    """Sums ``(dims, at, measures, n_periods)`` of a history, over all months; rows of zeros are left out.

    ``nb_active`` is the change at a month; ``at`` counts months. Groups with a NULL dimension have ``n_periods`` only.
    """
    dims = dims or default_dims(spec)
    names = list(dims)
    grouped = _entered(scd, spec) if transitions_only else scd
    for column in dims.values():
        grouped = grouped.filter(column.isNotNull())
    active = _active_changes(active_ranges(grouped, ALL_MONTHS, dims, spec, disjoint), names, ALL_MONTHS[1])
    events = _month_events(grouped, ALL_MONTHS, dims, spec, transitions_only)
    periods = scd.select(
        *[c.alias(n) for n, c in dims.items()], F.lit(None).cast("int").alias("at"), F.lit(1).alias(PERIODS)
    )
    stacked = active.unionByName(events, allowMissingColumns=True).unionByName(periods, allowMissingColumns=True)
    return _summed(stacked, names)


def _negative(sums: DataFrame) -> DataFrame:
    return sums.withColumns({m: -F.col(m) for m in SUMS})


def add_sums(sums: DataFrame, change: DataFrame) -> DataFrame:
    """The sums after a change; a NULL dimension or month is a value like any other."""
    names = [c for c in sums.columns if c not in ("at", *SUMS)]
    return _summed(sums.unionByName(change), names)


def trend_changes(
    before: DataFrame,
    after: DataFrame,
    touched: DataFrame,
    dims: Mapping[str, Column] | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    transitions_only: bool = False,
    disjoint: bool = False,
) -> DataFrame:
    """What a batch changes in the sums: those of the touched entities after it less those before.

    ``touched`` lists, by key, all entities whose periods may differ; others are not read beyond their key.
    """
    dims = dims or default_dims(spec)
    stored = {name: f"_dim{i}" for i, name in enumerate(dims)}
    kept = dict.fromkeys([spec.key, spec.state, spec.created_on, spec.start, spec.end])
    columns = [*kept, *[column.alias(stored[name]) for name, column in dims.items()]]
    by = {name: F.col(column) for name, column in stored.items()}
    sides = []
    for scd in (before, after):
        # each history is scanned once, for what the sums are made of; summed, three ways, are the touched entities' periods
        periods = materialize(affected_history(scd, touched, spec.key).select(*columns), "touched-periods")
        sides.append(trend_sums(periods, by, spec, transitions_only, disjoint))
    return add_sums(sides[1], _negative(sides[0]))


def trends_from_sums(sums: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The same rows as ``sector_trends`` of the history that was summed."""
    names = [c for c in sums.columns if c not in ("at", *SUMS)]
    first, last = spine_bounds(start, end)
    sums = sums.filter(F.lit(first <= last))  # no month, no row
    groups = sums.filter(F.col("at").isNull() & (F.col(PERIODS) > 0))
    zeros = groups.select(*names, F.explode(F.sequence(F.lit(first), F.lit(max(first, last)))).alias("at"))
    counted = sums.filter(F.col("at") <= last)
    active = counted.filter("nb_active != 0").select(*names, F.greatest("at", F.lit(first)).alias("at"), "nb_active")
    events = counted.filter(F.col("at") >= first).select(*names, "at", *[m for m in MEASURES if m != "nb_active"])
    return complete_months([active, events, zeros], names)
