"""Joins between sources, batches and the history table.

None carries a broadcast hint: the sizes are not known when the plan is written.
Adaptive execution measures each side, broadcasts the ones below
``spark.sql.autoBroadcastJoinThreshold`` and splits skewed partitions of the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import month_at, month_index
from annalist.operators.rows import open_rows
from annalist.spec import ESTABLISHMENTS, TableSpec


def history_semi(history: DataFrame, keys: DataFrame, key: str = ESTABLISHMENTS.key) -> DataFrame:
    """Periods of the listed entities only."""
    return history.join(keys, key, "left_semi").select(*history.columns)


def enrich_history(history: DataFrame, stock: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """Give every period the attributes that the source keeps for the present only."""
    return history.join(stock.select(key, *attrs), key, "inner")


def affected_history(scd: DataFrame, batch: DataFrame, key: str = ESTABLISHMENTS.key) -> DataFrame:
    """All periods of the entities in a batch. A small batch is broadcast, so the table stays in place.

    The keys are made distinct before they move, whatever a hot entity's share of the batch
    is; the join then uses the partitioning that gives.
    """
    return scd.join(batch.select(key).distinct(), key, "left_semi").select(*scd.columns)


def _side_by_side(batch: DataFrame, rows: DataFrame, spec: TableSpec) -> DataFrame:
    b, s = batch.alias("b"), rows.alias("s")
    joined = b.join(s, F.col(f"b.{spec.key}") == F.col(f"s.{spec.key}"), "left")
    return joined.select(
        F.col(f"b.{spec.key}").alias(spec.key),
        F.struct("b.*").alias("incoming"),
        F.struct("s.*").alias("current"),
    )


def batch_vs_open(batch: DataFrame, scd: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """One row per batch entity: the ``incoming`` record and the ``current`` open row.

    The two sides are structs, so equal column names need no suffixes; ``current``
    has NULL fields when the entity has no open row.
    """
    return _side_by_side(batch, open_rows(affected_history(scd, batch, spec.key), spec), spec)


def batch_to_history(batch: DataFrame, scd: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Every batch entity with each of its periods (one row of NULLs for an unseen entity)."""
    return _side_by_side(batch, affected_history(scd, batch, spec.key), spec)


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the target not matched by an update, plus all updates."""
    untouched = target.join(updates.select(*keys), list(keys), "left_anti")
    # a join by column names moves them to the front
    return untouched.select(*target.columns).unionByName(updates.select(*target.columns))


def active_months(start: Column, end: Column, first: Column, last: Column) -> tuple[Column, Column]:
    """First and last month index whose first day lies strictly inside a period.

    Both bounds are strict: a period that starts or ends on the first of a month does
    not cover that day. The result is empty when the first index is after the last.
    """
    lo = F.greatest(month_index(start) + F.lit(1), first)
    hi = F.when(end.isNull(), last).otherwise(F.least(month_index(F.date_sub(end, 1)), last))
    return F.when(start.isNotNull(), lo), hi


def interval_active_join(scd: DataFrame, months: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Every period of an active entity with each month start that lies strictly inside it.

    The month list is a gapless calendar, so each row computes its own first and last
    month and generates the months between, instead of comparing with all of them.
    """
    month = months.columns[0]
    first = months.agg(F.min(month_index(month))).scalar()
    last = months.agg(F.max(month_index(month))).scalar()
    lo, hi = active_months(F.col(spec.start), F.col(spec.end), first, last)
    return (
        scd.filter(F.col(spec.state) == spec.active_state)
        .withColumns({"_lo": lo, "_hi": hi})
        .filter("_lo <= _hi")
        .withColumn("_at", F.explode(F.sequence("_lo", "_hi")))
        .withColumn("month", month_at("_at"))
        .drop("_lo", "_hi", "_at")
    )


def dense_grid(scd: DataFrame, months: DataFrame, dims: Mapping[str, Column]) -> DataFrame:
    """All months for every combination of the dimensions that occurs.

    The combinations are made distinct first; the months then come from the calendar's
    bounds, so the product is generated row by row and needs no join.
    """
    month = months.columns[0]
    first = months.agg(F.min(month_index(month))).scalar()
    last = months.agg(F.max(month_index(month))).scalar()
    grid = month_grid(scd, first, last, dims)
    return grid.select(month_at("at").alias("month"), *dims)


def month_grid(scd: DataFrame, first: Column, last: Column, dims: Mapping[str, Column]) -> DataFrame:
    """Every occurring combination of the dimensions with each month index ``at`` in the range."""
    pairs = scd.select(*[c.alias(n) for n, c in dims.items()]).distinct()
    return pairs.filter(first <= last).select(*dims, F.explode(F.sequence(first, last)).alias("at"))


def zero_filled_star_join(grid: DataFrame, measures: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """The grid with each measure, 0 where there is none.

    The measures are stacked and summed per key first, so one join replaces one per
    measure. NULL keys match nothing and stay 0.
    """
    stacked = reduce(
        DataFrame.unionByName,
        [
            df.select(*keys, *[(F.col(m) if m == name else F.lit(0)).cast("bigint").alias(m) for m in measures])
            for name, df in measures.items()
        ],
    )
    summed = stacked.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    filled = [F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in measures]
    return grid.join(summed, list(keys), "left").select(*keys, *filled)
