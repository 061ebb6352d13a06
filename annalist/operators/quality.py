"""Checks on a batch and its target, as DataFrames ``(check, n_bad, ok)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.spec import ESTABLISHMENTS, TableSpec


class IntegrityError(Exception):
    """A check found bad rows; nothing was written."""


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def report(totals: DataFrame, checks: Mapping[str, str]) -> DataFrame:
    """One row per check from a single row of totals."""
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("n_bad"))
            for name, c in checks.items()
        ]
    )
    return totals.select(F.inline(rows)).withColumn("ok", F.col("n_bad") == 0)


def check_unique(df: DataFrame, keys: Sequence[str], name: str = "unique") -> DataFrame:
    """No key occurs twice."""
    return report(duplicate_keys(df, keys).agg(F.count("*").alias("bad")), {name: "bad"})


def check_no_fanout(joined: DataFrame, batch: DataFrame) -> DataFrame:
    """The join has as many rows as the batch. Both are counted in one pass."""
    signs = joined.select(F.lit(1).alias("n")).unionByName(batch.select(F.lit(-1).alias("n")))
    return report(signs.agg(F.abs(F.sum("n")).alias("bad")), {"no_fanout": "bad"})


def check_intervals(scd: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """No period ends before it starts."""
    return report(scd.agg(F.count_if(_backwards(spec)).alias("bad")), {"intervals": "bad"})


def _backwards(spec: TableSpec) -> Column:
    return F.coalesce(F.col(spec.start) > F.col(spec.end), F.lit(False))


def check_no_overlap(scd: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """No period starts before all earlier ones of its entity have ended.

    Starts are made distinct first, so an entity's window is bounded by the calendar.
    """
    spans = scd.groupBy(spec.key, spec.start).agg(
        F.max(F.coalesce(F.col(spec.end), F.lit("9999-12-31").cast("date"))).alias("until"),
        F.count("*").alias("n"),
    )
    earlier = Window.partitionBy(spec.key).orderBy(spec.start).rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("covered", F.max("until").over(earlier))
    bad = F.count_if((F.col("n") > 1) | F.coalesce(F.col("covered") > F.col(spec.start), F.lit(False)))
    return report(spans.agg(bad.alias("bad")), {"no_overlap": "bad"})


def check_history(scd: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """What must hold of any history before it is published, in one aggregation per entity and start.

    Every row has a key and a start, no period ends before it starts, no two share a start or overlap, and no
    entity has two open periods.
    """
    spans = scd.groupBy(spec.key, spec.start).agg(
        F.max(F.coalesce(F.col(spec.end), F.lit("9999-12-31").cast("date"))).alias("until"),
        F.count("*").alias("n"),
        F.count_if(F.col(spec.end).isNull()).alias("open"),
        F.count_if(_backwards(spec)).alias("backwards"),
    )
    entity = Window.partitionBy(spec.key).orderBy(spec.start)
    earlier = entity.rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumns({"covered": F.max("until").over(earlier), "opened": F.sum("open").over(entity)})
    totals = spans.agg(
        F.sum(F.when(F.col(spec.key).isNull() | F.col(spec.start).isNull(), F.col("n"))).alias("keys"),
        F.sum("backwards").alias("intervals"),
        F.count_if((F.col("n") > 1) | F.coalesce(F.col("covered") > F.col(spec.start), F.lit(False))).alias("no_overlap"),
        F.count_if((F.col("open") > 0) & (F.col("opened") > 1)).alias("one_open"),
    )
    return report(totals, {c: c for c in totals.columns})


def _per_entity(spec: TableSpec, *sides: tuple[DataFrame, Mapping[str, Column]]) -> DataFrame:
    """Sum, per entity, of what the rows of each side contribute.

    Every side is read once, and all are combined in one partly aggregated shuffle.
    """
    names = [n for _, counts in sides for n in counts]
    tagged = [
        df.select(spec.key, *[(counts[n] if n in counts else F.lit(0)).cast("int").alias(n) for n in names])
        for df, counts in sides
    ]
    return reduce(DataFrame.unionByName, tagged).groupBy(spec.key).agg(*[F.sum(n).alias(n) for n in names])


def _target_counts(spec: TableSpec) -> dict[str, Column]:
    return {"target": F.lit(1), "open": F.col(spec.end).isNull(), "backwards": _backwards(spec)}


def _joined_counts() -> dict[str, Column]:
    opened = F.col("has_significant_change") & ~F.coalesce(F.col("in_place"), F.lit(False))
    adds = (opened | F.col("is_new")) & F.col("usable")
    return {"joined": F.lit(1), "added": adds, "unusable": ~F.col("usable")}


_NOT_COVERED = "batch > 0 AND open <> 1"
_UNBALANCED = "sum(abs(target - history - added))"


def check_open_coverage(target: DataFrame, batch: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Every batch entity has exactly one open row in the target."""
    per_entity = _per_entity(spec, (target, {"open": F.col(spec.end).isNull()}), (batch, {"batch": F.lit(1)}))
    return report(per_entity.agg(F.count_if(F.expr(_NOT_COVERED)).alias("bad")), {"open_coverage": "bad"})


def check_row_balance(
    target: DataFrame, batch: DataFrame, history: DataFrame, joined: DataFrame, spec: TableSpec = ESTABLISHMENTS
) -> DataFrame:
    """Target rows = existing rows + rows opened by changes and new entities, per entity.

    ``joined`` is the batch with its open rows and flags (:func:`detect_changes`). A change
    on the start day of the open row replaces it and adds nothing. ``history`` holds the
    existing rows; those of entities outside the batch are left out.
    """
    per_entity = _per_entity(
        spec,
        (target, {"target": F.lit(1)}),
        (batch, {"batch": F.lit(1)}),
        (history, {"history": F.lit(1)}),
        (joined, _joined_counts()),
    ).filter("batch > 0 OR target > 0")
    return report(per_entity.agg(F.expr(_UNBALANCED).alias("bad")), {"row_balance": "bad"})


def integrity_report(
    target: DataFrame, batch: DataFrame, history: DataFrame, joined: DataFrame, spec: TableSpec = ESTABLISHMENTS
) -> DataFrame:
    """All checks on a batch's target from one aggregation.

    ``usable`` counts records without a key or a date, or dated before the open row that they would end; they
    change nothing in the target, and their batch must not be applied.
    """
    per_entity = _per_entity(
        spec,
        (target, _target_counts(spec)),
        (batch, {"batch": F.lit(1)}),
        (history, {"history": F.lit(1)}),
        (joined, _joined_counts()),
    ).filter("batch > 0 OR target > 0")
    totals = per_entity.agg(
        F.count_if(F.col("batch") > 1).alias("batch_unique"),
        F.sum(F.abs(F.col("joined") - F.col("batch"))).alias("no_fanout"),
        F.sum("unusable").alias("usable"),
        F.sum("backwards").alias("intervals"),
        F.count_if(F.expr(_NOT_COVERED)).alias("open_coverage"),
        F.expr(_UNBALANCED).alias("row_balance"),
    )
    return report(totals, {c: c for c in totals.columns})


def check_rescued(df: DataFrame, rescue: str, share: float = 0.0) -> DataFrame:
    """Per column, the rows whose value did not cast; not ok where they are more than the share of all rows.

    One row per column that has any, as ``(check, n_bad, ok)``, ``check`` being ``rescued:`` and the column.
    """
    counts = df.select(F.explode(F.map_keys(rescue)).alias("_c")).groupBy("_c").agg(F.count("*").alias("n_bad"))
    total = df.agg(F.count("*")).scalar()
    return counts.select(
        F.concat(F.lit("rescued:"), "_c").alias("check"), "n_bad", (F.col("n_bad") <= F.lit(share) * total).alias("ok")
    )


def require_ok(report: DataFrame) -> None:
    """Raise when a check failed. A report has one row per check, so it is small."""
    bad = [f"{r['check']}: {r['n_bad']}" for r in report.filter(~F.col("ok")).collect()]
    if bad:
        raise IntegrityError("; ".join(bad))
