"""Type-2 history: initial load, change detection and the effect of one batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.functions import as_date, differs
from annalist.operators.joins import batch_to_history, enrich_history
from annalist.operators.quality import report
from annalist.operators.rows import conditional_overwrite, single_period
from annalist.spec import ESTABLISHMENTS, TableSpec

GREATEST, EFFECTIVE_FIRST = "greatest", "effective_first"


# --- initial load -------------------------------------------------------------------


def max_treated(df: DataFrame, ts: str = ESTABLISHMENTS.treated_at) -> DataFrame:
    """One row: the last treatment day, which caps the dates of an initial load."""
    return df.agg(F.max(ts).cast("date").alias("cap"))


def _history_row(spec: TableSpec, df: DataFrame, start: Column, end: Column, batch_date: dt.date) -> DataFrame:
    values = {
        spec.start: start,
        spec.end: end,
        spec.batch_created: as_date(batch_date),
        spec.batch_closed: F.when(end.isNotNull(), as_date(batch_date)),
    }
    return df.select(*[values[c].alias(c) if c in values else F.col(c) for c in spec.history_columns])


def scd2_initial_single(
    stock: DataFrame, cap: DataFrame, batch_date: dt.date, spec: TableSpec = ESTABLISHMENTS
) -> DataFrame:
    """Open rows of entities with one period, from the later of both dates but not after the cap."""
    start = F.least(F.greatest(as_date(spec.effective_from), as_date(spec.treated_at)), cap.scalar())
    return _history_row(spec, single_period(stock, spec), start, F.lit(None).cast("date"), batch_date)


def scd2_initial_multi(
    stock: DataFrame, history: DataFrame, cap: DataFrame, batch_date: dt.date, spec: TableSpec = ESTABLISHMENTS
) -> DataFrame:
    """Rows of entities with several periods, dates capped, attributes without a past from the stock."""
    missing = [c for c in spec.attributes if c not in spec.source_tracked]
    periods = enrich_history(history, stock, spec.key, missing)
    limit = cap.scalar()
    start = F.least(as_date(spec.effective_from), limit)
    ended = as_date(spec.effective_to)
    return _history_row(spec, periods, start, F.when(ended.isNotNull(), F.least(ended, limit)), batch_date)


def scd2_initial(
    stock: DataFrame,
    history: DataFrame,
    batch_date: dt.date,
    spec: TableSpec = ESTABLISHMENTS,
    keep_collapsed: bool = False,
) -> DataFrame:
    """The first history table: every period of every entity in the stock.

    Periods that begin and end at the cap lie in the future of the load. They are
    dropped, since several of them would share one key; compare the row count with
    :func:`expected_rows` on the result of ``keep_collapsed=True``.
    """
    cap = max_treated(stock, spec.treated_at)
    rows = scd2_initial_single(stock, cap, batch_date, spec).unionByName(
        scd2_initial_multi(stock, history, cap, batch_date, spec)
    )
    return rows if keep_collapsed else drop_collapsed(rows, cap, spec)


def drop_collapsed(scd: DataFrame, cap: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Without the closed periods that capping has shrunk to nothing."""
    start, end = F.col(spec.start), F.col(spec.end)
    collapsed = (start == end) & (end == cap.scalar())
    return scd.filter(~F.coalesce(collapsed, F.lit(False)))


def expected_rows(stock: DataFrame, scd: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """One row ``(expected, actual, n_bad, ok)``: the sum of the period counters, the rows there are, and the
    entities for which the two differ. One without a usable counter (NULL, below 1, no number) differs.
    """
    counter = F.col(spec.period_count).try_cast("bigint")
    counted = stock.select(spec.key, counter.alias("expected"), F.lit(0).alias("actual"), F.lit(1).alias("listed"))
    present = scd.select(
        spec.key, F.lit(0).cast("bigint").alias("expected"), F.lit(1).alias("actual"), F.lit(0).alias("listed")
    )
    entities = counted.unionByName(present).groupBy(spec.key).agg(
        F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"),
        F.sum("actual").alias("actual"),
        F.count_if((F.col("listed") == 1) & ~F.coalesce(F.col("expected") >= 1, F.lit(False))).alias("unusable"),
    )
    differs_ = (F.col("expected") != F.col("actual")) | (F.col("unusable") > 0)
    both = entities.agg(
        F.coalesce(F.sum("expected"), F.lit(0)).alias("expected"),
        F.coalesce(F.sum("actual"), F.lit(0)).alias("actual"),
        F.count_if(differs_).alias("n_bad"),
    )
    return both.withColumn("ok", F.col("n_bad") == 0)


# --- change detection: expressions on an incoming record and the open row ---------------


def any_differs(incoming: Column, current: Column, cols: Sequence[str], null_safe: bool = False) -> Column:
    """Whether any of the columns changed; a NULL comparison alone is no change."""
    if null_safe:
        return reduce(or_, [differs(incoming[c], current[c], null_safe=True) for c in cols], F.lit(False))
    # OR is true when one comparison is, whatever the others are, so one coalesce will do
    return F.coalesce(reduce(or_, [incoming[c] != current[c] for c in cols], F.lit(False)), F.lit(False))


def boundary_date(incoming: Column, current: Column, spec: TableSpec, mode: str = GREATEST) -> Column:
    """Day from which a record holds.

    ``greatest`` takes the later of effective and treatment day; ``effective_first`` takes
    the effective day when a column changed whose past the source keeps, else the
    treatment day. An entity without an open row always gets the later one.
    """
    effective = incoming[spec.effective_from].cast("date")
    treated = incoming[spec.treated_at].cast("date")
    later = F.greatest(effective, treated)
    if mode == GREATEST:
        return later
    if mode != EFFECTIVE_FIRST:
        raise ValueError(f"unknown boundary mode {mode!r}")
    by_source = any_differs(incoming, current, spec.source_tracked)
    return (
        F.when(current[spec.start].isNull(), later)
        .when(by_source, F.coalesce(effective, treated))
        .otherwise(F.coalesce(treated, effective))
    )


INCOMING, CURRENT = "incoming", "current"


def _detect(joined: DataFrame, name: str, cols: Sequence[str], null_safe: bool, spec: TableSpec) -> DataFrame:
    incoming, current = F.col(INCOMING), F.col(CURRENT)
    # without an open row there is nothing to differ from
    changed = current[spec.start].isNotNull() & any_differs(incoming, current, cols, null_safe)
    return joined.withColumn(name, changed)


def detect_significant(
    joined: DataFrame,
    tracked: Sequence[str] | None = None,
    null_safe: bool = False,
    spec: TableSpec = ESTABLISHMENTS,
) -> DataFrame:
    """Add ``has_significant_change``: a tracked value differs from the open row's."""
    return _detect(joined, "has_significant_change", tracked or spec.tracked, null_safe, spec)


def detect_fixed(
    joined: DataFrame,
    fixed: Sequence[str] | None = None,
    null_safe: bool = False,
    spec: TableSpec = ESTABLISHMENTS,
) -> DataFrame:
    """Add ``has_fixed_change``: a fixed value differs from the open row's."""
    return _detect(joined, "has_fixed_change", fixed or spec.fixed, null_safe, spec)


def detect_new(joined: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Add ``is_new``: the entity has no open row."""
    return joined.withColumn("is_new", F.col(CURRENT)[spec.start].isNull())


def change_boundary(joined: DataFrame, mode: str = GREATEST, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Add ``boundary``: the day from which the incoming record holds."""
    return joined.withColumn("boundary", boundary_date(F.col(INCOMING), F.col(CURRENT), spec, mode))


def detect_changes(
    joined: DataFrame, spec: TableSpec = ESTABLISHMENTS, null_safe: bool = False, mode: str = GREATEST
) -> DataFrame:
    """All flags of a batch joined with the open rows, and whether the change falls on their start."""
    flagged = detect_significant(joined, spec.tracked, null_safe, spec)
    flagged = detect_new(detect_fixed(flagged, spec.fixed, null_safe, spec), spec)
    flagged = change_boundary(flagged, mode, spec)
    boundary, since = F.col("boundary"), F.col(CURRENT)[spec.start]
    early = F.coalesce(F.col("has_significant_change") & (boundary < since), F.lit(False))
    return flagged.withColumns(
        {
            "in_place": F.col("has_significant_change") & (boundary == since),
            "usable": F.col(spec.key).isNotNull() & boundary.isNotNull() & ~early,
        }
    )


# --- the effect of one batch ----------------------------------------------------------


def reconcile(
    batch: DataFrame,
    scd: DataFrame,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
) -> DataFrame:
    """Batch entities with all their periods, and the entity's flags on every row.

    The table is read once and shuffled at most once: the windows use the partitioning
    of the join. A window holds one entity's periods, at most one per calendar day.
    """
    joined = batch_to_history(batch, scd, spec)
    incoming, current = F.col(INCOMING), F.col(CURRENT)
    is_open = current[spec.start].isNotNull() & current[spec.end].isNull()
    entity = Window.partitionBy(spec.key)
    later = F.greatest(incoming[spec.effective_from].cast("date"), incoming[spec.treated_at].cast("date"))

    def of_open_row(value: Column) -> Column:
        return F.max(F.when(is_open, value)).over(entity)

    flagged = joined.select(
        "*",
        is_open.alias("is_open"),
        F.coalesce(
            of_open_row(any_differs(incoming, current, spec.tracked, null_safe)), F.lit(False)
        ).alias("has_significant_change"),
        F.coalesce(
            of_open_row(any_differs(incoming, current, spec.fixed, null_safe)), F.lit(False)
        ).alias("has_fixed_change"),
        of_open_row(F.lit(True)).isNull().alias("is_new"),
        F.coalesce(of_open_row(boundary_date(incoming, current, spec, mode)), later).alias("boundary"),
        of_open_row(current[spec.start]).alias("open_since"),
        F.max(current[spec.start]).over(entity).alias("last_start"),
        F.max(current[spec.end]).over(entity).alias("last_end"),
    )
    # a record without a key or date, or dated before what it would end or follow, changes nothing;
    # the checks on the batch report it
    early = F.when(F.col("is_new"), F.col("boundary") < F.col("last_end")).otherwise(
        F.col("has_significant_change") & (F.col("boundary") < F.col("open_since"))
    )
    usable = F.col(spec.key).isNotNull() & F.col("boundary").isNotNull() & ~F.coalesce(early, F.lit(False))
    # an unseen entity is inserted once, next to the last of its closed rows if it has any
    return flagged.select(
        *[c for c in flagged.columns if c not in ("open_since", "last_start", "last_end", "is_new")],
        F.col("is_new"),
        usable.alias("usable"),
        (F.col("has_significant_change") & (F.col("boundary") == F.col("open_since"))).alias("in_place"),
        (F.col("is_new") & usable & current[spec.start].eqNullSafe(F.col("last_start"))).alias("inserts"),
        current[spec.start].eqNullSafe(F.col("last_start")).alias("at_last"),
    )


def period_values(
    spec: TableSpec,
    incoming: Column,
    current: Column,
    fixed_changed: Column,
    closes: Column,
    boundary: Column,
    batch_date: Column,
) -> dict[str, Column]:
    """An existing period after a batch: own tracked values, corrected fixed ones, closed if it ends."""
    values = {c: current[c] for c in spec.history_columns if c != spec.key}
    for c in spec.fixed:
        values[c] = F.when(fixed_changed, incoming[c]).otherwise(current[c])
    values[spec.end] = F.when(closes, boundary).otherwise(current[spec.end])
    values[spec.batch_closed] = F.when(closes, batch_date).otherwise(current[spec.batch_closed])
    return values


def fresh_values(spec: TableSpec, incoming: Column, boundary: Column, batch_date: Column) -> dict[str, Column]:
    """The open period a record starts."""
    none = F.lit(None).cast("date")
    values = {c: incoming[c] for c in spec.attributes}
    return values | {
        spec.start: boundary,
        spec.end: none,
        spec.batch_created: batch_date,
        spec.batch_closed: none,
    }


def _row(spec: TableSpec, values: dict[str, Column], with_key: bool = True) -> Column:
    names = [c for c in spec.history_columns if with_key or c != spec.key]
    dtypes = {c.name: c.dtype for c in spec.columns}
    return F.struct(
        *[(F.col(c) if c == spec.key else values[c]).cast(dtypes[c]).alias(c) for c in names]
    )


def period_struct(spec: TableSpec, values: dict[str, Column]) -> Column:
    """A period without its key, for arrays of periods."""
    return _row(spec, values, with_key=False)


def _existing(spec: TableSpec, batch_date: dt.date, closes: Column) -> Column:
    return _row(
        spec,
        period_values(
            spec,
            F.col(INCOMING),
            F.col(CURRENT),
            F.col("has_fixed_change"),
            closes,
            F.col("boundary"),
            as_date(batch_date),
        ),
    )


def _fresh(spec: TableSpec, batch_date: dt.date) -> Column:
    return _row(spec, fresh_values(spec, F.col(INCOMING), F.col("boundary"), as_date(batch_date)))


_CLOSES = "is_open AND has_significant_change AND usable"


def scd2_close(joined: DataFrame, batch_date: dt.date, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Open rows ended by the batch, taken from :func:`reconcile`'s rows."""
    ended = joined.filter(F.expr(_CLOSES) & ~F.col("in_place"))
    return ended.select(_existing(spec, batch_date, F.lit(True)).alias("r")).select("r.*")


def scd2_open_new(joined: DataFrame, batch_date: dt.date, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """New open rows of entities with a significant change."""
    return joined.filter(_CLOSES).select(_fresh(spec, batch_date).alias("r")).select("r.*")


def scd2_insert(joined: DataFrame, batch_date: dt.date, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """First rows of entities without an open one."""
    return joined.filter("inserts").select(_fresh(spec, batch_date).alias("r")).select("r.*")


def scd2_fix_history(joined: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """All existing periods; where a fixed value changed, all fixed values are the batch's."""
    rows = joined.filter(F.col(CURRENT)[spec.start].isNotNull()).select(
        "has_fixed_change", INCOMING, f"{CURRENT}.*"
    )
    fixed = conditional_overwrite(rows, "has_fixed_change", {c: F.col(INCOMING)[c] for c in spec.fixed})
    return fixed.select(*spec.history_columns)


def scd2_target(
    batch: DataFrame,
    scd: DataFrame,
    batch_date: dt.date,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
) -> DataFrame:
    """Full state, after the batch, of every entity in it.

    Each joined row gives the period as it stands afterwards, and the row that the
    entity's record opens. A change on the day the open row started takes its place.
    """
    joined = reconcile(batch, scd, spec, null_safe, mode)
    rows = _after(spec, batch_date)
    return joined.select(F.explode(rows).alias("r")).filter(F.col("r").isNotNull()).select("r.*")


def _after(spec: TableSpec, batch_date: dt.date) -> Column:
    """The period of a reconciled row as it stands afterwards, and the one that the record opens; NULL if there is none."""
    closes = F.expr(_CLOSES)
    stays = F.col(CURRENT)[spec.start].isNotNull() & ~(closes & F.col("in_place"))
    return F.array(
        F.when(stays, _existing(spec, batch_date, closes)), F.when(closes | F.col("inserts"), _fresh(spec, batch_date))
    )


def batch_report(
    batch: DataFrame,
    scd: DataFrame,
    batch_date: dt.date,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
) -> DataFrame:
    """The checks of ``integrity_report`` on the target that a batch gives, from one evaluation of it.

    Each reconciled row yields its target rows with its flags, and all are counted per entity where the
    windows have left them, so the table is read once and nothing is shuffled again.
    """
    joined = reconcile(batch, scd, spec, null_safe, mode)
    row, once = F.col("r"), F.col("pos") == 0
    each = joined.select("*", F.posexplode(_after(spec, batch_date)).alias("pos", "r"))
    opens = (F.col("has_significant_change") & ~F.coalesce("in_place", F.lit(False))) | F.col("is_new")
    record = once & F.col("at_last")  # one row for each copy of an entity's record
    entities = each.groupBy(spec.key).agg(
        F.count_if(record).alias("batch"),
        F.count_if(record & ~F.col("usable")).alias("unusable"),
        F.count_if(record & opens & F.col("usable")).alias("added"),
        F.count_if(once & F.col("is_open")).alias("met_open"),
        F.count_if(once & F.col(CURRENT)[spec.start].isNotNull()).alias("met"),
        F.count_if(row.isNotNull()).alias("target"),
        F.count_if(row.isNotNull() & row[spec.end].isNull()).alias("open"),
        F.count_if(row[spec.start] > row[spec.end]).alias("backwards"),
    )
    totals = entities.agg(
        F.count_if(F.col("batch") > 1).alias("batch_unique"),
        F.sum(F.greatest("met_open", "batch") - F.col("batch")).alias("no_fanout"),
        F.sum("unusable").alias("usable"),
        F.sum("backwards").alias("intervals"),
        F.count_if(F.col("open") != 1).alias("open_coverage"),
        F.sum(F.abs(F.col("target") - F.col("met") / F.col("batch") - F.col("added"))).alias("row_balance"),
    )
    return report(totals, {c: c for c in totals.columns})


def scd2_apply(
    scd: DataFrame, target: DataFrame, batch: DataFrame | None = None, spec: TableSpec = ESTABLISHMENTS
) -> DataFrame:
    """The table with a batch's target merged in.

    The target holds all periods of its entities, so their old ones make way by key, and a history
    bucketed by key stays in place. The entities come from the ``batch``, which spares a second
    evaluation of the target; without it, from the target.
    """
    entities = (target if batch is None else batch).select(spec.key).distinct()
    untouched = scd.join(entities, spec.key, "left_anti")
    return untouched.select(*scd.columns).unionByName(target.select(*scd.columns))
