"""A history in two tiers, so that a batch costs what it holds.

* **Closed periods** are only ever appended to: a run adds one segment with those it closed.
* **Heads** hold, for each entity, its open period and the day its last closed one ended. That is all a record needs, so
  closed periods are not read. The heads of the entities that runs have touched lie in an **overlay** that takes the place
  of theirs.
* A corrected fixed value holds for all periods closed before. These **fixes** are one row per entity with the number of the run;
  the view joins them with the segments of earlier runs.

The view puts the parts together: segments with their fixes, heads that are not in the overlay, and the overlay. A run writes a
segment, the overlay and the fixes, and makes the view that reads them the next version. When the overlay has grown to a share of the
heads, or there are many segments, :func:`fold_in` merges them; the closed periods of the first load are only written
again if the fixes are folded into them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.operators.joins import affected_history
from annalist.operators.quality import check_history, report, require_ok
from annalist.operators.scd2 import GREATEST
from annalist.plans.publish import write_snapshot
from annalist.plans.replay import fold_entities, fold_until_failure
from annalist.plans.versions import Conflict, Version, commit, newest
from annalist.session import materialize
from annalist.spec import ESTABLISHMENTS, TableSpec

ENDED, SEQ = "_ended", "_seq"
#: share of the heads, and number of segments, from which on a run folds them in
OVERLAY_SHARE, SEGMENTS = 0.1, 16


@dataclass(frozen=True)
class Tiers:
    """Where the parts lie, as what to select from; and the number of rows of those that grow."""

    heads: str
    n_heads: int
    #: segments of closed periods, with the number of the run whose fixes they hold already
    closed: tuple[tuple[str, int], ...]
    overlay: str | None = None
    n_overlay: int = 0
    fixes: str | None = None
    n_fixes: int = 0
    #: records that wait, because one of their entity can't be placed
    held: str | None = None
    n_held: int = 0
    #: keys of the entities that differ from the version before; empty if none does, None if that isn't known
    touched: str | None = None
    #: runs so far
    run: int = 0

    @classmethod
    def of(cls, version: Version) -> Tiers:
        stored = dict(version.layout)
        return cls(**{**stored, "closed": tuple((source, seq) for source, seq in stored["closed"])})

    def query(self, spec: TableSpec = ESTABLISHMENTS) -> str:
        """The SELECT that the view consists of."""
        columns = ", ".join(_name(c) for c in spec.history_columns)
        parts = [self._closed_query(spec)] if self.closed else []
        away = f" ANTI JOIN {self.overlay} o ON h.{_name(spec.key)} = o.{_name(spec.key)}" if self.overlay else ""
        parts.append(f"SELECT {columns} FROM {self.heads} h{away} WHERE {_name(spec.start)} IS NOT NULL")
        if self.overlay:
            parts.append(f"SELECT {columns} FROM {self.overlay} WHERE {_name(spec.start)} IS NOT NULL")
        return " UNION ALL ".join(parts)

    def _closed_query(self, spec: TableSpec, segments: tuple[tuple[str, int], ...] | None = None) -> str:
        columns = [_name(c) for c in spec.history_columns]
        chosen = self.closed if segments is None else segments
        if not self.fixes:
            return " UNION ALL ".join(f"SELECT {', '.join(columns)} FROM {source}" for source, _ in chosen)
        rows = " UNION ALL ".join(f"SELECT {', '.join(columns)}, {seq} AS {SEQ} FROM {source}" for source, seq in chosen)
        values = [
            f"CASE WHEN f.{SEQ} > c.{SEQ} THEN f.{_name(c)} ELSE c.{_name(c)} END AS {_name(c)}" if c in spec.fixed else f"c.{_name(c)}"
            for c in spec.history_columns
        ]
        on = f"c.{_name(spec.key)} = f.{_name(spec.key)}"
        return f"SELECT {', '.join(values)} FROM ({rows}) c LEFT JOIN {self.fixes} f ON {on}"

    def history(self, spark: SparkSession, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
        return spark.sql(self.query(spec))

    def all_heads(self, spark: SparkSession, keys: DataFrame | None = None, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
        """The present head of every entity, or of the listed ones."""

        def read(source: str) -> DataFrame:
            rows = spark.sql(f"SELECT * FROM {source}")
            return rows if keys is None else affected_history(rows, keys, spec.key)

        base = read(self.heads)
        if not self.overlay:
            return base
        over = read(self.overlay)
        return base.join(over.select(spec.key), spec.key, "left_anti").select(*over.columns).unionByName(over)


def _name(c: str) -> str:
    return f"`{c}`"


def _heads_of(history: DataFrame, spec: TableSpec) -> DataFrame:
    names = [c for c in spec.history_columns if c != spec.key]
    present = F.max(F.when(F.col(spec.end).isNull(), F.struct(*names))).alias("open")
    return (
        history.groupBy(spec.key)
        .agg(present, F.max(spec.end).alias(ENDED))
        .select(spec.key, *[F.col("open")[c].cast(spec.column(c).dtype).alias(c) for c in names], ENDED)
    )


def _count(spark: SparkSession, source: str) -> int:
    return spark.sql(f"SELECT count(*) FROM {source}").first()[0]  # from the file footers


def publish_tiers(
    history: DataFrame,
    name: str,
    root: str,
    spec: TableSpec = ESTABLISHMENTS,
    buckets: int | None = None,
    notes: Mapping[str, str] | None = None,
    base: int | None = None,
) -> int:
    """Publish a whole history in tiers, after its checks; gives its number of rows.

    With ``buckets``, closed periods and heads are bucketed by key: readers that group by entity shuffle neither.
    """
    spark = history.sparkSession
    by_key = None if buckets is None else (buckets, spec.key)
    stored = materialize(history.select(*spec.history_columns), "history")
    require_ok(check_history(stored, spec))
    closed = stored.filter(F.col(spec.end).isNotNull())
    heads = _heads_of(stored, spec)
    if buckets is not None:
        closed, heads = closed.repartition(buckets, spec.key), heads.repartition(buckets, spec.key)
    sources = [write_snapshot(df, f"{name}_{part}", root, by_key) for df, part in ((closed, "closed"), (heads, "heads"))]
    tiers = Tiers(sources[1], _count(spark, sources[1]), ((sources[0], 0),))
    commit(spark, name, root, tiers.query(spec), notes, base, asdict(tiers))
    return stored.count()


@dataclass(frozen=True)
class Applied:
    tiers: Tiers
    #: first batch that failed; it and the later ones were not applied
    halted_on: dt.date | None
    #: the entities of the applied batches
    touched: DataFrame
    #: what must hold of the new rows, as ``(check, n_bad, ok)``
    report: DataFrame


def apply_to_tiers(
    spark: SparkSession,
    tiers: Tiers,
    queue: DataFrame,
    name: str,
    root: str,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
    hold: bool = False,
) -> Applied:
    """Write what the queued batches change, beside the tiers that they were applied to.

    Reads the records, the heads of their entities and the overlay; no closed period. Writes the periods that were
    closed, and the overlay and fixes anew.

    A record that can't be placed stops its batch and those after it. With ``hold`` it only stops its entity: that
    record and the entity's later ones wait beside the history, are tried again with every run, and all others go on.
    """
    run = tiers.run + 1
    if hold and tiers.held:
        queue = queue.unionByName(spark.sql(f"SELECT * FROM {tiers.held}"), allowMissingColumns=True)
    waiting = None
    if hold:
        queue = materialize(queue, "records")
        undated = F.col(spec.batch_date).isNull() | F.col(spec.key).isNull()
        waiting, queue = queue.filter(undated), queue.filter(~undated)
    held = materialize(tiers.all_heads(spark, queue, spec), "held")
    names = [c for c in spec.history_columns if c != spec.key]
    is_open = F.col(spec.start).isNotNull()
    state = held.select(
        spec.key,
        F.when(is_open, F.struct(*names)).alias("open"),
        F.col(ENDED).alias("ended"),
        is_open.cast("bigint").alias("n_open"),
        F.lit(False).alias("broken"),
    )
    if hold:
        halted_on, folded = None, materialize(fold_entities(state, queue, spec, null_safe, mode, hold=True), "replay")
        stopped = folded.filter("failed_on IS NOT NULL").select(spec.key, F.col("failed_on").alias("_from"))
        late = F.col(spec.batch_date) >= F.col("_from")
        marked = materialize(queue.join(stopped, spec.key, "left").withColumn("_waits", F.coalesce(late, F.lit(False))), "marked")
        waiting = waiting.unionByName(marked.filter("_waits").select(*waiting.columns)).distinct()
        applied = marked.filter("NOT _waits")
        folded = affected_history(folded, applied, spec.key)
    else:
        folded, halted_on, applied = fold_until_failure(
            lambda records: fold_entities(state, records, spec, null_safe, mode), queue, spec
        )
    touched = materialize(applied.select(spec.key).distinct(), "touched")
    periods = folded.select(spec.key, F.inline("periods")).select(*spec.history_columns)
    closed = write_snapshot(periods.filter(F.col(spec.end).isNotNull()), f"{name}_segment", root)
    still_open = F.get(F.filter("periods", lambda p: p[spec.end].isNull()), F.lit(0))
    heads = folded.withColumn("_open", still_open)
    heads = heads.select(spec.key, *[F.col("_open")[c].cast(spec.column(c).dtype).alias(c) for c in names], F.col("ended").alias(ENDED))
    new = replace(tiers, run=run, touched=write_snapshot(touched, f"{name}_touched", root))
    overlay = heads if not tiers.overlay else _replace_rows(spark, tiers.overlay, heads, spec)
    new = replace(new, overlay=write_snapshot(overlay, f"{name}_overlay", root))
    new = replace(new, n_overlay=_count(spark, new.overlay))
    if _count(spark, closed):
        new = replace(new, closed=(*tiers.closed, (closed, run)))
    fixed = folded.filter(F.col("fixed").isNotNull()).select(spec.key, F.lit(run).alias(SEQ), "fixed.*")
    if not fixed.isEmpty():
        fixes = fixed if not tiers.fixes else _replace_rows(spark, tiers.fixes, fixed, spec)
        source = write_snapshot(fixes, f"{name}_fixes", root)
        new = replace(new, fixes=source, n_fixes=_count(spark, source))
    if hold:
        source = write_snapshot(waiting, f"{name}_held", root)
        n_held = _count(spark, source)
        new = replace(new, held=source if n_held else None, n_held=n_held)
    written = [spark.sql(f"SELECT * FROM {closed}"), affected_history(spark.sql(f"SELECT * FROM {new.overlay}"), touched, spec.key)]
    return Applied(new, halted_on, touched, check_applied(written[0], written[1], held, touched, spec))


def _replace_rows(spark: SparkSession, source: str, rows: DataFrame, spec: TableSpec) -> DataFrame:
    before = spark.sql(f"SELECT * FROM {source}")
    others = before.join(rows.select(spec.key), spec.key, "left_anti")
    return others.select(*rows.columns).unionByName(rows)


def held_records(spark: SparkSession, name: str, root: str) -> DataFrame | None:
    """The records that wait beside a published history; None if there are none."""
    version = newest(spark, name, root)
    source = Tiers.of(version).held if version.layout else None
    return spark.sql(f"SELECT * FROM {source}") if source else None


def check_applied(
    closed: DataFrame, heads: DataFrame, held: DataFrame, touched: DataFrame, spec: TableSpec = ESTABLISHMENTS
) -> DataFrame:
    """What must hold of the rows that a run has written, per entity of its batches, from one aggregation.

    ``open_coverage``: it has one open period. ``row_balance``: its new periods take the place of the open one that it had, from
    the same day on and without a gap, so none was lost and none came twice. ``no_overlap``: they begin after the
    last closed one ended. ``intervals``: none ends before it starts. ``keys``: all rows are of entities of the batches.
    """
    day = lambda c: F.xxhash64(c)
    none = F.lit(None).cast("date")
    sides = [
        touched.select(spec.key, F.lit("batch").alias("_of"), none.alias("s"), none.alias("e")),
        held.select(spec.key, F.lit("held"), F.col(spec.start), F.col(ENDED)),
        closed.select(spec.key, F.lit("new"), F.col(spec.start), F.col(spec.end)),
        heads.filter(F.col(spec.start).isNotNull()).select(spec.key, F.lit("new"), F.col(spec.start), none),
    ]
    new, was = F.col("_of") == "new", F.col("_of") == "held"
    entities = (
        reduce(DataFrame.union, sides)
        .groupBy(spec.key)
        .agg(
            F.count_if(F.col("_of") == "batch").alias("batch"),
            F.count_if(new).alias("n"),
            F.count_if(new & F.col("e").isNull()).alias("open"),
            F.size(F.collect_set(F.when(new, F.col("s")))).alias("starts"),
            F.min(F.when(new, F.col("s"))).alias("first"),
            F.count_if(new & (F.col("s") > F.col("e"))).alias("backwards"),
            F.coalesce(F.bit_xor(F.when(new, day("s"))), F.lit(0)).alias("begin"),
            F.coalesce(F.bit_xor(F.when(new & F.col("e").isNotNull(), day("e"))), F.lit(0)).alias("finish"),
            F.max(F.when(was, F.col("s"))).alias("held_from"),
            F.max(F.when(was, F.col("e"))).alias("held_until"),
        )
    )
    # the starts but the first are the ends, each once
    chained = (F.col("starts") == F.col("n")) & (F.col("begin").bitwiseXOR(day("first")) == F.col("finish"))
    totals = entities.agg(
        F.count_if(F.col(spec.key).isNull() | ((F.col("batch") == 0) & (F.col("n") > 0))).alias("keys"),
        F.count_if((F.col("batch") > 0) & (F.col("open") != 1)).alias("open_coverage"),
        F.count_if((F.col("n") > 0) & (~chained | ~F.coalesce(F.col("first") == F.col("held_from"), F.lit(True)))).alias("row_balance"),
        F.count_if(F.coalesce(F.col("first") < F.col("held_until"), F.lit(False))).alias("no_overlap"),
        F.sum("backwards").alias("intervals"),
    )
    return report(totals, {c: c for c in totals.columns})


def publish_applied(
    spark: SparkSession,
    name: str,
    root: str,
    base: Version,
    queue: DataFrame,
    spec: TableSpec = ESTABLISHMENTS,
    buckets: int | None = None,
    notes: Callable[[dt.date | None], Mapping[str, str]] | None = None,
    hold: bool = False,
) -> Applied:
    """Apply the queued batches to a history in tiers, check the new rows, and publish; folds in when it is time.

    If a check fails, or another run has published since ``base`` was read, the history stays as it was. The records
    that wait (``hold``) are part of the version, so none is lost and none is tried twice.
    """
    before = Tiers.of(base)
    done = apply_to_tiers(spark, before, queue, name, root, spec, hold=hold)
    if done.touched.isEmpty() and done.tiers.n_held == before.n_held:
        return done
    require_ok(done.report)
    commit(spark, name, root, done.tiers.query(spec), notes(done.halted_on) if notes else None, base.number, asdict(done.tiers))
    if done.tiers.n_overlay > OVERLAY_SHARE * done.tiers.n_heads or len(done.tiers.closed) > SEGMENTS:
        try:
            fold_in(spark, name, root, spec, buckets)
        except Conflict:  # another run has published; it will be time again after the next one
            pass
    return done


def fold_in(
    spark: SparkSession,
    name: str,
    root: str,
    spec: TableSpec = ESTABLISHMENTS,
    buckets: int | None = None,
    fixes: bool = False,
) -> Tiers:
    """Merge the overlay into the heads and the segments of the runs into one; the rows of the history stay the same.

    The first segment, which holds nearly all closed periods, is left as it is, unless ``fixes`` are to be written into it.
    """
    base = newest(spark, name, root)
    tiers = Tiers.of(base)
    by_key = None if buckets is None else (buckets, spec.key)

    def written(df: DataFrame, part: str) -> str:
        return write_snapshot(df if buckets is None else df.repartition(buckets, spec.key), f"{name}_{part}", root, by_key)

    heads, n_heads = tiers.heads, tiers.n_heads
    if tiers.overlay:
        heads = written(tiers.all_heads(spark, spec=spec), "heads")
        n_heads = _count(spark, heads)
    merged = tiers.closed if fixes else tiers.closed[1:]
    closed = tiers.closed
    if len(merged) > 1 or (fixes and tiers.fixes):
        rows = spark.sql(tiers._closed_query(spec, merged))
        new = (written(rows, "closed") if fixes else write_snapshot(rows, f"{name}_segment", root), tiers.run)
        closed = (new,) if fixes else (tiers.closed[0], new)
    folded = replace(tiers, heads=heads, n_heads=n_heads, closed=closed, overlay=None, n_overlay=0, touched="")
    if fixes:
        folded = replace(folded, fixes=None, n_fixes=0)
    commit(spark, name, root, folded.query(spec), None, base.number, asdict(folded))
    return folded
