"""First load or next batches: bringing the published history up to date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.operators.joins import affected_history, history_semi
from annalist.operators.quality import IntegrityError, check_history
from annalist.operators.rows import drop_null_key, multi_period_keys, region_filter
from annalist.operators.scd2 import drop_collapsed, expected_rows, max_treated, scd2_initial
from annalist.plans.publish import publish
from annalist.plans.replay import replay
from annalist.plans.tiers import publish_applied, publish_tiers
from annalist.plans.versions import Conflict, exists, newest, newest_number, read_note, show_newest, write_text
from annalist.session import materialize, new_path, write_parquet
from annalist.sources.files import (
    comment_columns,
    ingest_nested_json,
    nested_delta_schema,
    scan_projected,
    scan_typed,
    stage_parquet,
)
from annalist.sources.queue import ack_files, append_to_queue, next_cursor, queued_files, read_files
from annalist.spec import ESTABLISHMENTS, TableSpec

Reader = Callable[[DataFrame], DataFrame]

#: note on a published history: where the files are listed that are in it but still in the queue
TO_ACKNOWLEDGE = "annalist.to_acknowledge"


def regional_stock(stock: DataFrame, prefixes: Sequence[str], spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """The stock of a region."""
    return region_filter(drop_null_key(stock, spec.area), spec.area, prefixes)


def prepare_sources(
    stock_text: DataFrame,
    history_text: DataFrame,
    prefixes: Sequence[str],
    root: str,
    spec: TableSpec = ESTABLISHMENTS,
) -> tuple[DataFrame, DataFrame]:
    """The region's typed stock and the periods of its entities with a past, staged below the root."""
    typed = scan_typed(stock_text, spec.source_columns)
    stock = stage_parquet(regional_stock(typed, prefixes, spec), f"{root}/stock")
    wanted = [spec.key, spec.effective_from, spec.effective_to, *spec.source_tracked]
    periods = history_semi(scan_projected(history_text, wanted), multi_period_keys(stock, spec), spec.key)
    return stock, stage_parquet(periods, f"{root}/history")


#: columns of the queue for lines that are no JSON, and for fields the registry does not know
CORRUPT, EXTRA = "_corrupt_record", "_extra"


def enqueue_batch(
    lines: DataFrame,
    queue_table: str,
    batch_date: dt.date | Column,
    cursor: dt.datetime | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    path: str | None = None,
    max_corrupt: float = 0.0,
    cursor_name: str | None = None,
    root: str | None = None,
) -> DataFrame:
    """Parse a batch of JSON lines, append it to the queue, and give the cursor after it.

    ``batch_date`` may be a column of ``lines``, where these hold several batches.

    Nothing is lost on the way: fields that the registry does not know stay in the queue as text, and lines that are no
    JSON go to the table ``<queue>_rejected``. If their share is above ``max_corrupt`` the batch
    fails before anything is written. With ``cursor_name`` and ``root`` the cursor is published as well, and the one before it
    is read from there if ``cursor`` is not given.
    """
    if cursor is None:
        cursor = stored_cursor(lines.sparkSession, cursor_name, root)
    parsed = ingest_nested_json(lines, nested_delta_schema(spec), batch_date, CORRUPT, EXTRA)
    parsed = materialize(parsed, "batch")
    is_corrupt = F.col(CORRUPT).isNotNull()
    n, bad = parsed.agg(F.count("*"), F.count_if(is_corrupt)).first()
    if bad > max_corrupt * n:
        raise IntegrityError(f"{bad} of {n} lines are no JSON")
    if bad:
        rejected = parsed.filter(is_corrupt).select(CORRUPT, "batch_date")
        append_to_queue(rejected, f"{queue_table}_rejected", f"{path}_rejected" if path else None)
    good = parsed.filter(~is_corrupt).drop(CORRUPT)
    append_to_queue(good, queue_table, path)
    after = next_cursor(good, spec.treated_at, cursor)
    if cursor_name and root:
        publish(after, cursor_name, root)
    return after


def stored_cursor(spark: SparkSession, cursor_name: str | None, root: str | None) -> dt.datetime:
    """From when on the next batch is asked for: what the first load or the last batch has published."""
    if not (cursor_name and root and newest_number(spark, cursor_name, root)):
        raise ValueError("there is no cursor yet; give one, or load the history with cursor_name")
    return spark.sql(newest(spark, cursor_name, root).query).first()[0]


def first_load(
    stock: DataFrame,
    history: DataFrame,
    batch_date: dt.date,
    name: str,
    root: str,
    spec: TableSpec = ESTABLISHMENTS,
    buckets: int | None = None,
    tiered: bool = False,
    cursor_name: str | None = None,
) -> int:
    """Publish the first history table; fails when a period of the stock is missing.

    With ``buckets`` it is bucketed by key, which this one shuffle pays for: later batches
    then leave the table in place. With ``tiered`` closed and open periods lie apart (``tiers``), and a later batch writes
    what it changes only. With ``cursor_name`` the cursor of the first batch is published as well.
    """
    if cursor_name:
        publish(cursor_after(stock, spec), cursor_name, root)
    base = newest_number(stock.sparkSession, name, root)
    every_period = scd2_initial(stock, history, batch_date, spec, keep_collapsed=True)
    counts = expected_rows(stock, every_period, spec).first()  # reads the keys only
    if not counts["ok"]:
        raise IntegrityError(
            f"expected {counts['expected']} periods, found {counts['actual']}; {counts['n_bad']} entities differ"
        )
    loaded = drop_collapsed(every_period, max_treated(stock, spec.treated_at), spec)
    if tiered:
        return publish_tiers(loaded, name, root, spec, buckets, base=base)
    if buckets is not None:
        loaded = loaded.repartition(buckets, spec.key)
    described = comment_columns(loaded, spec)
    return publish(described, name, root, lambda df: check_history(df, spec), _by_key(buckets, spec), base=base)


def _by_key(buckets: int | None, spec: TableSpec) -> tuple[int, str] | None:
    return None if buckets is None else (buckets, spec.key)


#: how often a run starts again because another one has published
ATTEMPTS = 5


def apply_pending(
    spark: SparkSession,
    name: str,
    root: str,
    queue_table: str,
    spec: TableSpec = ESTABLISHMENTS,
    buckets: int | None = None,
    reader: Reader | None = None,
    hold: bool = False,
) -> dt.date | None:
    """Apply the queued batches to the published history and take them off the queue.

    Gives the batch at which it stopped, if any; it and the later ones stay queued. The files of the queue
    are listed once; just these are read, and just these acknowledged, so rows that arrive
    meanwhile wait for the next run. The snapshot notes which files it took in, in the same step that makes
    it current. So a run that dies before it has acknowledged them is finished by the next one, which
    does not apply them again. A run that finds another one's version in the place of the one it read
    starts again, with what is queued then.

    Before the switch the stored snapshot is checked for the entities that changed; if a check fails, the
    history and the queue stay as they were.

    ``reader`` turns the queue's rows into flat records, such as ``flatten_nested`` for a
    queue of nested ones. With ``hold``, on a history in tiers, a record that can't be placed holds up its entity and not its batch.
    """
    for left in range(ATTEMPTS - 1, -1, -1):
        try:
            return _apply_once(spark, name, root, queue_table, spec, buckets, reader, hold)
        except Conflict:
            if not left:
                raise
    return None


def _apply_once(
    spark: SparkSession,
    name: str,
    root: str,
    queue_table: str,
    spec: TableSpec,
    buckets: int | None,
    reader: Reader | None,
    hold: bool,
) -> dt.date | None:
    base = show_newest(spark, name, root)
    _acknowledge(spark, name, queue_table)
    files = materialize(queued_files(spark, queue_table), "queue-files")
    if files.isEmpty():
        return None
    queue = read_files(spark, queue_table, files)
    records = reader(queue) if reader else queue
    if hold and not base.layout:
        raise ValueError("records are held beside a history in tiers")
    if base.layout:

        def note(halted_on: dt.date | None) -> dict[str, str]:
            return {TO_ACKNOWLEDGE: _noted(spark, files, halted_on, spec)}

        done = publish_applied(spark, name, root, base, records, spec, buckets, note, hold)
        _acknowledge(spark, name, queue_table)
        return done.halted_on
    result = replay(spark.sql(base.query), records, spec, buckets=buckets)
    halted_on = result.halted_on
    if halted_on is None or not files.filter(F.col(spec.batch_date) < F.lit(halted_on)).isEmpty():
        noted = _noted(spark, files, halted_on, spec)

        def check(df: DataFrame) -> DataFrame:
            return check_history(affected_history(df, result.touched, spec.key), spec)

        publish(result.history, name, root, check, _by_key(buckets, spec), {TO_ACKNOWLEDGE: noted}, base.number)
        _acknowledge(spark, name, queue_table)
    return halted_on


def _noted(spark: SparkSession, files: DataFrame, halted_on: dt.date | None, spec: TableSpec) -> str:
    """Where the files of the applied batches are listed."""
    applied = files if halted_on is None else files.filter(F.col(spec.batch_date) < F.lit(halted_on))
    path = new_path(spark, "applied-files")
    write_parquet(applied, path)
    return path


def _acknowledge(spark: SparkSession, name: str, queue_table: str) -> None:
    """Take off the queue what the published snapshot says it took in; a mark beside the list says that it is done."""
    noted = read_note(spark, name, TO_ACKNOWLEDGE)
    if noted and not exists(spark, f"{noted}-done"):
        ack_files(spark, queue_table, spark.read.parquet(noted))
        write_text(spark, f"{noted}-done", "")


def bootstrap_or_incremental(
    spark: SparkSession,
    name: str,
    root: str,
    stock: DataFrame,
    history: DataFrame,
    queue_table: str,
    batch_date: dt.date,
    spec: TableSpec = ESTABLISHMENTS,
    buckets: int | None = None,
    reader: Reader | None = None,
    tiered: bool = False,
    hold: bool = False,
) -> DataFrame:
    """Load the history if it does not exist yet, then always apply what is queued.

    ``tiered`` says how it is loaded; later runs go by what they find.
    """
    if not newest_number(spark, name, root):
        try:
            first_load(stock, history, batch_date, name, root, spec, buckets, tiered)
        except Conflict:  # another run has loaded it
            pass
    apply_pending(spark, name, root, queue_table, spec, buckets, reader, hold)
    return spark.table(name)


def cursor_after(stock: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Cursor of the first delta: one second after the last treatment in the stock."""
    last = F.max(F.col(spec.treated_at).cast("timestamp_ntz"))
    return stock.agg((last + F.expr("INTERVAL 1 SECOND")).alias("cursor"))
