"""Applying a queue of batches, oldest first.

Chaining one merge per batch would read and rewrite the table once per batch and let
the plan grow with the queue. Instead the records of an entity are folded over its open
period in date order, so the whole queue costs one pass, whatever its length.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annalist.functions import let
from annalist.operators.joins import affected_history
from annalist.operators.quality import IntegrityError
from annalist.operators.scd2 import (
    GREATEST,
    any_differs,
    boundary_date,
    fresh_values,
    period_struct,
    period_values,
)
from annalist.session import materialize
from annalist.spec import ESTABLISHMENTS, TableSpec


@dataclass(frozen=True)
class Replay:
    history: DataFrame
    #: first batch that failed; it and the later ones were not applied
    halted_on: dt.date | None
    #: entities whose periods may differ from before
    touched: DataFrame

    def applied(self, queue: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
        """The batches that are in the history now."""
        batches = queue.select(spec.batch_date).distinct()
        return batches if self.halted_on is None else batches.filter(F.col(spec.batch_date) < F.lit(self.halted_on))


def _step(spec: TableSpec, null_safe: bool, mode: str, hold: bool = False) -> Callable[[Column, Column], Column]:
    """One record applied to an entity's state.

    The state is the open period, the day the last closed one ended, the periods that were closed on the way, and
    the fixed values that the first ``corrected`` of these, and all periods that were closed before, take
    in the end. Periods that were closed before are not in it, so what a record costs does not
    depend on them. With ``hold``, the records after one that fails wait for it, and change nothing either.
    """

    def step(state: Column, record: Column) -> Column:
        current = state["open"]
        exists = current[spec.start].isNotNull()
        flags = F.struct(
            (exists & any_differs(record, current, spec.tracked, null_safe)).alias("changed"),
            (exists & any_differs(record, current, spec.fixed, null_safe)).alias("fixed"),
            (~exists).alias("new"),
            boundary_date(record, current, spec, mode).alias("boundary"),
        )
        return let(flags, lambda f: apply(state, record, f))

    def apply(state: Column, record: Column, flags: Column) -> Column:
        current, boundary, batch = state["open"], flags["boundary"], record[spec.batch_date]
        begins = flags["changed"] | flags["new"]
        closes = flags["changed"] & (boundary != current[spec.start])
        after = period_struct(
            spec, period_values(spec, record, current, flags["fixed"], closes, boundary, batch)
        )
        fresh = period_struct(spec, fresh_values(spec, record, boundary, batch))
        fixed = F.struct(*[record[c].alias(c) for c in spec.fixed])
        failed = (
            record["conflict"]
            | boundary.isNull()
            | (flags["changed"] & (boundary < current[spec.start]))
            | (flags["new"] & F.coalesce(boundary < state["ended"], F.lit(False)))
        )
        if hold:
            failed = failed | state["failed_on"].isNotNull()
        moved = F.struct(
            F.when(closes, F.concat(state["closed"], F.array(after))).otherwise(state["closed"]).alias("closed"),
            F.when(begins, fresh).otherwise(after).alias("open"),
            F.when(closes, boundary).otherwise(state["ended"]).alias("ended"),
            F.when(flags["fixed"], fixed).otherwise(state["fixed"]).alias("fixed"),
            F.when(flags["fixed"], F.size(state["closed"])).otherwise(state["corrected"]).alias("corrected"),
            state["failed_on"].alias("failed_on"),
        )
        # a record that fails changes nothing; the batch it is in will not be applied
        stopped = F.struct(
            *[state[c].alias(c) for c in ("closed", "open", "ended", "fixed", "corrected")],
            F.least(state["failed_on"], batch).alias("failed_on"),
        )
        idle = ~(begins | flags["fixed"])
        return F.when(failed, stopped).when(idle, state).otherwise(moved)

    return step


def _opened(spec: TableSpec, state: Column) -> Column:
    """The open period and those closed on the way, the corrected ones with their fixed values."""
    own = {c: c for c in spec.history_columns if c != spec.key}

    def correct(p: Column, i: Column) -> Column:
        late = i >= state["corrected"]
        values = {c: F.when(late, p[c]).otherwise(state["fixed"][c]) if c in spec.fixed else p[c] for c in own}
        return period_struct(spec, values)

    closed = F.when(state["corrected"] > 0, F.transform(state["closed"], correct)).otherwise(state["closed"])
    # an entity has no open period only if all its records failed and it had none before
    return F.concat(closed, F.filter(F.array(state["open"]), lambda p: p.isNotNull()))


def _conflict(low: str, high: str) -> Column:
    return ~F.col(low).eqNullSafe(F.col(high))


def fold_batches(
    scd: DataFrame,
    queue: DataFrame,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
) -> DataFrame:
    """One row per entity in the queue: what takes the place of its open period (``periods``), the fixed values that its
    closed ones take (``fixed``, NULL if they keep their own), and the first batch that failed.

    A batch fails for a record without a key or without a usable date, for an entity that has two differing
    records in it, for a change dated before the open period started or before the last closed one ended, and for
    an entity with two periods of one start, one without a start, or two open ones.

    Equal records, and equal open periods, are combined before the shuffle. What is then gathered per
    entity is one record per batch; of its closed periods only their number and last end.
    """
    return fold_entities(_held(scd, queue, spec), queue, spec, null_safe, mode)


def _held(scd: DataFrame, queue: DataFrame, spec: TableSpec) -> DataFrame:
    """What the fold needs of an entity's periods, from all of them: ``open, ended, n_open, broken``."""
    names = [c for c in spec.history_columns if c != spec.key]
    whole = F.struct(*[F.col(c).cast(spec.column(c).dtype).alias(c) for c in names])
    is_open = F.col(spec.end).isNull()
    return (
        affected_history(scd, queue, spec.key)
        .groupBy(spec.key, spec.start)
        .agg(
            F.min(F.when(is_open, whole)).alias("open"),
            F.max(spec.end).alias("ended"),
            F.count("*").alias("copies"),
            F.count_if(is_open).alias("n_open"),
        )
        .select(
            spec.key, "open", "ended", "n_open", ((F.col("copies") > 1) | F.col(spec.start).isNull()).alias("broken")
        )
    )


def fold_entities(
    held: DataFrame,
    queue: DataFrame,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
    hold: bool = False,
) -> DataFrame:
    """:func:`fold_batches` on what is held of the entities: rows ``open, ended, n_open, broken`` by key.

    Gives ``ended`` as well, the day the last closed period ended. With ``hold``, an entity stands still from its first
    record that fails, in the batch ``failed_on``; else only that record changes nothing.
    """
    values = [*spec.attributes, spec.effective_from, spec.treated_at]
    records = (
        queue.groupBy(spec.key, spec.batch_date)
        .agg(F.min(F.struct(*values)).alias("low"), F.max(F.struct(*values)).alias("high"))
        .select(
            spec.key,
            F.struct(
                spec.batch_date, "low.*", (_conflict("low", "high") | F.col(spec.key).isNull()).alias("conflict")
            ).alias("record"),
        )
    )
    entities = (
        records.unionByName(held, allowMissingColumns=True)
        .groupBy(spec.key)
        .agg(
            F.sort_array(F.collect_list("record")).alias("records"),
            F.max("open").alias("open"),
            F.max("ended").alias("ended"),
            (F.coalesce(F.bool_or("broken"), F.lit(False)) | (F.coalesce(F.sum("n_open"), F.lit(0)) > 1)).alias("broken"),
        )
    )
    first_batch = F.get(F.col("records"), F.lit(0))[spec.batch_date]
    fixed = T.StructType([T.StructField(c, spec.column(c).dtype) for c in spec.fixed])
    begin = F.struct(
        F.slice(F.array("open"), 1, 0).alias("closed"),
        F.col("open"),
        F.col("ended"),
        F.lit(None).cast(fixed).alias("fixed"),
        F.lit(0).alias("corrected"),
        F.when(F.col("broken"), first_batch).alias("failed_on"),
    )
    folded = F.aggregate(
        "records",
        begin,
        _step(spec, null_safe, mode, hold),
        lambda state: F.struct(
            _opened(spec, state).alias("periods"),
            state["fixed"].alias("fixed"),
            state["ended"].alias("ended"),
            state["failed_on"].alias("failed_on"),
        ),
    )
    return entities.select(spec.key, folded.alias("after")).select(spec.key, "after.*")


def fold_until_failure(
    fold: Callable[[DataFrame], DataFrame], queue: DataFrame, spec: TableSpec = ESTABLISHMENTS
) -> tuple[DataFrame, dt.date | None, DataFrame]:
    """The stored fold of the batches before the first that fails, that batch, and the records folded."""
    if not queue.filter(F.col(spec.batch_date).isNull()).isEmpty():
        raise IntegrityError("the queue holds records without a batch date")
    folded = materialize(fold(queue), "replay")
    halted_on = folded.agg(F.min("failed_on")).first()[0]
    if halted_on is not None:
        queue = queue.filter(F.col(spec.batch_date) < F.lit(halted_on))
        folded = materialize(fold(queue), "replay")
    return folded, halted_on, queue


#: folded entities per bucket up to which a hash table of them is built
HASHED = 1_000_000


def replay(
    scd: DataFrame,
    queue: DataFrame,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
    buckets: int | None = None,
) -> Replay:
    """Apply the queued batches in order, up to the first that fails.

    The fold is stored once in the shared folder. Only when some batch failed is it
    computed again, for the batches before it: the earliest failure is the same
    whatever came after it. A record without a batch date belongs to no batch and is an error.

    The history is joined with the folded entities once: closed periods stay as they are, or take the
    corrected fixed values, and open ones make way for what the fold gives.

    ``buckets`` is the number of buckets (by key) of a bucketed history. The history then
    stays where it is: the folded entities are brought to its buckets, and the result
    is partitioned alike, ready to be written as buckets again.
    """
    folded, halted_on, _ = fold_until_failure(
        lambda records: fold_batches(scd, records, spec, null_safe, mode), queue, spec
    )
    effects = folded.select(spec.key, F.lit(True).alias("_folded"), F.col("fixed").alias("_fixed"))
    if buckets is not None:
        folded = folded.repartition(buckets, spec.key)
        effects = folded.select(spec.key, F.lit(True).alias("_folded"), F.col("fixed").alias("_fixed"))
        if folded.count() <= HASHED * buckets:
            # a hash table of the bucket's entities, of checked size; the history is neither moved nor sorted
            effects = effects.hint("shuffle_hash")
    opened = folded.select(spec.key, F.inline("periods")).select(*spec.history_columns)
    stays = F.col("_folded").isNull() | F.col(spec.end).isNotNull()
    corrected = {c: F.when(F.col("_fixed").isNotNull(), F.col("_fixed")[c]).otherwise(F.col(c)) for c in spec.fixed}
    kept = scd.join(effects, spec.key, "left").filter(stays).withColumns(corrected).select(*spec.history_columns)
    return Replay(kept.unionByName(opened), halted_on, folded.select(spec.key))


def scd2_replay(
    scd: DataFrame,
    queue: DataFrame,
    spec: TableSpec = ESTABLISHMENTS,
    null_safe: bool = False,
    mode: str = GREATEST,
) -> DataFrame:
    """The history after all queued batches up to the first that fails."""
    return replay(scd, queue, spec, null_safe, mode).history
