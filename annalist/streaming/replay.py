"""The replay as a stream over the queue's files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from annalist.operators.joins import affected_history
from annalist.operators.quality import IntegrityError, check_history
from annalist.plans.publish import publish
from annalist.plans.replay import replay
from annalist.plans.tiers import publish_applied
from annalist.plans.versions import read_note, show_newest
from annalist.spec import ESTABLISHMENTS, TableSpec


#: note on a published history: micro-batch of a stream and the batches of it that are in
TAKEN_IN = "annalist.taken_in"


def replay_stream(
    spark: SparkSession,
    queue_path: str,
    schema: T.StructType,
    name: str,
    root: str,
    checkpoint: str,
    spec: TableSpec = ESTABLISHMENTS,
    buckets: int | None = None,
) -> StreamingQuery:
    """Apply whatever batch files arrived since the last run, then stop.

    The stream's checkpoint remembers which files were read, so it stands in for both
    the cursor and the acknowledgement. All new files form one micro-batch, in which the
    batches are folded in date order. When a batch fails, those before it are applied
    and the query stops with an error. A micro-batch that did not finish is run again;
    the snapshot notes which of its batches are in already, and those are left out. If another run publishes
    meanwhile, the micro-batch fails with a ``Conflict`` and is run again like any that did not finish.
    """
    incoming = spark.readStream.schema(schema).parquet(queue_path)

    def apply(micro_batch: DataFrame, number: int) -> None:
        session = micro_batch.sparkSession
        base = show_newest(session, name, root)
        this_run = f"{checkpoint}#{number}"
        noted_run, _, noted = read_note(session, name, TAKEN_IN).partition("=")
        taken = noted.split(",") if noted and noted_run == this_run else []
        todo = micro_batch.filter(~F.col(spec.batch_date).cast("string").isin(taken))
        by_key = None if buckets is None else (buckets, spec.key)

        def notes(applied: list[str]) -> dict[str, str]:
            return {TAKEN_IN: f"{this_run}={','.join(sorted([*taken, *applied]))}"}

        def before(halted_on: dt.date | None) -> list[str]:
            days = todo.select(spec.batch_date).distinct()
            applied = days if halted_on is None else days.filter(F.col(spec.batch_date) < F.lit(halted_on))
            return [r[0].isoformat() for r in applied.collect()]

        if base.layout:
            done = publish_applied(session, name, root, base, todo, spec, buckets, lambda day: notes(before(day)))
            if done.halted_on is not None:
                raise IntegrityError(f"stopped at batch {done.halted_on}")
            return
        result = replay(session.sql(base.query), todo, spec, buckets=buckets)
        applied = before(result.halted_on)
        if applied:

            def check(df: DataFrame) -> DataFrame:
                return check_history(affected_history(df, result.touched, spec.key), spec)

            publish(result.history, name, root, check, by_key, notes(applied), base.number)
        if result.halted_on is not None:
            raise IntegrityError(f"stopped at batch {result.halted_on}")

    return (
        incoming.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
