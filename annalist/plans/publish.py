"""Publishing tables as snapshots: write aside, check, then switch.

A published table is a view on a parquet folder that nothing writes to again. Replacing
the view switches readers over at once; until then they see the previous snapshot, so a
failed run leaves nothing to restore. Who read a version and publishes what follows from it names that version; if another
run has published meanwhile, nothing is switched (``versions``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from annalist.operators.quality import require_ok
from annalist.plans.versions import Conflict, commit, newest_number
from annalist.session import write_parquet

Model = Callable[..., DataFrame]
Check = Callable[[DataFrame], DataFrame]

PUBLISHED, FAILED, SKIPPED = "published", "failed", "skipped"


def write_snapshot(df: DataFrame, name: str, root: str, buckets: tuple[int, str] | None = None) -> str:
    """Write a new snapshot below the root; gives what to select from.

    With ``buckets`` (number, column) it is a bucketed table: joins and groupings by that
    column then leave it in place, and only the other side is shuffled.
    """
    version = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/{name}/{version}"
    if buckets is None:
        write_parquet(df, path)
        return f"parquet.`{path}`"
    table = f"{name}_{version}"
    df.write.bucketBy(*buckets).option("path", path).saveAsTable(table)
    return table


def publish(
    df: DataFrame,
    name: str,
    root: str,
    check: Check | None = None,
    buckets: tuple[int, str] | None = None,
    notes: Mapping[str, str] | None = None,
    base: int | None = None,
) -> int:
    """Write, check and switch one table; gives its number of rows.

    Check and count read the stored snapshot, so nothing is computed twice, and a task
    that ran again after a loss is not counted twice. With ``base``, the number of the version that ``df`` was made
    from, a version published since then is a :class:`Conflict`.
    """
    spark = df.sparkSession
    source = write_snapshot(df, name, root, buckets)
    stored = spark.sql(f"SELECT * FROM {source}")
    if check is not None:
        require_ok(check(stored))
    rows = stored.count()  # from the file footers
    commit(spark, name, root, f"SELECT * FROM {source}", notes, base)
    return rows


def publish_models(
    spark: SparkSession,
    models: Mapping[str, Model],
    deps: Mapping[str, Sequence[str]],
    root: str,
    checks: Mapping[str, Check] | None = None,
    attempts: int = 3,
) -> DataFrame:
    """Build models after the models they read; gives ``(model, status, n_rows, error)``.

    A model is called with the published tables it depends on. One that fails keeps its
    previous snapshot, or stays absent; models that read it are skipped, others go on. A model that another
    run publishes meanwhile is built again, from what its inputs are then.
    """
    checks = checks or {}
    status: dict[str, tuple[str, int | None, str | None]] = {}
    graph = {name: [d for d in deps.get(name, ()) if d in models] for name in models}
    for name in TopologicalSorter(graph).static_order():
        if any(status[d][0] != PUBLISHED for d in graph[name]):
            status[name] = (SKIPPED, None, None)
            continue
        try:
            for left in range(attempts - 1, -1, -1):
                base = newest_number(spark, name, root)
                inputs = [spark.table(d) for d in deps.get(name, ())]
                try:
                    rows = publish(models[name](*inputs), name, root, checks.get(name), base=base)
                    break
                except Conflict:
                    if not left:
                        raise
            status[name] = (PUBLISHED, rows, None)
        except Exception as error:  # the model's own fault; the others must still be built
            status[name] = (FAILED, None, str(error))
    return spark.createDataFrame(
        [(name, *status[name]) for name in models],
        "model string, status string, n_rows bigint, error string",
    )
