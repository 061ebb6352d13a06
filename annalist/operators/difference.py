"""What differs between two snapshots of a table, and what follows from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.operators.quality import report

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def _digest(columns: Sequence[str]) -> Column:
    """One hash per column; a NULL has one of its own."""
    return F.array(*[F.xxhash64(F.col(f"`{c}`").isNull(), F.col(f"`{c}`")) for c in columns])


def snapshot_difference(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``(keys, change, columns, n)``: what was added, removed or changed, NULLs being equal.

    Both snapshots have the same columns. A key whose one row has become another one is ``changed``, and ``columns`` names the
    ones that differ; else ``n`` rows were added to it or removed. Equal rows may occur several times. Only
    the keys and a hash of 64 bits per column are shuffled, once, and rows that are in both cancel out before
    they are compared; a change goes unseen if all hashes of a key's differing columns collide.
    """
    values = [c for c in before.columns if c not in keys]
    if sorted(before.columns) != sorted(after.columns):
        raise ValueError("the snapshots have different columns")
    sides = [
        df.select(*keys, _digest(values).alias("_digest"), F.lit(sign).alias("_sign")) for df, sign in ((before, -1), (after, 1))
    ]
    net = sides[0].unionByName(sides[1]).groupBy(*keys, "_digest").agg(F.sum("_sign").alias("_n")).filter("_n != 0")
    gone, come = F.col("_n") < 0, F.col("_n") > 0
    per_key = net.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(gone, -F.col("_n"))), F.lit(0)).alias("_gone"),
        F.coalesce(F.sum(F.when(come, F.col("_n"))), F.lit(0)).alias("_come"),
        F.max(F.when(gone, F.col("_digest"))).alias("_old"),
        F.max(F.when(come, F.col("_digest"))).alias("_new"),
    )
    names = F.array(*map(F.lit, values))
    differing = F.filter(names, lambda _, i: F.get(F.col("_old"), i) != F.get(F.col("_new"), i))
    none = F.slice(names, 1, 0) if values else F.array().cast("array<string>")
    row = lambda change, columns, n: F.struct(F.lit(change).alias("change"), columns.alias("columns"), n.cast("long").alias("n"))
    both = F.array(row(REMOVED, none, F.col("_gone")), row(ADDED, none, F.col("_come")))
    changes = F.when((F.col("_gone") == 1) & (F.col("_come") == 1), F.array(row(CHANGED, differing, F.lit(1)))).otherwise(
        F.filter(both, lambda r: r["n"] > 0)
    )
    return per_key.select(*keys, F.inline(changes))


def touched_keys(difference: DataFrame, key: str) -> DataFrame:
    """The entities in which anything differs; what ``trend_changes`` needs to know of a batch."""
    return difference.select(key).distinct()


def check_difference(before: DataFrame, after: DataFrame, difference: DataFrame) -> DataFrame:
    """Rows after = rows before + added - removed, as ``(check, n_bad, ok)``; all are counted in one pass."""
    signed = F.when(F.col("change") == ADDED, F.col("n")).when(F.col("change") == REMOVED, -F.col("n")).otherwise(0)
    counts = (
        before.select(F.lit(1).cast("long").alias("d"))
        .unionByName(difference.select(signed.cast("long").alias("d")))
        .unionByName(after.select(F.lit(-1).cast("long").alias("d")))
    )
    return report(counts.agg(F.abs(F.sum("d")).alias("bad")), {"row_balance": "bad"})
