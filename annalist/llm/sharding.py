"""Sharding by proportional stratified interleaving.

Rows of every source are shuffled by a seeded hash and ranked. A row's fractional rank,
(rank - 1/2) / rows of its source, spreads each source evenly over [0, 1); sorted by it, any stretch of
the corpus has the mixture of the whole. Equal cuts give shards whose row counts differ by at most one
(law ``rows``).

Ranks come from range-partitioned sorts: position in the stored partition plus the rows of the
partitions before it. Only one count per partition is added up in one task, and a source that
holds most rows is split over many partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.session import materialize

_PART, _AT, _BEFORE = "__part", "__at", "__before"


def global_position(df: DataFrame, keys: Sequence[Column | str], name: str) -> DataFrame:
    """Add ``name``: the row's position from 0 in the order of ``keys``."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    low = F.monotonically_increasing_id()
    stored = materialize(
        ordered.withColumns({_PART: F.spark_partition_id(), _AT: low.bitwiseAND(F.lit((1 << 33) - 1))}), "ordered"
    )
    counts = stored.groupBy(_PART).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(_PART, F.coalesce(before, F.lit(0)).alias(_BEFORE))
    # one row per partition: bounded by the number of partitions, not by the data
    joined = stored.join(F.broadcast(starts), _PART)
    return joined.withColumn(name, F.col(_BEFORE) + F.col(_AT)).drop(_PART, _AT, _BEFORE)


def interleave(
    df: DataFrame, stratum: str, unique: Sequence[str], n_shards: int, seed: int = 7
) -> DataFrame:
    """Add ``shard`` and ``slot``; every shard has the mixture of strata of the whole table.

    Shard sizes differ by at most one row; slots count from 0 without gaps. Null is a
    stratum of its own. ``unique`` names columns that tell rows apart; equal rows get
    neighbouring places in any order. An empty table stays empty. ``df`` may not have columns
    that are called shard or slot.
    """
    taken = {"shard", "slot"} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"columns in use: {sorted(taken)}")
    shuffled = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in unique])
    first = global_position(
        df.withColumn("__shuffled", shuffled), [F.col(f"`{stratum}`"), F.col("__shuffled"), *[F.col(f"`{c}`") for c in unique]], "__g"
    )
    first = materialize(first, "ranked")
    strata = first.groupBy(F.col(f"`{stratum}`").alias("__s")).agg(F.min("__g").alias("__first"), F.count("*").alias("__n"))
    ranked = first.join(strata, F.col(f"`{stratum}`").eqNullSafe(F.col("__s")))
    fraction = (F.col("__g") - F.col("__first") + 0.5) / F.col("__n")
    second = global_position(
        ranked.withColumn("__f", fraction).drop("__first", "__n"), ["__f", "__s", "__g"], "__p"
    )
    total = first.count()
    exact = F.expr(f"(__p * {n_shards}) div {max(total, 1)}")  # integers: no rounding at the cuts
    start = F.expr(f"(__shard * {total} + {n_shards - 1}) div {n_shards}")
    return (
        second.withColumn("__shard", exact)
        .withColumn("slot", (F.col("__p") - start).cast("long"))
        .withColumn("shard", F.col("__shard").cast("int"))
        .drop("__shard", "__p", "__f", "__s", "__g", "__shuffled")
    )


def write_shards(df: DataFrame, path: str) -> None:
    """Write sharded rows as one folder per shard, ordered by slot."""
    df.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
