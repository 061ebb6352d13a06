"""Cutting a time range into pieces that stay below a result cap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from annalist.functions import moment, second_at, second_index, second_number
from annalist.session import materialize


def plan_range_chunks(
    df: DataFrame, part: str, ts: str, start: dt.datetime, end: dt.datetime, cap: int
) -> DataFrame:
    """Pieces ``(part, lo, hi, n)`` of the range ``[start, end)`` holding at most ``cap`` rows.

    A piece with ``n`` rows above the cap is cut into ``ceil(n / cap) + 1`` equal
    spans, to the second, and those are counted again. One-second spans are left
    as they are, and spans without rows are left out.

    Rows are counted per second once, so later rounds move one row per busy second
    instead of one per record, and only the seconds of pieces that are still too
    big. A round at least thirds a span, so their number is logarithmic in its length.
    """
    zoneless = F.col(ts).cast("timestamp_ntz")
    seconds = (
        df.filter((zoneless >= moment(start)) & (zoneless < moment(end)))
        .groupBy(part, second_index(ts).alias("second"))
        .agg(F.count("*").alias("n"))
        .withColumn("lo", F.lit(second_number(start)).cast("bigint"))
        .withColumn("hi", F.lit(second_number(end)).cast("bigint"))
    )
    seconds = materialize(seconds, "chunk-seconds")
    done = None
    while True:
        too_big = (F.col("total") > cap) & (F.col("hi") - F.col("lo") > 1)
        counted = Observation()
        spans = seconds.groupBy(part, "lo", "hi").agg(F.sum("n").alias("total"))
        spans = materialize(spans.observe(counted, F.count_if(too_big).alias("left")), "chunk-spans")
        fits = spans.filter(~too_big)
        done = fits if done is None else done.unionByName(fits)
        if counted.get["left"] == 0:
            break
        big = spans.filter(too_big).withColumnsRenamed({part: "_part", "lo": "_lo", "hi": "_hi"})
        # rows without a part are a part of their own
        same = F.col(part).eqNullSafe(F.col("_part")) & (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi"))
        joined = seconds.join(big, same).drop("_part", "_lo", "_hi")
        seconds = materialize(_cut(joined, cap), "chunk-seconds")
    return done.select(part, second_at("lo").alias("lo"), second_at("hi").alias("hi"), F.col("total").alias("n"))


def _cut(seconds: DataFrame, cap: int) -> DataFrame:
    """Move every second from its span to the equal part of it that it falls in."""
    pieces = F.ceil(F.col("total") / F.lit(cap)).cast("bigint") + F.lit(1)
    length = F.col("hi") - F.col("lo")
    # piece i covers [lo + floor(length * i / pieces), lo + floor(length * (i + 1) / pieces))
    piece = F.expr("((second - lo + 1) * pieces - 1) div length")
    return (
        seconds.withColumn("pieces", pieces)
        .withColumn("length", length)
        .withColumn("piece", piece)
        .withColumn("new_lo", F.expr("lo + (length * piece) div pieces"))
        .withColumn("new_hi", F.expr("lo + (length * (piece + 1)) div pieces"))
        .drop("lo", "hi", "total", "pieces", "length", "piece")
        .withColumnsRenamed({"new_lo": "lo", "new_hi": "hi"})
    )
