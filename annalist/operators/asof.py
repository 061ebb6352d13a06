"""The period that was valid on a day, for many entities and days at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annalist.spec import ESTABLISHMENTS, TableSpec

PERIOD = "period"


def as_of(probes: DataFrame, scd: DataFrame, day: str, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Every probe with the ``period`` of its entity that holds on its day, NULL if there is none.

    Probes have the history's key and a date ``day``; other columns stay, copies are kept. Periods and days of an entity are sorted
    together and the last period that has started is carried on, so that no day is compared with more than one
    period. If periods overlap, it is the one that started last; of equal starts, the one that ends last. A
    period holds from its start, not on its end.

    Days are made distinct per entity before they are sorted: however many probes an entity has, its window is bounded by
    the calendar, and the probes themselves meet their answers by entity and day.
    """
    columns = [c for c in scd.columns if c != spec.key]
    rest = [c for c in columns if c not in (spec.start, spec.end)]
    last_end = F.struct(F.col(spec.end).isNull().alias("_open"), spec.end, *rest)
    starts = scd.groupBy(spec.key, F.col(spec.start).alias("_day")).agg(F.max(last_end).alias("_last"))
    whole = F.struct(*[(F.col("_day") if c == spec.start else F.col("_last")[c]).alias(c) for c in columns])
    periods = starts.filter("_day IS NOT NULL").select(spec.key, "_day", F.lit(0).alias("_kind"), whole.alias(PERIOD))
    asked = probes.select(spec.key, F.col(day).cast("date").alias("_day")).dropna().distinct()
    merged = periods.unionByName(asked.withColumn("_kind", F.lit(1)), allowMissingColumns=True)
    so_far = Window.partitionBy(spec.key).orderBy("_day", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = merged.withColumn(PERIOD, F.last(PERIOD, ignorenulls=True).over(so_far)).filter("_kind = 1").drop("_kind")
    ended = F.col(f"{PERIOD}.{spec.end}") <= F.col("_day")
    answers = carried.withColumn(PERIOD, F.when(~F.coalesce(ended, F.lit(False)), F.col(PERIOD)))
    found = probes.withColumn("_day", F.col(day).cast("date")).join(answers, [spec.key, "_day"], "left")
    return found.select(*probes.columns, PERIOD)
