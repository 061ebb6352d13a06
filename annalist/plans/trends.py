"""Published trend sums that follow a published history."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession

from annalist.operators.trend_sums import add_sums, trend_changes, trend_sums
from annalist.plans.publish import publish
from annalist.plans.versions import MADE_FROM, Version, newest, read_version
from annalist.spec import ESTABLISHMENTS, TableSpec


def touched_between(spark: SparkSession, name: str, root: str, first: int, last: int) -> DataFrame | None:
    """Keys of the entities that the versions after ``first`` up to ``last`` have touched; None if one does not say."""
    sources = []
    for number in range(first + 1, last + 1):
        layout = read_version(spark, name, root, number).layout
        if not layout or layout.get("touched") is None:
            return None
        if layout["touched"]:
            sources.append(spark.sql(f"SELECT * FROM {layout['touched']}"))
    if not sources:
        return spark.sql(read_version(spark, name, root, last).query).limit(0)
    return reduce(DataFrame.unionByName, sources).distinct()


def refresh_trend_sums(
    spark: SparkSession,
    history: str,
    name: str,
    root: str,
    dims: Mapping[str, Column] | None = None,
    spec: TableSpec = ESTABLISHMENTS,
    transitions_only: bool = False,
) -> DataFrame:
    """Bring the published sums ``name`` up to the newest version of a published history, and give them.

    The sums note the version that they were made from. If every version since then says which entities it has touched, as
    those of a history in tiers do, the sums are changed by these; else they are made from the whole history. The version that
    sums were made from stays readable until they have moved on (``expiry``). Fails with a ``Conflict`` if another run has refreshed
    them meanwhile.
    """
    now, sums = newest(spark, history, root), newest(spark, name, root)
    made_from = _made_from(sums, history)
    if made_from == now.number:
        return spark.sql(sums.query)
    touched = touched_between(spark, history, root, made_from, now.number) if made_from else None
    after = spark.sql(now.query)
    if touched is None:
        made = trend_sums(after, dims, spec, transitions_only)
    else:
        before = spark.sql(read_version(spark, history, root, made_from).query)
        made = add_sums(spark.sql(sums.query), trend_changes(before, after, touched, dims, spec, transitions_only))
    publish(made, name, root, notes={MADE_FROM: f"{history}:{now.number}"}, base=sums.number)
    return spark.sql(newest(spark, name, root).query)


def _made_from(sums: Version, history: str) -> int:
    of, _, number = sums.notes.get(MADE_FROM, "").rpartition(":")
    return int(number) if of == history else 0
