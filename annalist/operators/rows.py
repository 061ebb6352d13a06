"""Projections and filters on single rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.functions import as_date, has_prefix, prefix, rescued
from annalist.spec import ESTABLISHMENTS, TableSpec


def drop_null_key(df: DataFrame, col: str) -> DataFrame:
    """Drop rows without the given code."""
    return df.dropna(subset=[col])


def region_filter(df: DataFrame, code: str, prefixes: Sequence[str], n: int = 2) -> DataFrame:
    """Keep rows whose code starts with one of the prefixes."""
    return df.filter(has_prefix(code, prefixes, n))


def multi_period_keys(stock: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Keys of entities with a past; their periods are in the history source."""
    return stock.filter(F.col(spec.period_count).try_cast("int") > 1).select(spec.key)


def single_period(stock: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """Entities whose only period is the present one."""
    return stock.filter(F.col(spec.period_count).try_cast("int") == 1)


def active_period(df: DataFrame, arr: str, end: str, name: str = "active_period") -> DataFrame:
    """Add the first array element whose end is NULL; NULL when there is none."""
    still_open = F.filter(F.col(arr), lambda p: p[end].isNull())
    return df.withColumn(name, F.get(still_open, F.lit(0)))


def flatten_nested(df: DataFrame, spec: TableSpec = ESTABLISHMENTS, rescue: str | None = None) -> DataFrame:
    """Nested delta records as flat, typed rows carrying the period that is still open.

    ``rescue`` names a column that keeps the text of values that did not cast, by column; one that the records have already
    is added to.
    """
    with_period = active_period(df, spec.nested_periods, spec.effective_to)
    from_period = [*spec.source_tracked, spec.effective_from]
    from_address = [c for c in spec.fixed if c != spec.created_on]
    top_level = [spec.created_on, spec.treated_at, *[c for c in spec.tracked if c not in from_period]]
    sources = {c: c for c in top_level}
    sources |= {c: f"{spec.nested_address}.{c}" for c in from_address} | {c: f"active_period.{c}" for c in from_period}
    typed = {c: F.col(source).try_cast(spec.column(c).dtype) for c, source in sources.items()}
    kept = []
    if rescue:
        before = F.col(rescue) if rescue in df.columns else None
        kept.append(rescued({c: (F.col(sources[c]), v) for c, v in typed.items()}, before).alias(rescue))
    return with_period.select(
        spec.key,
        *[v.alias(c) for c, v in typed.items()],
        *[c for c in (spec.batch_date,) if c in df.columns],
        *kept,
    )


def rescued_texts(df: DataFrame, rescue: str, *kept: Column | str) -> DataFrame:
    """Rows ``(kept, column, text)``, one per value in the ``rescue`` column.

    The entries are exploded, not the column: for a column the optimizer filters rows by the map's size first, below the
    projection that parses and casts, and parses a record again for every cast.
    """
    entries = df.select(*kept, F.explode(F.map_entries(rescue)).alias("_entry"))
    names = [c for c in entries.columns if c != "_entry"]
    return entries.select(*names, F.col("_entry.key").alias("column"), F.col("_entry.value").alias("text"))


def dedup_exact(df: DataFrame) -> DataFrame:
    """Drop fully identical rows."""
    return df.dropDuplicates()


def distinct_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def open_rows(scd: DataFrame, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """The present version of every entity that has one."""
    return scd.filter(F.col(spec.end).isNull())


def state_as_of(scd: DataFrame, date: dt.date | Column | str, spec: TableSpec = ESTABLISHMENTS) -> DataFrame:
    """The version of every entity valid on a day; a period holds from its start, not its end.

    The day is a date, a column, or text that holds a date.
    """
    day = F.lit(date).cast("date") if isinstance(date, str) else as_date(date)
    return scd.filter((F.col(spec.start) <= day) & (F.col(spec.end).isNull() | (F.col(spec.end) > day)))


def current_snapshot(scd: DataFrame, spec: TableSpec = ESTABLISHMENTS, area_name: str = "departement") -> DataFrame:
    """Entities active at present, with the area derived from their municipality."""
    active = open_rows(scd, spec).filter(F.col(spec.state) == spec.active_state)
    kept = [c for c in spec.fixed + spec.tracked if c != spec.state]
    return active.select(spec.key, *kept, prefix(spec.area).alias(area_name), spec.start)


def conditional_overwrite(df: DataFrame, flag: str | Column, new: Mapping[str, Column | str]) -> DataFrame:
    """Where the flag holds, replace each column by its new value, NULL included."""
    on = F.col(flag) if isinstance(flag, str) else flag
    return df.withColumns(
        {
            name: F.when(on, F.col(value) if isinstance(value, str) else value).otherwise(F.col(name))
            for name, value in new.items()
        }
    )
