"""Built-in column expressions with the edge rules the operators rely on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = dt.date(1970, 1, 1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_date(c: Column | str | dt.date) -> Column:
    """Column, column name or Python date as a DATE column."""
    if isinstance(c, dt.date):
        return F.lit(c).cast("date")
    return _col(c).cast("date")


def moment(t: dt.datetime | str) -> Column:
    """A zone-less time as a literal, whatever the session's zone."""
    text = t if isinstance(t, str) else t.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def prefix(c: Column | str, n: int = 2) -> Column:
    return F.substring(_col(c), 1, n)


def has_prefix(c: Column | str, prefixes: Sequence[str], n: int = 2) -> Column:
    """Whether the first ``n`` characters are one of the prefixes.

    Written with ``startswith`` where that is the same, since the file reader can skip row
    groups by it and not by a substring.
    """
    c = _col(c)
    if prefixes and all(len(p) == n for p in prefixes):
        return reduce(or_, [c.startswith(p) for p in prefixes])
    return prefix(c, n).isin(*prefixes)


def month_floor(c: Column | str) -> Column:
    """First day of the month, as DATE (``date_trunc`` would give a TIMESTAMP)."""
    return F.trunc(_col(c), "MM")


def month_index(c: Column | str) -> Column:
    """Months since January 1970, an int that is cheap to compare and shuffle."""
    c = _col(c)
    return (F.year(c) - F.lit(1970)) * F.lit(12) + F.month(c) - F.lit(1)


def month_number(d: dt.date) -> int:
    """:func:`month_index` of a Python date."""
    return (d.year - 1970) * 12 + d.month - 1


def month_at(index: Column | str) -> Column:
    """First day of the month with the given index."""
    return F.add_months(F.lit(_EPOCH), _col(index))


def second_index(c: Column | str) -> Column:
    """Whole seconds since January 1970 of a zone-less time, whatever the session's zone."""
    c = _col(c).cast("timestamp_ntz")
    of_day = F.hour(c) * F.lit(3600) + F.minute(c) * F.lit(60) + F.second(c)
    return F.datediff(c, F.lit(_EPOCH)).cast("bigint") * F.lit(86400) + of_day


def second_number(t: dt.datetime) -> int:
    """:func:`second_index` of a Python datetime."""
    return int((t - dt.datetime(1970, 1, 1)).total_seconds())


def second_at(index: Column | str) -> Column:
    """The zone-less time at the given second."""
    return moment("1970-01-01") + F.make_dt_interval(secs=_col(index).cast("decimal(18,6)"))


def add_second(c: Column | str) -> Column:
    """One second later; a DATE becomes a zone-less TIMESTAMP."""
    return _col(c).cast("timestamp_ntz") + F.expr("INTERVAL 1 SECOND")


def differs(new: Column, old: Column, null_safe: bool = False) -> Column:
    """Whether a value changed; by default NULL on either side is no change."""
    if null_safe:
        return ~new.eqNullSafe(old)
    return F.coalesce(new != old, F.lit(False))


def rescued(casts: Mapping[str, tuple[Column, Column]], before: Column | None = None) -> Column:
    """Map from each name whose text did not cast to that text; NULL if all did.

    ``casts`` holds, by name, the value as it came and as it was cast. What ``before`` holds stays.
    """
    missed = [
        F.when(raw.isNotNull() & typed.isNull(), F.struct(F.lit(name).alias("key"), raw.cast("string").alias("value")))
        for name, (raw, typed) in casts.items()
    ]
    found = F.map_from_entries(F.array_compact(F.array(*missed)))
    if before is not None:
        none = F.create_map().cast("map<string,string>")
        # a name in both keeps what was rescued first
        kept = F.coalesce(before, none)
        found = F.map_concat(F.map_filter(found, lambda k, _: ~F.map_contains_key(kept, k)), kept)
    return F.when(F.size(found) > 0, found)
