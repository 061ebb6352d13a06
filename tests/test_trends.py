"""Monthly measures against counting by hand."""

import datetime as dt

from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annalist.operators import joins as J
from annalist.operators import rows as R
from annalist.operators import trends as T

START, END = dt.date(2000, 1, 1), dt.date(2000, 7, 20)
MONTHS = [dt.date(2000, m, 1) for m in range(1, 7)]
BOUNDS = T.spine_bounds(START, END)


def dims():
    return T.default_dims(SMALL)


def test_calendar_spine_excludes_the_last_month(spark):
    assert [r[0] for r in T.calendar_spine(spark, START, END).collect()] == MONTHS
    assert T.calendar_spine(spark, START, dt.date(2000, 7, 1)).count() == 6
    assert T.calendar_spine(spark, START, START).count() == 0
    years = T.calendar_spine(spark, dt.date(2000, 5, 5), dt.date(2003, 2, 1), "year")
    assert [r[0].year for r in years.collect()] == [2000, 2001, 2002]


def test_change_on_a_month_start_counts_in_neither_period(history):
    scd = history(
        {"id": "a", "start_at": "1999-12-15", "end_at": "2000-03-01"},
        {"id": "a", "size": "2", "start_at": "2000-03-01", "end_at": "2000-05-02"},
    )
    found = T.nb_active(scd, bounds=BOUNDS, spec=SMALL)
    assert [r[0] for r in rows(found, "month")] == ["2000-01-01", "2000-02-01", "2000-04-01", "2000-05-01"]
    pairs = J.interval_active_join(scd, T.calendar_spine(scd.sparkSession, START, END), SMALL)
    assert rows(pairs, "month") == rows(found, "month")


def test_trends_fill_and_scores(history):
    scd = history(
        {"id": "a", "created": "2000-02-10", "start_at": "2000-02-10", "end_at": "2000-04-10"},
        {"id": "a", "created": "2000-02-10", "state": "F", "start_at": "2000-04-10", "end_at": "2000-05-20"},
        {"id": "a", "created": "2000-02-10", "start_at": "2000-05-20"},
        {"id": "n", "sector": None, "created": "2000-02-10", "start_at": "2000-02-10"},
    )
    done = T.regional_activity(T.sector_trends(scd, START, END, spec=SMALL))
    columns = ["month", *T.MEASURES, "net_growth", "dynamism_score"]
    assert rows(done.filter("ape_code = 's1'"), *columns) == [
        ("2000-01-01", 0, 0, 0, 0, None, None),
        ("2000-02-01", 0, 1, 0, 0, 0, None),
        ("2000-03-01", 1, 0, 0, 0, 1, 0.0),
        ("2000-04-01", 1, 0, 1, 0, 0, -100.0),
        ("2000-05-01", 0, 0, 0, 1, -1, None),
        ("2000-06-01", 1, 0, 0, 0, 1, 0.0),
    ]
    nothing = rows(done.filter("ape_code IS NULL"), *T.MEASURES)
    assert nothing == [(0, 0, 0, 0)] * 6


def test_attribute_change_counts_as_reopening_unless_transitions_only(history):
    scd = history(
        {"id": "a", "created": "2000-01-10", "start_at": "2000-01-10", "end_at": "2000-03-10"},
        {"id": "a", "created": "2000-01-10", "size": "2", "start_at": "2000-03-10", "end_at": "2000-04-10"},
        {"id": "a", "created": "2000-01-10", "state": "F", "start_at": "2000-04-10", "end_at": "2000-05-10"},
        {"id": "a", "created": "2000-01-10", "state": "F", "size": "3", "start_at": "2000-05-10", "end_at": "2000-06-10"},
        {"id": "a", "created": "2000-01-10", "start_at": "2000-06-10"},
    )

    def months(df, measure):
        return [r[0] for r in rows(df.filter(f"{measure} > 0"), "month")]

    every = T.sector_trends(scd, START, END, spec=SMALL)
    assert months(every, "nb_reopenings") == ["2000-03-01", "2000-06-01"]
    assert months(every, "nb_closures") == ["2000-04-01", "2000-05-01"]
    entered = T.sector_trends(scd, START, END, spec=SMALL, transitions_only=True)
    assert months(entered, "nb_reopenings") == ["2000-06-01"]
    assert months(entered, "nb_closures") == ["2000-04-01"]
    assert months(T.nb_closures(scd, spec=SMALL, transitions_only=True), "nb_closures") == ["2000-04-01"]
    assert months(T.nb_reopenings(scd, spec=SMALL, transitions_only=True), "nb_reopenings") == ["2000-06-01"]


def test_reopening_needs_a_creation_month(history):
    scd = history({"id": "a", "created": None, "start_at": "2000-03-10"})
    assert T.nb_reopenings(scd, spec=SMALL).isEmpty() and T.nb_creations(scd, spec=SMALL).isEmpty()
    assert rows(T.sector_trends(scd, START, END, spec=SMALL), "nb_reopenings", "nb_creations") == [(0, 0)] * 6


def test_state_as_of(history):
    scd = history(
        {"id": "a", "size": "1", "start_at": "2000-01-01", "end_at": "2000-02-01"},
        {"id": "a", "size": "2", "start_at": "2000-02-01"},
    )
    assert rows(R.state_as_of(scd, dt.date(2000, 1, 31), SMALL), "size") == [("1",)]
    assert rows(R.state_as_of(scd, dt.date(2000, 2, 1), SMALL), "size") == [("2",)]
    assert R.state_as_of(scd, dt.date(1999, 12, 31), SMALL).isEmpty()


_day = st.dates(dt.date(1999, 11, 1), dt.date(2000, 8, 1))
_edge = st.sampled_from(MONTHS)
_period = st.fixed_dictionaries(
    {
        "id": st.sampled_from(["a", "b", "c"]),
        "state": st.sampled_from(["A", "A", "F"]),
        "sector": st.sampled_from(["s1", "s2", None]),
        "area": st.sampled_from(["01001", "01002", "02001"]),
        "start_at": st.one_of(_day, _edge),
        "end_at": st.one_of(st.none(), _day, _edge),
        "created": st.one_of(st.none(), _day),
    }
)


def by_hand(periods):
    """Distinct entities per month, sector and department, period by period."""
    sets = {}
    pairs = {(p["sector"], p["area"][:2]) for p in periods}
    for p in periods:
        at = (p["sector"], p["area"][:2])
        if p["sector"] is None:
            continue
        for m in MONTHS:
            began, created = p["start_at"].replace(day=1), p["created"] and p["created"].replace(day=1)
            inside = p["start_at"] < m and (p["end_at"] is None or p["end_at"] > m)
            holds = (
                p["state"] == "A" and inside,
                created == m,
                p["state"] == "F" and began == m,
                p["state"] == "A" and began == m and created is not None and created != m,
            )
            for i, yes in enumerate(holds):
                if yes:
                    sets.setdefault((m, *at, i), set()).add(p["id"])
    return sorted(
        (
            (m.isoformat(), s, d, *[len(sets.get((m, s, d, i), ())) for i in range(4)])
            for m in MONTHS
            for s, d in pairs
        ),
        key=repr,
    )


@settings(max_examples=8, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(st.lists(_period, min_size=1, max_size=12))
def test_trends_equal_counting_by_hand_also_with_overlaps(history, periods):
    scd = history(*periods)
    assert rows(T.sector_trends(scd, START, END, spec=SMALL)) == by_hand(periods)
    active = T.nb_active(scd.filter("sector IS NOT NULL"), bounds=BOUNDS, spec=SMALL)
    expected = sorted((r[:4] for r in by_hand(periods) if r[3] > 0), key=repr)
    assert rows(active, "month", "ape_code", "department", "nb_active") == expected


def test_disjoint_gives_the_same_on_a_proper_history(history):
    scd = history(
        {"id": "a", "start_at": "1999-12-15", "end_at": "2000-03-01"},
        {"id": "a", "size": "2", "start_at": "2000-03-01", "end_at": "2000-05-02"},
        {"id": "b", "start_at": "2000-02-15"},
    )
    assert rows(T.sector_trends(scd, START, END, spec=SMALL, disjoint=True)) == rows(
        T.sector_trends(scd, START, END, spec=SMALL)
    )


def test_grid_and_star_join(history):
    scd = history({"id": "a", "start_at": "2000-02-15"}, {"id": "b", "sector": None, "start_at": "2000-02-15"})
    grid = J.dense_grid(scd, T.calendar_spine(scd.sparkSession, START, END), dims())
    assert grid.count() == 12
    started = scd.select(F.trunc("start_at", "MM").alias("month"), *[c.alias(n) for n, c in dims().items()])
    ones = started.groupBy(*grid.columns).agg(F.count("*").alias("n"))
    filled = J.zero_filled_star_join(grid, {"n": ones, "m": ones.withColumnRenamed("n", "m")}, grid.columns)
    assert rows(filled.filter("n > 0"), "month", "ape_code", "n", "m") == [("2000-02-01", "s1", 1, 1)]
    assert filled.count() == 12
