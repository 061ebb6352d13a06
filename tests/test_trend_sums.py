"""Sums changed by a batch equal those of the whole history; trends from sums equal trends from periods."""

import datetime as dt

import pytest
from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from test_trends import END, START, _period, by_hand
from pyspark.sql import functions as F

from annalist.operators import trend_sums as D
from annalist.operators import trends as T

_lists = st.lists(_period, min_size=1, max_size=10)
_check = settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))


@_check
@given(_lists, _lists, st.booleans())
def test_changed_sums_equal_those_of_the_whole(history, before, later, transitions_only):
    """Entity a gets other periods; b and c keep theirs. Overlaps, equal starts and NULL groups are among them."""
    kept = [p for p in before if p["id"] != "a"]
    old, new = history(*before), history(*kept, *[p | {"id": "a"} for p in later])
    touched = old.sparkSession.createDataFrame([("a",), ("a",), ("zz",)], "id string")
    published = D.trend_sums(old, spec=SMALL, transitions_only=transitions_only)
    change = D.trend_changes(old, new, touched, spec=SMALL, transitions_only=transitions_only)
    after = D.add_sums(published, change)
    assert rows(after) == rows(D.trend_sums(new, spec=SMALL, transitions_only=transitions_only))
    wanted = T.sector_trends(new, START, END, spec=SMALL, transitions_only=transitions_only)
    assert rows(D.trends_from_sums(after, START, END)) == rows(wanted)
    if not transitions_only:
        assert rows(wanted) == by_hand([*kept, *[p | {"id": "a"} for p in later]])


def test_sums_serve_any_range_of_months(history):
    scd = history(
        {"id": "a", "created": "1990-05-10", "start_at": "1990-05-10", "end_at": "2000-03-10"},
        {"id": "a", "created": "1990-05-10", "state": "F", "start_at": "2000-03-10"},
        {"id": "b", "created": "2030-01-10", "start_at": "2030-01-10"},
        {"id": "n", "sector": None, "start_at": "2000-01-01"},
    )
    sums = D.trend_sums(scd, spec=SMALL)
    for start, end in [("1989-01-01", "1991-07-20"), ("2000-01-01", "2000-07-20"), ("2029-12-01", "2030-04-01"), ("2000-01-01", "2000-01-01")]:
        first, last = dt.date.fromisoformat(start), dt.date.fromisoformat(end)
        assert rows(D.trends_from_sums(sums, first, last)) == rows(T.sector_trends(scd, first, last, spec=SMALL))


def test_a_group_that_loses_its_last_period_goes(history):
    old = history({"id": "a", "sector": "s1", "start_at": "2000-01-01"}, {"id": "b", "sector": "s2", "start_at": "2000-01-01"})
    new = old.withColumn("sector", F.lit("s2"))
    change = D.trend_changes(old, new, old.select("id").filter("id = 'a'"), spec=SMALL)
    after = D.add_sums(D.trend_sums(old, spec=SMALL), change)
    assert {r.ape_code for r in D.trends_from_sums(after, START, END).collect()} == {"s2"}
    nothing = D.trend_changes(old, old, old.select("id"), spec=SMALL)
    assert nothing.isEmpty()


def test_only_touched_entities_are_read(spark, history, tmp_path, monkeypatch):
    """Each history is scanned once and stays where it lies; only the touched entities' rows go on."""
    history(*[{"id": f"e{i}", "start_at": "2000-01-01"} for i in range(2000)]).write.parquet(str(tmp_path / "h"))
    spark.createDataFrame([("e7",)], "id string").write.parquet(str(tmp_path / "t"))
    scd, touched = spark.read.parquet(str(tmp_path / "h")), spark.read.parquet(str(tmp_path / "t"))
    stored, plans, store = [], [], D.materialize

    def counted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        stored.append(store(df, name))
        return stored[-1]

    monkeypatch.setattr(D, "materialize", counted)
    assert D.trend_changes(scd, scd, touched, spec=SMALL).isEmpty()
    assert [df.count() for df in stored] == [1, 1]
    for plan in plans:
        assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1  # the keys, made distinct
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize("transitions_only", [False, True])
def test_empty_history(history, transitions_only):
    none = history({"id": "a", "start_at": "2000-01-01"}).limit(0)
    sums = D.trend_sums(none, spec=SMALL, transitions_only=transitions_only)
    assert sums.isEmpty() and D.trends_from_sums(sums, START, END).isEmpty()


def test_a_change_stores_only_what_the_sums_need(history, monkeypatch):
    old = history({"id": "a", "area": "01004", "start_at": "2000-01-01"}, {"id": "b", "start_at": "2000-01-01"})
    stored, store = [], D.materialize
    monkeypatch.setattr(D, "materialize", lambda df, name: stored.append(df.columns) or store(df, name))
    dims = {"created": F.col("sector"), "state": F.col("size")}  # named like columns that the sums are made of
    new = old.withColumn("sector", F.lit("other"))
    change = D.trend_changes(old, new, old.select("id").filter("id = 'a'"), dims, SMALL)
    assert stored == [["id", "state", "created", "start_at", "end_at", "_dim0", "_dim1"]] * 2
    touched = [df.filter("id = 'a'") for df in (old, new)]
    sums = [D.trend_sums(df.select("id", "state", "created", "start_at", "end_at", F.col("sector").alias("x"), F.col("size").alias("y")), {"created": F.col("x"), "state": F.col("y")}, SMALL) for df in touched]
    assert rows(change) == rows(D.add_sums(sums[1], D._negative(sums[0])))
