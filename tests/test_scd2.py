"""One batch against a history, and the initial load, on rows written by hand."""

import datetime as dt

import pytest
from conftest import SMALL, day, rows
from pyspark.sql import functions as F

from annalist.operators import joins as J
from annalist.operators import quality as Q
from annalist.operators import scd2 as S

B = dt.date(2003, 2, 1)
SHOW = ("id", "state", "sector", "area", "start_at", "end_at")


def target(batch, scd, **options):
    return S.scd2_target(batch, scd, B, SMALL, **options)


def report(target_df, batch, scd):
    joined = S.detect_changes(J.batch_vs_open(batch, scd, SMALL), SMALL)
    found = Q.integrity_report(target_df, batch, J.affected_history(scd, batch, SMALL.key), joined, SMALL)
    return {r["check"]: r["n_bad"] for r in found.collect()}


def test_report_from_one_evaluation_equals_the_separate_one(history, batch):
    scd = history(
        {"id": "a", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "start_at": "2001-01-01"},
        {"id": "b", "start_at": "2001-01-01"},
        {"id": "c", "start_at": "2000-01-01", "end_at": "2001-01-01"},
    )
    for new in (
        batch({"id": "a", "sector": "s2", "on": "2003-01-01"}, {"id": "c", "on": "2003-01-01"}, {"id": "d", "on": "2003-01-01"}),
        batch({"id": "b", "sector": "s2", "on": "2000-01-01"}, {"id": "a", "sector": "s2", "on": None}),
        batch({"id": "b", "sector": "s2", "on": "2001-01-01"}),
    ):
        found = {r["check"]: r["n_bad"] for r in S.batch_report(new, scd, B, SMALL).collect()}
        assert found == report(target(new, scd), new, scd)


def test_null_on_either_side_is_no_change_unless_null_safe(history, batch):
    scd = history({"id": "a", "size": None, "start_at": "2002-01-01"}, {"id": "b", "start_at": "2002-01-01"})
    new = batch({"id": "a", "size": "2", "on": "2003-01-01"}, {"id": "b", "size": None, "on": "2003-01-01"})
    assert rows(target(new, scd), "id", "size", "end_at") == [("a", None, None), ("b", "1", None)]
    safe = target(new, scd, null_safe=True)
    assert rows(safe, "id", "size", "end_at") == [
        ("a", "2", None),
        ("a", None, "2003-01-01"),
        ("b", "1", "2003-01-01"),
        ("b", None, None),
    ]


def test_change_on_the_start_day_replaces_the_open_row(history, batch):
    scd = history({"id": "a", "start_at": "2003-01-01"})
    new = batch({"id": "a", "sector": "s2", "on": "2003-01-01"})
    done = target(new, scd)
    assert rows(done, *SHOW) == [("a", "A", "s2", "01001", "2003-01-01", None)]
    applied = S.scd2_apply(scd, done, spec=SMALL)
    assert rows(applied, *SHOW) == rows(done, *SHOW)
    assert set(report(done, new, scd).values()) == {0}


def test_closed_periods_keep_their_own_values(history, batch):
    scd = history(
        {"id": "a", "sector": "x", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "sector": "y", "start_at": "2001-01-01", "end_at": "2002-01-01"},
        {"id": "a", "sector": "z", "start_at": "2002-01-01"},
    )
    new = batch({"id": "a", "sector": "w", "on": "2003-01-05"})
    done = target(new, scd)
    assert rows(done, "sector", "start_at", "end_at", "batch_closed") == [
        ("w", "2003-01-05", None, None),
        ("x", "2000-01-01", "2001-01-01", None),
        ("y", "2001-01-01", "2002-01-01", None),
        ("z", "2002-01-01", "2003-01-05", "2003-02-01"),
    ]
    assert set(report(done, new, scd).values()) == {0}


def test_fixed_change_updates_all_periods_and_opens_none(history, batch):
    scd = history(
        {"id": "a", "area": "01001", "start_at": "2000-01-01", "end_at": "2001-01-01", "state": "F"},
        {"id": "a", "area": "01001", "start_at": "2001-01-01"},
    )
    new = batch({"id": "a", "area": "02002", "created": None, "on": "2003-01-05"})
    done = target(new, scd)
    assert rows(done, "area", "created", "start_at", "end_at") == [
        ("02002", None, "2000-01-01", "2001-01-01"),
        ("02002", None, "2001-01-01", None),
    ]
    fixed = S.scd2_fix_history(S.reconcile(new, scd, SMALL), SMALL)
    assert rows(fixed) == rows(done.select(*SMALL.history_columns))


def test_unseen_entity_and_entity_with_closed_rows_only(history, batch):
    scd = history(
        {"id": "b", "state": "F", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "b", "state": "A", "start_at": "2001-01-01", "end_at": "2002-01-01"},
        {"id": "c", "start_at": "2000-01-01"},
    )
    new = batch({"id": "a", "on": "2003-01-05"}, {"id": "b", "area": "09009", "on": "2003-01-06"})
    done = target(new, scd)
    assert rows(done, *SHOW) == [
        ("a", "A", "s1", "01001", "2003-01-05", None),
        ("b", "A", "s1", "01001", "2001-01-01", "2002-01-01"),
        ("b", "A", "s1", "09009", "2003-01-06", None),
        ("b", "F", "s1", "01001", "2000-01-01", "2001-01-01"),
    ]
    assert set(report(done, new, scd).values()) == {0}
    applied = S.scd2_apply(scd, done, spec=SMALL)
    assert applied.count() == 5 and ("c", "2000-01-01") in rows(applied, "id", "start_at")


def test_boundary_modes(history, batch):
    scd = history({"id": "a", "start_at": "2002-01-01"}, {"id": "b", "start_at": "2002-01-01"})
    new = batch(
        {"id": "a", "sector": "s2", "since": "2002-06-01", "treated": "2003-01-05"},
        {"id": "b", "size": "9", "since": "2002-06-01", "treated": "2003-01-05"},
        {"id": "c", "since": "2002-06-01", "treated": "2003-01-05"},
    )
    started = F.col("end_at").isNull()
    later = target(new, scd).filter(started)
    assert rows(later, "id", "start_at") == [("a", "2003-01-05"), ("b", "2003-01-05"), ("c", "2003-01-05")]
    first = target(new, scd, mode=S.EFFECTIVE_FIRST).filter(started)
    assert rows(first, "id", "start_at") == [("a", "2002-06-01"), ("b", "2003-01-05"), ("c", "2003-01-05")]
    with pytest.raises(ValueError):
        target(new, scd, mode="other")


def test_boundary_before_the_open_start_changes_nothing_and_is_reported(history, batch):
    scd = history({"id": "a", "start_at": "2003-01-10"})
    new = batch({"id": "a", "sector": "s2", "on": "2003-01-05"})
    bad = report(target(new, scd), new, scd)
    assert bad["usable"] == 1 and bad["intervals"] == 0
    assert target(new, scd).select("start_at", "end_at", "sector").collect() == scd.select("start_at", "end_at", "sector").collect()
    backwards = history({"id": "a", "start_at": "2003-01-10", "end_at": "2003-01-05"})
    for check in (Q.check_intervals, Q.check_history):
        with pytest.raises(Q.IntegrityError, match="intervals: 1"):
            Q.require_ok(check(backwards, SMALL))


def test_record_without_dates_or_on_a_used_day_changes_nothing_and_is_reported(history, batch):
    scd = history({"id": "a", "start_at": "2001-01-01"}, {"id": "b", "start_at": "2000-01-01", "end_at": "2001-01-01"})
    new = batch({"id": "a", "sector": "s2", "on": None}, {"id": "b", "on": "2000-01-01"})
    done = target(new, scd)
    assert done.count() == 2 and done.filter("start_at is null").isEmpty()
    bad = report(done, new, scd)
    assert bad["usable"] == 1 and bad["open_coverage"] == 1


def test_checks_see_missing_and_doubled_rows(history, batch):
    scd = history(
        {"id": "a", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "start_at": "2001-01-01"},
        {"id": "b", "start_at": "2001-01-01"},
    )
    new = batch({"id": "a", "sector": "s2", "on": "2003-01-05"}, {"id": "b", "on": "2003-01-05"})
    done = target(new, scd)
    assert set(report(done, new, scd).values()) == {0}
    without_closed = done.filter("start_at <> '2000-01-01'")
    assert report(without_closed, new, scd)["row_balance"] == 1
    without_open = done.filter("id <> 'b'")
    assert report(without_open, new, scd)["open_coverage"] == 1
    doubled = done.unionByName(done.filter("id = 'b'"))
    assert report(doubled, new, scd)["open_coverage"] == 1
    # one row lost and another doubled cancel out in total but not per entity
    swapped = without_closed.unionByName(done.filter("id = 'b'"))
    assert report(swapped, new, scd)["row_balance"] == 2
    twice = new.unionByName(batch({"id": "b", "sector": "s3", "on": "2003-01-05"}))
    assert report(done, twice, scd)["batch_unique"] == 1


def test_overlap_check(history):
    fine = history(
        {"id": "a", "start_at": "2000-01-01", "end_at": "2001-01-01"}, {"id": "a", "start_at": "2001-01-01"}
    )
    assert Q.check_no_overlap(fine, SMALL).first()["ok"]
    nested = history(
        {"id": "a", "start_at": "2000-01-01", "end_at": "2005-01-01"},
        {"id": "a", "start_at": "2001-01-01", "end_at": "2002-01-01"},
        {"id": "a", "start_at": "2004-01-01"},
    )
    assert Q.check_no_overlap(nested, SMALL).first()["n_bad"] == 2


def test_single_operators_make_up_the_target(history, batch):
    scd = history(
        {"id": "a", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "start_at": "2001-01-01"},
        {"id": "b", "start_at": "2001-01-01"},
    )
    new = batch(
        {"id": "a", "sector": "s2", "on": "2003-01-05"},
        {"id": "b", "area": "02002", "on": "2003-01-05"},
        {"id": "c", "on": "2003-01-05"},
    )
    joined = S.reconcile(new, scd, SMALL)
    closed = S.scd2_close(joined, B, SMALL)
    parts = S.scd2_open_new(joined, B, SMALL).unionByName(S.scd2_insert(joined, B, SMALL)).unionByName(closed)
    stays = S.scd2_fix_history(joined, SMALL).join(closed, ["id", "start_at"], "left_anti")
    whole = parts.unionByName(stays)
    assert rows(whole.select(*SMALL.history_columns)) == rows(target(new, scd).select(*SMALL.history_columns))


# --- initial load -----------------------------------------------------------------------


@pytest.fixture
def load(spark):
    stock_schema = SMALL.source_schema()

    def make(stock, periods):
        base = {"created": day("2000-01-01"), "state": "A", "sector": "s1", "size": "1", "area": "01001"}
        data = [[(base | r)[f.name] for f in stock_schema.fields] for r in stock]
        text = "id string, since string, until string, state string, sector string"
        return spark.createDataFrame(data, stock_schema), spark.createDataFrame(periods, text)

    return make


def stock_row(key, n, since, treated):
    return {"id": key, "periods": n, "since": day(since), "treated": dt.datetime.fromisoformat(treated)}


def test_initial_load_caps_future_dates(load):
    stock, periods = load(
        [
            stock_row("a", "1", "2001-05-01", "2001-04-01T10:00:00"),
            stock_row("b", "1", "2001-02-01", "2001-06-01T23:00:00"),
            stock_row("c", "1", "2009-01-01", "2001-03-01T00:00:00"),
            stock_row("d", "2", "2009-01-01", "2001-03-01T00:00:00"),
        ],
        [("d", "2000-01-01", "2009-01-01", "F", "x"), ("d", "2009-01-01", None, "A", "y")],
    )
    done = S.scd2_initial(stock, periods, B, SMALL)
    assert rows(done, "id", "sector", "start_at", "end_at", "batch_closed") == [
        ("a", "s1", "2001-05-01", None, None),
        ("b", "s1", "2001-06-01", None, None),
        ("c", "s1", "2001-06-01", None, None),
        ("d", "x", "2000-01-01", "2001-06-01", "2003-02-01"),
        ("d", "y", "2001-06-01", None, None),
    ]
    assert S.expected_rows(stock, done, SMALL).first()["ok"]


def test_several_future_periods_collapse_to_one_row(load):
    stock, periods = load(
        [stock_row("d", "3", "2008-01-01", "2001-06-01T00:00:00")],
        [
            ("d", "2000-01-01", "2005-01-01", "A", "x"),
            ("d", "2005-01-01", "2008-01-01", "A", "y"),
            ("d", "2008-01-01", None, "A", "z"),
        ],
    )
    everything = S.scd2_initial(stock, periods, B, SMALL, keep_collapsed=True)
    assert S.expected_rows(stock, everything, SMALL).first()["ok"]
    done = S.scd2_initial(stock, periods, B, SMALL)
    assert rows(done, "sector", "start_at", "end_at") == [
        ("x", "2000-01-01", "2001-06-01"),
        ("z", "2001-06-01", None),
    ]
    assert Q.check_no_overlap(done, SMALL).first()["ok"]


def test_missing_history_row_is_noticed(load):
    stock, periods = load(
        [stock_row("d", "2", "2001-01-01", "2001-06-01T00:00:00")], [("d", "2001-01-01", None, "A", "y")]
    )
    counts = S.expected_rows(stock, S.scd2_initial(stock, periods, B, SMALL, keep_collapsed=True), SMALL).first()
    assert (counts["expected"], counts["actual"], counts["ok"]) == (2, 1, False)
