"""Two-tier history: the same rows as a whole replay, what a run touches, and what it refuses."""

import datetime as dt
import os

import pytest
from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_replay import _values

from annalist.operators.quality import IntegrityError
from annalist.plans import ingestion, tiers, versions
from annalist.plans.replay import replay
from annalist.session import new_path
from annalist.sources import queue as Q
from annalist.streaming.replay import replay_stream


def start(history):
    return history(
        {"id": "a", "state": "F", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "area": None, "start_at": "2001-01-01"},
        {"id": "b", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "d", "start_at": "2000-01-01"},
    )


def published(spark, scd, buckets=None, name=None):
    root, name = new_path(spark, "tiers"), name or f"tiers_{os.urandom(4).hex()}"
    tiers.publish_tiers(scd, name, root, SMALL, buckets)
    return name, root


def apply(spark, name, root, records, buckets=None):
    return tiers.publish_applied(spark, name, root, versions.newest(spark, name, root), records, SMALL, buckets)


def files_of(spark, name, root):
    return {p: os.stat(p.removeprefix("file://")).st_mtime_ns for p in spark.table(name).inputFiles()}


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.lists(_values, min_size=1, max_size=3, unique_by=lambda r: r["id"]), min_size=1, max_size=4),
    st.sampled_from(["one by one", "at once"]),
    st.sampled_from([0.0, 10.0]),
)
def test_equal_to_a_whole_replay(spark, history, batch, batches, how, share):
    """Whether batches come one by one or at once, and whether every run folds in or none does."""
    scd, records = start(history), []
    for i, members in enumerate(batches):
        on = dt.date(2003, 1, 1) + dt.timedelta(days=10 * i)
        records += [{**r, "since": on - dt.timedelta(days=r["lag"]), "treated": on, "batch": on} for r in members]
    todo = batch(*records)
    name, root = published(spark, scd)
    before, tiers.OVERLAY_SHARE = tiers.OVERLAY_SHARE, share
    try:
        days = sorted({r["batch"] for r in records})
        for day in days if how == "one by one" else [None]:
            apply(spark, name, root, todo if day is None else todo.filter(F.col("batch_date") == F.lit(day)))
    finally:
        tiers.OVERLAY_SHARE = before
    wanted = rows(replay(scd, todo, SMALL).history)
    assert rows(spark.table(name)) == wanted
    tiers.fold_in(spark, name, root, SMALL, fixes=True)
    assert rows(spark.table(name)) == wanted
    assert versions.newest(spark, name, root).layout["fixes"] is None


@pytest.mark.parametrize("buckets", [None, 3])
def test_what_a_batch_leaves_untouched(spark, history, batch, buckets):
    """A change in tracked values of one entity: every file there was stays in use, and few rows are written."""
    name, root = published(spark, history(*[{"id": f"e{i}", "start_at": "2000-01-01", "end_at": "2001-01-01"} for i in range(300)],
                                          *[{"id": f"e{i}", "start_at": "2001-01-01"} for i in range(300)]), buckets)
    there = files_of(spark, name, root)
    record = {"id": "e7", "sector": "s2", "on": "2003-01-01", "batch": "2003-01-02"}
    done = apply(spark, name, root, batch(record, {"id": "e8", "on": "2003-01-01", "batch": "2003-01-02"}), buckets)
    after = files_of(spark, name, root)
    assert there.items() <= after.items()
    assert done.tiers.n_overlay == 2 and done.tiers.n_fixes == 0
    assert sum(spark.sql(f"SELECT * FROM {s}").count() for s, n in done.tiers.closed if n) == 1
    assert rows(spark.table(name).filter("id = 'e7'"), "sector", "end_at") == [
        ("s1", "2001-01-01"), ("s1", "2003-01-01"), ("s2", None)]
    # a corrected value: the closed files stay as well, and the view gives their rows the new value
    done = apply(spark, name, root, batch(record | {"area": "02002", "on": "2003-02-01", "batch": "2003-02-02"}), buckets)
    assert there.items() <= files_of(spark, name, root).items() and done.tiers.n_fixes == 1
    assert rows(spark.table(name).filter("id = 'e7'").select("area").distinct()) == [("02002",)]
    assert rows(spark.table(name).filter("id != 'e7'").select("area").distinct()) == [("01001",)]
    assert spark.table(name).count() == 601


def test_closed_periods_are_not_read_by_a_run(spark, history, batch, monkeypatch):
    name, root = published(spark, start(history))
    base = tiers.Tiers.of(versions.newest(spark, name, root))
    gone = tiers.replace(base, closed=(("parquet.`/nowhere`", 0),))
    record = {"id": "a", "sector": "s2", "area": "02002", "on": "2003-01-01", "batch": "2003-01-02"}
    done = tiers.apply_to_tiers(spark, gone, batch(record), name, root, SMALL)
    assert done.report.filter("NOT ok").isEmpty() and done.tiers.closed[1][1] == 1


def test_segments_are_merged_and_fixes_stay_right(spark, history, batch, monkeypatch):
    monkeypatch.setattr(tiers, "OVERLAY_SHARE", 100.0)
    monkeypatch.setattr(tiers, "SEGMENTS", 3)
    scd, records = start(history), []
    name, root = published(spark, scd)
    for i in range(5):  # tracked and fixed changes in turn
        on = dt.date(2003, 1 + i, 1)
        records.append({"id": "a", "sector": f"s{i}", "area": f"0{1 + i // 2}001", "on": on, "batch": on})
        apply(spark, name, root, batch(records[-1]))
    assert rows(spark.table(name)) == rows(replay(scd, batch(*records), SMALL).history)
    layout = versions.newest(spark, name, root).layout
    assert 2 <= len(layout["closed"]) <= 3 and layout["fixes"]


@pytest.mark.parametrize(
    ("spoil", "check"),
    [
        (lambda f: f.withColumn("periods", F.expr("slice(periods, 2, 9)")), "row_balance"),  # loses the first
        (lambda f: f.withColumn("periods", F.expr("filter(periods, (p, i) -> i != 1)")), "row_balance"),  # one between
        (lambda f: f.withColumn("periods", F.expr("filter(periods, p -> p.end_at IS NOT NULL)")), "open_coverage"),
        (lambda f: f.filter("id != 'a'"), "open_coverage"),  # loses the entity
        (lambda f: f.withColumn("periods", F.expr("concat(slice(periods, 1, 1), periods)")), "row_balance"),  # one twice
        (lambda f: f.unionByName(f.withColumn("id", F.lit("stranger"))), "keys"),
    ],
)
def test_a_fold_that_loses_a_row_is_not_published(spark, history, batch, monkeypatch, spoil, check):
    name, root = published(spark, start(history))
    before, fold = rows(spark.table(name)), tiers.fold_entities
    monkeypatch.setattr(tiers, "fold_entities", lambda *args, **kwargs: spoil(fold(*args, **kwargs)))
    todo = batch(*[{"id": "a", "sector": f"s{i}", "on": f"2003-0{i}-01", "batch": f"2003-0{i}-02"} for i in (2, 3, 4)])
    with pytest.raises(IntegrityError, match=check):
        apply(spark, name, root, todo)
    assert rows(spark.table(name)) == before and versions.newest_number(spark, name, root) == 1


def test_failing_batch_conflict_and_nothing_to_do(spark, history, batch):
    name, root = published(spark, start(history))
    base = versions.newest(spark, name, root)
    good = {"id": "d", "sector": "s2", "on": "2003-01-01", "batch": "2003-01-02"}
    bad = {"id": "b", "on": "2000-06-01", "batch": "2003-02-02"}  # reopens on a day that a closed period covers
    done = apply(spark, name, root, batch(good, bad, {"id": "z", "on": "2003-03-01", "batch": "2003-03-02"}))
    assert done.halted_on == dt.date(2003, 2, 2) and ("z",) not in rows(spark.table(name), "id")
    assert rows(spark.table(name).filter("id = 'd'"), "sector", "end_at") == [("s1", "2003-01-01"), ("s2", None)]
    with pytest.raises(versions.Conflict):
        tiers.publish_applied(spark, name, root, base, batch(good), SMALL)
    number = versions.newest_number(spark, name, root)
    apply(spark, name, root, batch(bad))
    assert versions.newest_number(spark, name, root) == number  # nothing applied, nothing published


def test_pending_batches_and_stream_on_tiers(spark, history, batch):
    name, root = published(spark, start(history))
    queued, files, checkpoint = f"{name}_queue", new_path(spark, "batches"), new_path(spark, "checkpoint")
    Q.append_to_queue(batch({"id": "a", "sector": "s2", "on": "2003-01-01", "batch": "2003-01-02"}), queued)
    assert ingestion.apply_pending(spark, name, root, queued, SMALL) is None
    assert spark.table(queued).isEmpty()
    assert ingestion.apply_pending(spark, name, root, queued, SMALL) is None
    incoming = batch({"id": "a", "sector": "s3", "on": "2003-02-01", "batch": "2003-02-02"})
    incoming.write.parquet(files)
    for _ in range(2):
        replay_stream(spark, files, incoming.schema, name, root, checkpoint, SMALL).awaitTermination(300)
    assert rows(spark.table(name).filter("id = 'a'"), "sector", "end_at") == [
        ("s1", "2001-01-01"), ("s1", "2003-01-01"), ("s2", "2003-02-01"), ("s3", None)]
    with pytest.raises(IntegrityError, match="one_open"):
        tiers.publish_tiers(history({"id": "x", "start_at": "2001-01-01"}, {"id": "x", "start_at": "2002-01-01"}), "two_open", root, SMALL)


@settings(max_examples=4, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.lists(_values, min_size=1, max_size=3, unique_by=lambda r: r["id"]), min_size=2, max_size=4),
    st.sampled_from(["a", "b", "c"]),
    st.integers(0, 3),
    st.booleans(),
)
def test_a_held_entity_holds_up_nobody_else(spark, history, batch, batches, bad_id, bad_at, at_once):
    """Equal to the replay without the records from the first on that can't be placed."""
    scd, records = start(history), []
    for i, members in enumerate(batches):
        on = dt.date(2003, 1, 1) + dt.timedelta(days=10 * i)
        records += [{**r, "since": on - dt.timedelta(days=r["lag"]), "treated": on, "batch": on} for r in members]
    days = sorted({r["batch"] for r in records})
    day = days[min(bad_at, len(days) - 1)]
    twice = [{"id": bad_id, "sector": s, "on": day, "batch": day} for s in ("p", "q")]  # they differ
    keyless = {"id": None, "on": days[0], "batch": days[0]}
    todo = batch(*records, *twice, keyless)
    waits = F.col("id").isNull() | ((F.col("id") == bad_id) & (F.col("batch_date") >= F.lit(day)))
    name, root = published(spark, scd)
    for d in [None] if at_once else days:
        part = todo if d is None else todo.filter(F.col("batch_date") == F.lit(d))
        done = tiers.publish_applied(spark, name, root, versions.newest(spark, name, root), part, SMALL, hold=True)
        assert done.halted_on is None
    good = todo.filter(~F.coalesce(waits, F.lit(False)))
    wanted = replay(scd, good, SMALL).history if not good.isEmpty() else scd
    assert rows(spark.table(name)) == rows(wanted)
    held = tiers.held_records(spark, name, root)
    assert rows(held.select("id", "sector", "batch_date")) == rows(todo.filter(waits).select("id", "sector", "batch_date").distinct())


def test_held_records_are_applied_when_they_can_be(spark, history, batch):
    """A record of an entity that ended later waits; when its period is there it is taken in."""
    name, root = published(spark, start(history))
    early = {"id": "b", "on": "2000-06-01", "batch": "2003-01-02"}  # reopens on a day that a closed period covers
    other = {"id": "d", "sector": "s2", "on": "2003-01-01", "batch": "2003-01-02"}
    queued = f"{name}_queue"
    Q.append_to_queue(batch(early, other), queued)
    assert ingestion.apply_pending(spark, name, root, queued, SMALL, hold=True) is None
    assert spark.table(queued).isEmpty() and tiers.held_records(spark, name, root).count() == 1
    assert rows(spark.table(name).filter("id = 'd' AND end_at IS NULL"), "sector") == [("s2",)]
    # an earlier batch opens b, so the waiting record is no change any more
    Q.append_to_queue(batch({"id": "b", "on": "2002-06-01", "batch": "2002-07-02"}), queued)
    assert ingestion.apply_pending(spark, name, root, queued, SMALL, hold=True) is None
    assert tiers.held_records(spark, name, root) is None
    assert rows(spark.table(name).filter("id = 'b' AND end_at IS NULL"), "start_at") == [("2002-06-01",)]
    plain = "plain_hold"
    from annalist.plans.publish import publish
    publish(start(history), plain, root)
    Q.append_to_queue(batch(other), queued)
    with pytest.raises(ValueError, match="tiers"):
        ingestion.apply_pending(spark, plain, root, queued, SMALL, hold=True)


def test_trend_sums_follow_a_history(spark, history, batch, monkeypatch):
    """By the touched entities while every version says which they are, from the whole table else."""
    from annalist.operators import trend_sums as D
    from annalist.plans import expiry, publish
    from annalist.plans import trends as follow

    name, root = published(spark, start(history))
    sums, whole = f"{name}_sums", []
    made = follow.trend_sums
    monkeypatch.setattr(follow, "trend_sums", lambda *args, **kwargs: whole.append(1) or made(*args, **kwargs))

    def refreshed():
        found = rows(follow.refresh_trend_sums(spark, name, sums, root, spec=SMALL))
        assert found == rows(D.trend_sums(spark.table(name), spec=SMALL))
        return found

    first = refreshed()
    assert len(whole) == 1
    records = [{"id": i, "state": s, "area": "03001", "on": f"2003-0{m}-05", "batch": f"2003-0{m}-06"} for i, s, m in
               [("a", "F", 1), ("new", "A", 2), ("a", "A", 3), ("d", "A", 4)]]
    apply(spark, name, root, batch(records[0]))
    assert refreshed() != first
    for r in records[1:3]:  # two versions at once
        apply(spark, name, root, batch(r))
    refreshed()
    number = versions.newest_number(spark, sums, root)
    refreshed()
    assert versions.newest_number(spark, sums, root) == number  # nothing new, nothing published
    tiers.fold_in(spark, name, root, SMALL, fixes=True)
    apply(spark, name, root, batch(records[3]))
    # what the sums were made from is still there for the comparison
    monkeypatch.setattr(expiry, "shared_dir", lambda _: new_path(spark, "none"))
    expiry.expire(spark, root, dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1))
    refreshed()
    assert len(whole) == 1
    publish.publish(start(history), name, root)  # a table that does not say what it touched
    refreshed()
    assert len(whole) == 2
