"""Replaying a queue: equal to batch-by-batch merging, stops at failures, can be repeated."""

import datetime as dt

import pytest
from conftest import SMALL, rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annalist.operators import scd2 as S
from annalist.operators.quality import IntegrityError
from annalist.plans.replay import replay, scd2_replay
from annalist.session import materialize
from annalist.sources.queue import pending_batches, read_batch


def one_by_one(scd, queue, **options):
    """The definition: merge every batch into the result of the one before."""
    for row in pending_batches(queue).collect():
        batch = read_batch(queue, row[0]).drop("batch_date").dropDuplicates()
        target = S.scd2_target(batch, scd, row[0], SMALL, **options)
        scd = materialize(S.scd2_apply(scd, target, spec=SMALL), "step")
    return scd


def test_replay_in_order(history, batch):
    scd = history({"id": "a", "sector": "x", "start_at": "2001-01-01"})
    queue = batch(
        {"id": "a", "sector": "z", "on": "2003-03-01", "batch": "2003-03-02"},
        {"id": "a", "sector": "y", "on": "2003-01-01", "batch": "2003-01-02"},
        {"id": "a", "sector": "y", "on": "2003-02-01", "batch": "2003-02-02"},
        {"id": "n", "on": "2003-02-01", "batch": "2003-02-02"},
    )
    result = replay(scd, queue, SMALL)
    assert result.halted_on is None
    assert rows(result.history, "id", "sector", "start_at", "end_at", "batch_created", "batch_closed") == [
        ("a", "x", "2001-01-01", "2003-01-01", "2001-01-01", "2003-01-02"),
        ("a", "y", "2003-01-01", "2003-03-01", "2003-01-02", "2003-03-02"),
        ("a", "z", "2003-03-01", None, "2003-03-02", None),
        ("n", "s1", "2003-02-01", None, "2003-02-02", None),
    ]
    again = scd2_replay(result.history, queue.filter("batch_date = '2003-03-02'"), SMALL)
    assert rows(again) == rows(result.history)


def test_exact_copies_are_one_record(history, batch):
    record = {"id": "a", "sector": "y", "on": "2003-01-01", "batch": "2003-01-02"}
    result = replay(history({"id": "a", "start_at": "2001-01-01"}), batch(record, record, record), SMALL)
    assert result.halted_on is None and result.history.count() == 2


@pytest.mark.parametrize(
    "bad",
    [
        # two differing records of one entity
        [
            {"id": "b", "sector": "p", "on": "2003-02-01", "batch": "2003-02-02"},
            {"id": "b", "sector": "q", "on": "2003-02-01", "batch": "2003-02-02"},
        ],
        # a change dated before the open row started
        [{"id": "a", "sector": "q", "on": "2002-01-01", "batch": "2003-02-02"}],
    ],
)
def test_stops_at_the_first_failure(history, batch, bad):
    scd = history({"id": "a", "sector": "x", "start_at": "2001-01-01"})
    queue = batch(
        {"id": "a", "sector": "y", "on": "2003-01-01", "batch": "2003-01-02"},
        *bad,
        {"id": "c", "on": "2003-02-01", "batch": "2003-02-02"},
        {"id": "d", "on": "2003-03-01", "batch": "2003-03-02"},
    )
    result = replay(scd, queue, SMALL)
    assert result.halted_on == dt.date(2003, 2, 2)
    assert rows(result.history, "id", "sector", "end_at") == [("a", "x", "2003-01-01"), ("a", "y", None)]
    assert rows(result.applied(queue, SMALL)) == [("2003-01-02",)]


def test_broken_history_stops_the_first_batch_that_meets_it(history, batch):
    scd = history({"id": "a", "start_at": "2001-01-01"}, {"id": "a", "start_at": "2002-01-01"})
    queue = batch(
        {"id": "b", "on": "2003-01-01", "batch": "2003-01-02"}, {"id": "a", "on": "2003-01-01", "batch": "2003-02-02"}
    )
    result = replay(scd, queue, SMALL)
    assert result.halted_on == dt.date(2003, 2, 2)
    assert rows(result.history, "id") == [("a",), ("a",), ("b",)]


def test_one_entity_with_a_third_of_all_records(history, batch):
    """Copies of a hot entity's record are combined before they meet."""
    hot = batch({"id": "hot", "sector": "y", "on": "2003-01-01", "batch": "2003-01-02"})
    copies = hot.select(F.explode(F.sequence(F.lit(1), F.lit(20000))).alias("n"), "*").drop("n")
    others = hot.select(F.explode(F.sequence(F.lit(1), F.lit(40000))).alias("n"), "*")
    others = others.withColumn("id", F.concat(F.lit("e"), F.col("n").cast("string"))).drop("n")
    scd = history({"id": "hot", "start_at": "2001-01-01"})
    done = scd2_replay(scd, copies.unionByName(others), SMALL)
    assert done.count() == 40002
    assert rows(done.filter("id = 'hot'"), "sector", "end_at") == [("s1", "2003-01-01"), ("y", None)]


_values = st.fixed_dictionaries(
    {
        "id": st.sampled_from(["a", "b", "c"]),
        "state": st.sampled_from(["A", "F"]),
        "sector": st.sampled_from(["x", "y", None]),
        "size": st.sampled_from(["1", None]),
        "area": st.sampled_from(["01001", "02002", None]),
        "lag": st.integers(0, 2),
    }
)


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.lists(_values, min_size=1, max_size=3, unique_by=lambda r: r["id"]), min_size=1, max_size=4),
    st.booleans(),
    st.sampled_from([S.GREATEST, S.EFFECTIVE_FIRST]),
)
def test_fold_equals_one_by_one(history, batch, batches, null_safe, mode):
    scd = history(
        {"id": "a", "state": "F", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "area": None, "start_at": "2001-01-01"},
        {"id": "b", "start_at": "2000-01-01", "end_at": "2001-01-01"},
    )
    records = []
    for i, members in enumerate(batches):
        on = dt.date(2003, 1, 1) + dt.timedelta(days=10 * i)
        for r in members:
            since = on - dt.timedelta(days=r["lag"])
            records.append({**r, "since": since, "treated": on, "batch": on})
    queue = batch(*records)
    result = replay(scd, queue, SMALL, null_safe, mode)
    assert result.halted_on is None
    assert rows(result.history) == rows(one_by_one(scd, queue, null_safe=null_safe, mode=mode))
    open_rows = result.history.filter("end_at IS NULL").groupBy("id").count()
    assert open_rows.filter("count > 1").isEmpty()


@pytest.mark.parametrize(
    "record",
    [
        {"id": "a", "sector": "s9", "on": None},  # a known entity, no date
        {"id": "n", "on": None},  # an unseen one
        {"id": None, "on": "2003-02-01"},  # no key
        {"id": "c", "on": "2000-06-01"},  # reopens on a day that a closed period covers
    ],
)
def test_a_record_that_cannot_be_placed_stops_its_batch(history, batch, record):
    scd = history(
        {"id": "a", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "start_at": "2001-01-01"},
        {"id": "b", "start_at": "2001-01-01"},
        {"id": "c", "start_at": "2000-01-01", "end_at": "2001-01-01"},
    )
    queue = batch(
        {"id": "b", "sector": "s2", "on": "2003-01-01", "batch": "2003-01-02"},
        record | {"batch": "2003-02-02"},
        {"id": "b", "sector": "s3", "on": "2003-03-01", "batch": "2003-03-02"},
    )
    result = replay(scd, queue, SMALL)
    assert result.halted_on == dt.date(2003, 2, 2)
    assert rows(result.history, "id", "sector", "start_at", "end_at") == [
        ("a", "s1", "2000-01-01", "2001-01-01"),
        ("a", "s1", "2001-01-01", None),
        ("b", "s1", "2001-01-01", "2003-01-01"),
        ("b", "s2", "2003-01-01", None),
        ("c", "s1", "2000-01-01", "2001-01-01"),
    ]


def test_a_record_without_a_batch_date_is_an_error(history, batch):
    queue = batch({"id": "a", "on": "2003-01-01", "batch": "2003-01-02"}, {"id": "b", "on": "2003-01-01"})
    with pytest.raises(IntegrityError, match="without a batch date"):
        replay(history({"id": "a", "start_at": "2001-01-01"}), queue, SMALL)


def test_closed_periods_take_corrected_values_only(history, batch):
    """A fixed change reaches the periods that were closed by then; without one they stay as they are."""
    scd = history(
        {"id": "a", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "a", "start_at": "2001-01-01"},
        {"id": "b", "area": "01009", "start_at": "2000-01-01", "end_at": "2001-01-01"},
        {"id": "b", "start_at": "2001-01-01"},
    )
    queue = batch(
        {"id": "a", "sector": "s2", "on": "2003-01-01", "batch": "2003-01-02"},
        {"id": "a", "sector": "s2", "area": "01002", "on": "2003-02-01", "batch": "2003-02-02"},
        {"id": "a", "sector": "s3", "area": "01002", "on": "2003-03-01", "batch": "2003-03-02"},
        {"id": "b", "sector": "s2", "on": "2003-01-01", "batch": "2003-01-02"},
    )
    for buckets in (None, 3):
        done = replay(scd, queue, SMALL, buckets=buckets).history
        assert rows(done, "id", "area", "sector", "start_at") == [
            ("a", "01002", "s1", "2000-01-01"),
            ("a", "01002", "s1", "2001-01-01"),
            ("a", "01002", "s2", "2003-01-01"),
            ("a", "01002", "s3", "2003-03-01"),
            ("b", "01001", "s1", "2001-01-01"),
            ("b", "01001", "s2", "2003-01-01"),
            ("b", "01009", "s1", "2000-01-01"),
        ]
