"""Publishing, first load and next batches, and the stream."""

import datetime as dt
import json

import pytest
from conftest import SMALL, rows
from test_scd2 import load, stock_row  # noqa: F401

from annalist.operators.quality import IntegrityError, check_intervals
from annalist.operators.rows import flatten_nested
from annalist.plans import ingestion, publish, versions
from annalist.session import new_path
from annalist.sources import queue
from annalist.sources.files import read_text_columns
from annalist.spec import ESTABLISHMENTS
from annalist.streaming.replay import replay_stream

LOADED = dt.date(2001, 7, 1)


def status(df):
    return {r["model"]: (r["status"], r["n_rows"]) for r in df.collect()}


def test_failing_model_keeps_its_snapshot_and_its_readers_are_skipped(spark):
    root = new_path(spark, "models")
    deps = {"m_top": ["m_base"]}

    def build(n, broken=()):
        def base():
            if "m_base" in broken:
                raise ValueError("no input")
            return spark.range(n)

        return publish.publish_models(
            spark,
            {"m_top": lambda b: b.selectExpr("id * 2 AS twice"), "m_base": base, "m_other": lambda: spark.range(n + 1)},
            deps,
            root,
        )

    assert status(build(3)) == {
        "m_base": ("published", 3),
        "m_top": ("published", 3),
        "m_other": ("published", 4),
    }
    second = build(5, broken=("m_base",))
    assert status(second) == {"m_base": ("failed", None), "m_top": ("skipped", None), "m_other": ("published", 6)}
    assert "no input" in second.filter("model = 'm_base'").first()["error"]
    assert spark.table("m_base").count() == 3 and spark.table("m_top").count() == 3
    assert spark.table("m_other").count() == 6


def test_first_failure_leaves_no_table(spark):
    def fails():
        raise ValueError("never")

    done = publish.publish_models(spark, {"m_never": fails}, {}, new_path(spark, "models"))
    assert status(done) == {"m_never": ("failed", None)}
    assert not spark.catalog.tableExists("m_never")


def test_failing_at_run_time_or_in_a_check(spark, history):
    root = new_path(spark, "models")
    bad = history({"id": "a", "start_at": "2001-01-01", "end_at": "2000-01-01"})
    done = publish.publish_models(
        spark,
        {"m_run": lambda: spark.range(1).selectExpr("raise_error('x') AS y"), "m_check": lambda: bad},
        {},
        root,
        {"m_check": lambda df: check_intervals(df, SMALL)},
    )
    assert status(done) == {"m_run": ("failed", None), "m_check": ("failed", None)}
    assert not spark.catalog.tableExists("m_check")


@pytest.fixture
def sources(load):  # noqa: F811
    return load(
        [
            stock_row("a", "1", "2001-01-01", "2001-01-01T00:00:00"),
            stock_row("b", "2", "2001-03-01", "2001-06-01T00:00:00"),
        ],
        [("b", "2000-01-01", "2001-03-01", "F", "x"), ("b", "2001-03-01", None, "A", "y")],
    )


def test_bootstrap_then_batches_until_one_fails(spark, sources, batch):
    stock, periods = sources
    root, name, queued = new_path(spark, "p"), "reg_history", "reg_queue"

    def run():
        return ingestion.bootstrap_or_incremental(spark, name, root, stock, periods, queued, LOADED, SMALL)

    queue.append_to_queue(batch({"id": "a", "sector": "s2", "on": "2001-08-01", "batch": "2001-08-02"}), queued)
    assert rows(run(), "id", "sector", "end_at") == [
        ("a", "s1", "2001-08-01"),
        ("a", "s2", None),
        ("b", "x", "2001-03-01"),
        ("b", "y", None),
    ]
    assert spark.table(queued).isEmpty()

    # the second of three batches holds two differing records of one entity
    queue.append_to_queue(batch({"id": "c", "on": "2001-09-01", "batch": "2001-09-02"}), queued)
    queue.append_to_queue(
        batch(
            {"id": "d", "on": "2001-10-01", "batch": "2001-10-02"},
            {"id": "d", "sector": "s9", "on": "2001-10-01", "batch": "2001-10-02"},
        ),
        queued,
    )
    queue.append_to_queue(batch({"id": "e", "on": "2001-11-01", "batch": "2001-11-02"}), queued)
    assert ingestion.apply_pending(spark, name, root, queued, SMALL) == dt.date(2001, 10, 2)
    assert {r[0] for r in rows(spark.table(name), "id")} == {"a", "b", "c"}
    assert [r[0].month for r in queue.pending_batches(spark.table(queued)).collect()] == [10, 11]
    before = rows(spark.table(name))
    assert ingestion.apply_pending(spark, name, root, queued, SMALL) == dt.date(2001, 10, 2)
    assert rows(spark.table(name)) == before


@pytest.mark.parametrize("buckets", [None, 3])
def test_crash_between_switch_and_acknowledgement(spark, sources, batch, monkeypatch, buckets):
    stock, periods = sources
    root, tag = new_path(spark, "p"), "x" if buckets is None else "b"
    name, queued = f"crash_history_{tag}", f"crash_queue_{tag}"
    ingestion.first_load(stock, periods, LOADED, name, root, SMALL, buckets)
    for month, sector in ((8, "s2"), (9, "s3")):
        on = f"2001-0{month}-01"
        queue.append_to_queue(batch({"id": "a", "sector": sector, "on": on, "batch": on}), queued)

    def dies(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patch:
        patch.setattr(ingestion, "ack_files", dies)
        with pytest.raises(RuntimeError):
            ingestion.apply_pending(spark, name, root, queued, SMALL, buckets)
    expected = [("s1", "2001-08-01"), ("s2", "2001-09-01"), ("s3", None)]
    assert rows(spark.table(name).filter("id = 'a'"), "sector", "end_at") == expected
    assert queue.pending_batches(spark.table(queued)).count() == 2

    assert ingestion.apply_pending(spark, name, root, queued, SMALL, buckets) is None
    assert rows(spark.table(name).filter("id = 'a'"), "sector", "end_at") == expected
    assert spark.table(queued).isEmpty()

    # a later batch with a date that was acknowledged before is a batch like any other
    again = batch({"id": "z", "on": "2001-09-01", "batch": "2001-09-01"})
    queue.append_to_queue(again, queued)
    assert ingestion.apply_pending(spark, name, root, queued, SMALL, buckets) is None
    assert ("z",) in rows(spark.table(name), "id")
    if buckets:
        assert len(spark.table(name).inputFiles()) <= buckets  # one file per bucket that has rows


def test_raw_files_to_history(spark, tmp_path):
    """CSV and JSON files in, history and cursor out, on the full registry."""
    names = [c.name for c in ESTABLISHMENTS.source_columns]
    values = dict.fromkeys(names, "") | {
        "siret": "1",
        "codeCommuneEtablissement": "01001",
        "activitePrincipaleEtablissement": "x",
        "nombrePeriodesEtablissement": "1",
        "dateDebut": "2001-01-01",
        "dateDernierTraitementEtablissement": "2001-06-01T10:00:00",
    }
    lines = [",".join(names), ",".join(values[n] for n in names)]
    lines.append(lines[1].replace("01001", "99001"))  # another region
    (tmp_path / "stock.csv").write_text("\n".join(lines))
    past = ["siret", "dateDebut", "dateFin", *ESTABLISHMENTS.source_tracked]
    (tmp_path / "history.csv").write_text(",".join(past) + "\n1,2001-01-01,,A,x,O\n")
    root = new_path(spark, "raw")
    stock, periods = ingestion.prepare_sources(
        read_text_columns(spark, str(tmp_path / "stock.csv"), names),
        read_text_columns(spark, str(tmp_path / "history.csv"), past),
        ["01"],
        root,
    )
    assert stock.count() == 1 and periods.isEmpty()
    record = {
        "siret": "1",
        "dateDernierTraitementEtablissement": "2001-08-01T10:00:00",
        "adresseEtablissement": {"codeCommuneEtablissement": "01001"},
        "periodesEtablissement": [{"dateDebut": "2001-07-20", "activitePrincipaleEtablissement": "y"}],
    }
    raw = spark.createDataFrame([(json.dumps(record),)], "value string")
    cursor = ingestion.enqueue_batch(raw, "raw_queue", dt.date(2001, 8, 2), dt.datetime(2001, 6, 1))
    assert cursor.first()[0] == dt.datetime(2001, 8, 1, 10, 0, 1)
    done = ingestion.bootstrap_or_incremental(
        spark, "raw_history", root, stock, periods, "raw_queue", LOADED, reader=flatten_nested
    )
    assert rows(done, "activitePrincipaleEtablissement", "start_at", "end_at") == [
        ("x", "2001-06-01", "2001-08-01"),
        ("y", "2001-08-01", None),
    ]


def test_first_load_refuses_missing_periods(spark, sources):
    stock, periods = sources
    with pytest.raises(IntegrityError, match="expected 3 periods, found 2"):
        ingestion.first_load(stock, periods.filter("until IS NULL"), LOADED, "reg_bad", new_path(spark, "p"), SMALL)
    assert not spark.catalog.tableExists("reg_bad")
    assert ingestion.cursor_after(stock, SMALL).first()[0] == dt.datetime(2001, 6, 1, 0, 0, 1)


def test_stream_applies_new_files_once_and_in_date_order(spark, sources, batch):
    stock, periods = sources
    root, name = new_path(spark, "p"), "reg_stream"
    ingestion.first_load(stock, periods, LOADED, name, root, SMALL)
    files, checkpoint = new_path(spark, "batches"), new_path(spark, "checkpoint")

    def run():
        stream = replay_stream(spark, files, schema, name, root, checkpoint, SMALL)
        stream.awaitTermination(300)
        return stream

    late = batch({"id": "a", "sector": "s3", "on": "2001-09-01", "batch": "2001-09-02"})
    early = batch({"id": "a", "sector": "s2", "on": "2001-08-01", "batch": "2001-08-02"})
    schema = late.schema
    late.write.parquet(files)
    early.write.mode("append").parquet(files)
    run()
    expected = [("a", "s1", "2001-08-01"), ("a", "s2", "2001-09-01"), ("a", "s3", None)]
    assert rows(spark.table(name).filter("id = 'a'"), "id", "sector", "end_at") == expected
    published = spark.table(name).inputFiles()
    run()
    assert spark.table(name).inputFiles() == published  # nothing new, nothing written
    batch({"id": "f", "on": "2001-10-01", "batch": "2001-10-02"}).write.mode("append").parquet(files)
    run()
    assert ("f",) in rows(spark.table(name), "id")


def test_stream_stops_at_a_bad_batch_and_keeps_what_came_before(spark, sources, batch):
    stock, periods = sources
    root, name = new_path(spark, "p"), "reg_stream_bad"
    ingestion.first_load(stock, periods, LOADED, name, root, SMALL)
    files, checkpoint = new_path(spark, "batches"), new_path(spark, "checkpoint")
    good = batch(
        {"id": "a", "sector": "s2", "on": "2001-08-01", "batch": "2001-08-02"},
        {"id": "a", "sector": "s3", "on": "2001-09-01", "batch": "2001-09-02"},
    )
    bad = batch({"id": "a", "sector": "s4", "on": "2000-01-01", "batch": "2001-10-02"})
    good.unionByName(bad).write.parquet(files)
    expected = [("s1", "2001-08-01"), ("s2", "2001-09-01"), ("s3", None)]
    for _ in range(2):  # the second run meets the same files and the applied batches again
        stream = replay_stream(spark, files, good.schema, name, root, checkpoint, SMALL)
        with pytest.raises(Exception, match="2001-10-02"):
            stream.awaitTermination(300)
        assert rows(spark.table(name).filter("id = 'a'"), "sector", "end_at") == expected


def test_rows_that_arrive_during_a_run_stay_queued(spark, sources, batch, monkeypatch):
    """To the same batch or to a later one: they are not acknowledged unread, and not applied twice."""
    stock, periods = sources
    root, name, queued = new_path(spark, "p"), "late_history", "late_queue"
    ingestion.first_load(stock, periods, LOADED, name, root, SMALL)
    queue.append_to_queue(batch({"id": "a", "sector": "s2", "on": "2001-08-01", "batch": "2001-08-02"}), queued)
    fold = ingestion.replay

    def meanwhile(*args, **kwargs):
        done = fold(*args, **kwargs)
        queue.append_to_queue(batch({"id": "late", "on": "2001-08-01", "batch": "2001-08-02"}), queued)
        queue.append_to_queue(batch({"id": "a", "sector": "s3", "on": "2001-09-01", "batch": "2001-09-02"}), queued)
        return done

    with monkeypatch.context() as patch:
        patch.setattr(ingestion, "replay", meanwhile)
        assert ingestion.apply_pending(spark, name, root, queued, SMALL) is None
    assert rows(spark.table(queued), "id", "batch_date") == [("a", "2001-09-02"), ("late", "2001-08-02")]
    assert ("late",) not in rows(spark.table(name), "id")
    assert ingestion.apply_pending(spark, name, root, queued, SMALL) is None
    assert spark.table(queued).isEmpty()
    assert rows(spark.table(name).filter("id in ('a', 'late')"), "id", "sector", "end_at") == [
        ("a", "s1", "2001-08-01"),
        ("a", "s2", "2001-09-01"),
        ("a", "s3", None),
        ("late", "s1", None),
    ]


def test_a_history_that_fails_its_checks_is_not_published(spark, sources, batch, monkeypatch):
    stock, periods = sources
    root, name, queued = new_path(spark, "p"), "checked_history", "checked_queue"
    ingestion.first_load(stock, periods, LOADED, name, root, SMALL)
    queue.append_to_queue(batch({"id": "a", "sector": "s2", "on": "2001-08-01", "batch": "2001-08-02"}), queued)
    fold, before = ingestion.replay, rows(spark.table(name))

    def doubled(*args, **kwargs):
        done = fold(*args, **kwargs)
        return type(done)(done.history.unionByName(done.history), done.halted_on, done.touched)

    with monkeypatch.context() as patch:
        patch.setattr(ingestion, "replay", doubled)
        with pytest.raises(IntegrityError, match="no_overlap"):
            ingestion.apply_pending(spark, name, root, queued, SMALL)
    assert rows(spark.table(name)) == before and spark.table(queued).count() == 1


def test_broken_lines_and_unknown_fields_are_kept(spark):
    good = json.dumps({"siret": "1", "dateDernierTraitementEtablissement": "2001-08-01T10:00:00", "newField": {"x": 1}})
    raw = spark.createDataFrame([(good,), ("{broken",), ("no json",)], "value string")
    args = ("kept_queue", dt.date(2001, 8, 2), dt.datetime(2001, 6, 1))
    with pytest.raises(IntegrityError, match="2 of 3"):
        ingestion.enqueue_batch(raw, *args)
    assert not spark.catalog.tableExists("kept_queue")
    root = new_path(spark, "cursor")
    ingestion.enqueue_batch(raw, *args, max_corrupt=0.7, cursor_name="kept_cursor", root=root)
    assert spark.table("kept_queue").select("siret", "_extra").first() == ("1", {"newField": '{"x":1}'})
    assert rows(spark.table("kept_queue_rejected"), "_corrupt_record") == [("no json",), ("{broken",)]
    assert spark.table("kept_cursor").first()[0] == dt.datetime(2001, 8, 1, 10, 0, 1)


def test_who_publishes_second_from_the_same_version_fails(spark):
    """Two frames read from one snapshot, each with one row more."""
    root, name = new_path(spark, "p"), "switched"
    assert publish.publish(spark.range(2), name, root, notes={f"{versions.NOTE}a": "1"}) == 2
    base = versions.newest(spark, name, root)
    first, second = (spark.sql(base.query).union(spark.range(i, i + 1)) for i in (10, 20))
    publish.publish(first, name, root, base=base.number)
    with pytest.raises(versions.Conflict, match="version 1 was read, but version 2"):
        publish.publish(second, name, root, base=base.number)
    assert rows(spark.table(name)) == [(0,), (1,), (10,)]
    assert versions.read_note(spark, name, f"{versions.NOTE}a") == "1"  # notes stay
    assert publish.publish(second, name, root) == 3  # without a base it takes the place
    assert versions.newest_number(spark, name, root) == 3


def test_names_are_taken_once(spark):
    """Of many runs that want one number, one gets it, on a local path and by a rename."""
    from concurrent.futures import ThreadPoolExecutor

    root, name = new_path(spark, "p"), "raced"
    versions.commit(spark, name, root, "SELECT 0 AS who")

    def run(who):
        try:
            return versions.commit(spark, name, root, f"SELECT {who} AS who", base=1)
        except versions.Conflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = [w for w in pool.map(run, range(1, 7)) if w]
    assert won == [2]
    assert spark.table(name).first()[0] in range(1, 7)


def test_a_rename_does_not_overwrite(spark, monkeypatch):
    """What stores without links do."""
    monkeypatch.setattr(versions, "_link", versions._rename)
    root, name = new_path(spark, "p"), "renamed"
    assert versions.commit(spark, name, root, "SELECT 1 AS v", base=0) == 1
    with pytest.raises(versions.Conflict):
        versions.commit(spark, name, root, "SELECT 2 AS v", base=0)
    assert versions.commit(spark, name, root, "SELECT 3 AS v", base=1) == 2 and spark.table(name).first()[0] == 3


def test_a_switch_that_did_not_happen_is_made_up_for(spark, monkeypatch):
    root, name = new_path(spark, "p"), "late_switch"
    versions.commit(spark, name, root, "SELECT 1 AS v")
    with monkeypatch.context() as patch:
        patch.setattr(versions, "show_newest", lambda *_: None)  # dies between the two steps
        versions.commit(spark, name, root, "SELECT 2 AS v", {f"{versions.NOTE}n": "it's\\"}, base=1)
    assert spark.table(name).first()[0] == 1
    assert versions.show_newest(spark, name, root).number == 2
    assert spark.table(name).first()[0] == 2 and versions.read_note(spark, name, f"{versions.NOTE}n") == "it's\\"


def test_overlapping_runs_lose_no_batch(spark, sources, batch, monkeypatch):
    """While one run folds, another one publishes: the first starts again, and both batches are in, once."""
    stock, periods = sources
    root, name, queued = new_path(spark, "p"), "two_runs", "two_runs_queue"
    ingestion.first_load(stock, periods, LOADED, name, root, SMALL)
    queue.append_to_queue(batch({"id": "a", "sector": "s2", "on": "2001-08-01", "batch": "2001-08-02"}), queued)
    fold, calls = ingestion.replay, []

    def meanwhile(*args, **kwargs):
        done = fold(*args, **kwargs)
        calls.append(1)
        if len(calls) == 1:
            queue.append_to_queue(batch({"id": "new", "on": "2001-08-01", "batch": "2001-08-03"}), queued)
            assert ingestion.apply_pending(spark, name, root, queued, SMALL) is None
        return done

    monkeypatch.setattr(ingestion, "replay", meanwhile)
    assert ingestion.apply_pending(spark, name, root, queued, SMALL) is None
    assert len(calls) == 2  # the second attempt found the queue empty
    assert spark.table(queued).isEmpty()
    assert rows(spark.table(name).filter("id IN ('a', 'new')"), "id", "sector", "end_at") == [
        ("a", "s1", "2001-08-01"),
        ("a", "s2", None),
        ("new", "s1", None),
    ]


def test_a_model_published_meanwhile_is_built_again(spark):
    root, built = new_path(spark, "models"), []

    def model():
        built.append(1)
        if len(built) == 1:
            publish.publish(spark.range(7), "m_twice", root)
        return spark.range(len(built))

    done = publish.publish_models(spark, {"m_twice": model}, {}, root)
    assert status(done) == {"m_twice": ("published", 2)} and len(built) == 2
    assert versions.newest_number(spark, "m_twice", root) == 2


def test_the_cursor_goes_round(spark, sources):
    """Published by the first load, read and moved on by every batch."""
    stock, periods = sources
    root, name = new_path(spark, "p"), "cursor_round"
    lines = lambda t: spark.createDataFrame([(json.dumps({"id": "a", "treated": t}),)], "value string")
    args = (f"{name}_queue", dt.date(2001, 8, 2))
    kept = {"spec": SMALL, "cursor_name": f"{name}_cursor", "root": root}
    with pytest.raises(ValueError, match="no cursor"):
        ingestion.enqueue_batch(lines("2001-08-01T10:00:00"), *args, **kept)
    ingestion.first_load(stock, periods, LOADED, name, root, SMALL, tiered=True, cursor_name=f"{name}_cursor")
    assert ingestion.stored_cursor(spark, f"{name}_cursor", root) == dt.datetime(2001, 6, 1, 0, 0, 1)
    ingestion.enqueue_batch(lines("no time"), *args, **kept)
    assert ingestion.stored_cursor(spark, f"{name}_cursor", root) == dt.datetime(2001, 6, 1, 0, 0, 1)
    ingestion.enqueue_batch(lines("2001-08-01T10:00:00"), *args, **kept)
    assert ingestion.stored_cursor(spark, f"{name}_cursor", root) == dt.datetime(2001, 8, 1, 10, 0, 1)
    assert spark.table(f"{name}_queue").count() == 2
