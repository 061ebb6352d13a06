"""What expiry removes, and what it must leave."""

import datetime as dt
import os

import pytest
from conftest import SMALL, rows

from annalist.plans import expiry, publish, tiers, versions
from annalist.session import materialize, new_path

LATER = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1)


def test_live_snapshots_notes_and_young_folders_stay(spark, monkeypatch, tmp_path):
    shared = tmp_path / "shared"
    monkeypatch.setattr(expiry, "shared_dir", lambda _: str(shared))
    root = str(tmp_path / "root")
    noted, orphan = f"{shared}/applied-{'a' * 32}", f"{shared}/replay-{'b' * 32}"
    spark.range(1).write.parquet(noted)
    spark.range(1).write.parquet(orphan)
    os.makedirs(f"{shared}/somebody_elses")
    for n in (1, 2, 3):
        publish.publish(spark.range(n), "kept", root, notes={f"{versions.NOTE}files": noted} if n == 3 else None)
    publish.publish(spark.range(9), "other", root)
    reader = spark.table("kept")
    # nothing is old enough yet
    assert expiry.expire(spark, root, dt.datetime.now(dt.timezone.utc) - dt.timedelta(hours=1)) == 0
    gone = expiry.unreferenced(spark, root, LATER)
    assert gone.count() == 3  # two versions of kept, one orphan
    assert expiry.expire(spark, root, LATER, keep=2) == 2
    assert expiry.expire(spark, root, LATER) == 1 and expiry.expire(spark, root, LATER) == 0
    assert reader.count() == 3 and spark.table("other").count() == 9
    assert sorted(os.listdir(shared)) == sorted([os.path.basename(noted), "somebody_elses"])
    assert versions.newest_number(spark, "kept", root) == 3


@pytest.mark.parametrize("buckets", [None, 2])
def test_all_parts_of_a_history_in_tiers_stay(spark, history, batch, monkeypatch, tmp_path, buckets):
    monkeypatch.setattr(expiry, "shared_dir", lambda _: str(tmp_path / "none"))
    monkeypatch.setattr(tiers, "OVERLAY_SHARE", 100.0)
    root, name = str(tmp_path / "root"), f"expired_{buckets}"
    tiers.publish_tiers(history({"id": "a", "start_at": "2000-01-01", "end_at": "2001-01-01"}, {"id": "a", "start_at": "2001-01-01"}), name, root, SMALL, buckets)
    for i in (1, 2, 3):
        todo = batch({"id": "a", "sector": f"s{i}", "area": f"0{i}001", "on": f"2003-0{i}-01", "batch": f"2003-0{i}-01"})
        tiers.publish_applied(spark, name, root, versions.newest(spark, name, root), todo, SMALL, buckets)
    before = rows(spark.table(name))
    assert expiry.expire(spark, root, LATER) == 6  # overlays, fixes and touched keys of two runs
    assert rows(spark.table(name)) == before
    tiers.fold_in(spark, name, root, SMALL, buckets, fixes=True)
    assert expiry.expire(spark, root, LATER) >= 6
    assert rows(spark.table(name)) == before


def test_folders_of_the_library_are_known_by_their_names(spark):
    for made in (new_path(spark, "x"), materialize(spark.range(1), "y").inputFiles()[0].rsplit("/", 1)[0]):
        assert expiry._OWN.search(made.rsplit("/", 1)[1])
    for other in ("year=2020", "_versions", "data-2020", "a" * 31):
        assert not expiry._OWN.search(other)
