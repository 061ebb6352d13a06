"""Readers, the batch queue and the chunk planner."""

import datetime as dt
import json
import math

import pytest
from conftest import SF, SMALL, rows
from pyspark.sql import functions as F

from annalist.operators import rows as R
from annalist.session import new_path, shared_dir
from annalist.sources import chunks, files, queue
from annalist.spec import ESTABLISHMENTS


def test_csv_is_read_as_text_and_cast_where_it_parses(spark, tmp_path):
    path = tmp_path / "stock.csv"
    path.write_text(
        "id,extra,created,state,sector,size,area,periods,treated,since\n"
        "a,?,2000-01-01,A,s,1,01001,2,2001-01-01T10:00:00,2000-05-01\n"
        "b,?,yesterday,A,s,1,01001,two,never,2000-13-01\n"
    )
    names = ["id", "extra", *[c.name for c in SMALL.source_columns if c.name != "id"]]
    raw = files.read_text_columns(spark, str(path), names)
    typed = files.scan_typed(raw, SMALL.source_columns)
    assert typed.schema == SMALL.source_schema()
    assert rows(typed, "id", "created", "treated", "since") == [
        ("a", "2000-01-01", "2001-01-01T10:00:00", "2000-05-01"),
        ("b", None, None, None),
    ]
    assert rows(R.multi_period_keys(typed, SMALL)) == [("a",)]  # "two" is no number and no error
    assert rows(files.scan_projected(raw, ["id", "size"])) == [("a", "1"), ("b", "1")]


def test_nested_records_without_open_period(spark, tmp_path):
    record = {
        "siret": "1",
        "dateDernierTraitementEtablissement": "2024-01-05T10:00:00",
        "etablissementSiege": True,
        "adresseEtablissement": {"codeCommuneEtablissement": "01001", "coordonneeLambertAbscisseEtablissement": "[ND]"},
        "periodesEtablissement": [
            {"dateDebut": "2020-01-01", "dateFin": "2021-01-01", "activitePrincipaleEtablissement": "x"},
            {"dateDebut": "2021-01-01", "dateFin": None, "activitePrincipaleEtablissement": "y"},
        ],
    }
    closed = {"siret": "2", "periodesEtablissement": record["periodesEtablissement"][:1], "unknown": 1}
    lines = [json.dumps(r) for r in (record, closed, {"siret": "3", "periodesEtablissement": []})]
    path = tmp_path / "batch.json"
    path.write_text("\n".join(lines))
    schema = files.nested_delta_schema(ESTABLISHMENTS)
    columns = ["siret", "activitePrincipaleEtablissement", "dateDebut", "coordonneeLambertAbscisseEtablissement"]
    expected = [("1", "y", "2021-01-01", None), ("2", None, None, None), ("3", None, None, None)]
    read = R.flatten_nested(files.read_ndjson(spark, str(path), schema))
    assert rows(read, *columns) == expected
    parsed = files.ingest_nested_json(spark.read.text(str(path)), schema, dt.date(2024, 2, 1))
    assert rows(R.flatten_nested(parsed), *columns) == expected
    assert rows(parsed.select("batch_date").distinct()) == [("2024-02-01",)]


def test_cursor(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    last = events.agg(F.max("ts")).first()[0]
    old = dt.datetime(2020, 1, 1)
    assert queue.next_cursor(events, "ts", old).first()[0] == last + dt.timedelta(seconds=1)
    assert queue.next_cursor(events.limit(0), "ts", old).first()[0] == old
    assert queue.incremental_slice(events, "ts", last, "event_type", [""], 0).count() == 1  # inclusive


def test_queue_table_evolves_and_is_acknowledged(spark):
    first = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2))], "id string, batch_date date")
    second = spark.createDataFrame([("c", 1.5, dt.date(2024, 1, 3))], "id string, extra double, batch_date date")
    queue.append_to_queue(first, "bronze_q")
    queue.append_to_queue(second, "bronze_q")
    queue.append_to_queue(first.filter("id = 'a'"), "bronze_q")
    table = spark.table("bronze_q")
    assert rows(table, "id", "extra") == [("a", None), ("a", None), ("b", None), ("c", 1.5)]
    assert [r[0].day for r in queue.pending_batches(table).collect()] == [1, 2, 3]
    queue.ack_in_table(spark, "bronze_q", dt.date(2024, 1, 1))
    queue.ack_in_table(spark, "bronze_q", dt.date(2024, 1, 1))
    assert rows(spark.table("bronze_q"), "id") == [("b",), ("c",)]
    assert rows(queue.ack_batch(spark.table("bronze_q"), "2024-01-02"), "id") == [("c",)]
    assert rows(queue.read_batch(spark.table("bronze_q"), dt.date(2024, 1, 3)), "id") == [("c",)]


def by_recursion(times, lo, hi, cap):
    """The planner's definition on one partition's seconds."""
    inside = [t for t in times if lo <= t < hi]
    if not inside:
        return []
    if len(inside) <= cap or hi - lo <= 1:
        return [(lo, hi, len(inside))]
    pieces = math.ceil(len(inside) / cap) + 1
    edges = [lo + (hi - lo) * i // pieces for i in range(pieces + 1)]
    return [c for a, b in zip(edges, edges[1:]) if b > a for c in by_recursion(inside, a, b, cap)]


@pytest.mark.parametrize("cap", [3, 40, 100000])
def test_chunks_equal_recursive_splitting(spark, cap):
    events = spark.read.parquet(f"{SF}/events.parquet")
    # one crowded second that cannot be split, in a third of the rows
    crowd = events.select("event_id", F.lit("view").alias("event_type"), F.lit("2024-01-09 10:00:00").cast("timestamp_ntz").alias("ts"))
    events = events.select("event_id", "event_type", "ts").unionByName(crowd.filter("event_id % 2 = 0"))
    start, end = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 31)
    origin = dt.datetime(1970, 1, 1)

    def number(t):
        return int((t - origin).total_seconds())

    found = chunks.plan_range_chunks(events, "event_type", "ts", start, end, cap)
    got = sorted((r[0], number(r[1]), number(r[2]), r[3]) for r in found.collect())
    expected = []
    for kind in ("click", "signup", "error", "purchase", "view"):
        times = [number(r[0]) for r in events.filter(F.col("event_type") == kind).select("ts").collect()]
        expected += [(kind, *c) for c in by_recursion(times, number(start), number(end), cap)]
    assert got == sorted(expected)
    assert sum(g[3] for g in got) == events.count()
    assert all(g[3] <= cap or g[2] - g[1] == 1 for g in got)


def test_comments_are_stored_with_a_table(spark, history):
    df = files.comment_columns(history({"id": "a", "start_at": "2000-01-01"}), SMALL)
    files.overwrite_table(df, "commented")
    stored = {f.name: f.metadata.get("comment") for f in spark.table("commented").schema.fields}
    assert stored["start_at"] == "Start" and stored["id"] == "Key"
    replaced = files.overwrite_table(df.select("id"), "commented")
    assert replaced.columns == ["id"]


def test_staging(spark, tmp_path, history):
    df = history({"id": "a", "start_at": "2000-01-01"})
    staged = files.stage_parquet(df, str(tmp_path / "s"))
    assert rows(staged) == rows(df) and staged.schema == df.schema
    assert rows(files.stage_parquet(df.filter("id = 'b'"), str(tmp_path / "s"))) == []


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "x") != new_path(spark, "x")


def test_spec_lists():
    spec = ESTABLISHMENTS
    assert len(spec.history_columns) == 17 and spec.key == "siret"
    assert len(spec.tracked) == len(spec.fixed) == 6
    assert spec.source_tracked == [
        "etatAdministratifEtablissement",
        "activitePrincipaleEtablissement",
        "caractereEmployeurEtablissement",
    ]
    assert len(spec.source_current_only) == 8 and len(spec.source_columns) == 16


def test_prefix_lists(spark):
    df = spark.createDataFrame([("01001",), ("1",), ("0",), ("21000",), (None,)], "code string")
    assert rows(R.region_filter(df, "code", ["01", "21"])) == [("01001",), ("21000",)]
    assert rows(R.region_filter(df, "code", ["1", "01"])) == [("01001",), ("1",)]
    assert rows(R.region_filter(df, "code", ["010"], 3)) == [("01001",)]
    assert rows(R.region_filter(df, "code", [])) == []
