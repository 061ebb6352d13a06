"""Physical plans: what is read, how often, and how it is joined."""

import re

import pytest
from conftest import SF, rows

from annalist.catalog import bindings as B
from annalist.catalog.queries import queries
from annalist.operators import trends as T
from annalist.plans.publish import write_snapshot
from annalist.plans.replay import fold_batches, replay
from annalist.session import new_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"FileScan parquet \[(.*?)\]", text)


@pytest.mark.parametrize("name", list(queries()))
def test_no_cross_join_no_python_and_only_totals_in_one_task(spark, name):
    text = plan(queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in text
    lines = text.splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in below  # one row per task


def test_trends_read_narrow_columns_without_a_join(spark):
    text = plan(queries()["sector_trends"](spark, SF))
    assert "Join" not in text
    read = [len(s.split(",")) for s in scans(text)]
    assert len(read) == 3 and max(read) <= 6 and min(read) == 2


def test_slice_filters_at_the_scan(spark):
    text = plan(queries()["incremental_slice"](spark, SF))
    assert "GreaterThanOrEqual(ts,2024-01-11T12:00)" in text
    assert "StringStartsWith(event_type,cl)" in text


def test_open_rows_and_state_filter_at_the_scan(spark):
    text = plan(queries()["current_snapshot"](spark, SF))
    assert "IsNull(end_at)" in text and "EqualTo(etatAdministratifEtablissement,A)" in text


def test_one_batch_reads_one_partition(spark):
    assert re.search(r"PartitionFilters: \[[^\]]*batch_date", plan(queries()["read_batch"](spark, SF)))


def test_large_sides_are_not_broadcast(spark):
    """Without a small side, the batch joins shuffle by key, once per side."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(queries()["scd2_target"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in text
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, \d+\)", text)
    assert keys == ["siret"] * 3


def test_a_bucketed_history_is_not_shuffled_by_a_replay(spark):
    scd, delta = B.staged(spark, SF, "silver"), B.staged(spark, SF, "delta")
    write_snapshot(scd.repartition(4, "siret"), "bucketed", new_path(spark, "b"), (4, "siret"))
    table = next(t.name for t in spark.catalog.listTables() if t.name.startswith("bucketed_"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merge = plan(replay(spark.table(table), delta, buckets=4).history)
        fold = plan(fold_batches(spark.table(table), delta))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (merge, fold):
        lines = text.splitlines()
        scan = next(i for i, line in enumerate(lines) if table in line)
        join = next(line for line in reversed(lines[:scan]) if "Join" in line)
        between = lines[lines.index(join) + 1 : scan]
        assert not any("Exchange" in line for line in between)
        assert "Bucketed: true" in lines[scan]


def test_trends_of_a_bucketed_history_shuffle_only_sums(spark):
    scd = B.staged(spark, SF, "silver")
    write_snapshot(scd.repartition(4, "siret"), "trended", new_path(spark, "b"), (4, "siret"))
    table = next(t.name for t in spark.catalog.listTables() if t.name.startswith("trended_"))
    trends = T.sector_trends(spark.table(table), B.SPINE_START, B.SPINE_END)
    keys = [k.split("#")[0] for k in re.findall(r"Exchange hashpartitioning\(([^,]+),", plan(trends))]
    assert keys and "siret" not in keys
    assert rows(trends) == rows(T.sector_trends(scd, B.SPINE_START, B.SPINE_END))


def test_staged_tables_are_written_once(spark):
    assert B.staged(spark, SF, "silver") is B.staged(spark, SF, "silver")


def test_stock_and_history_share_the_order_periods(spark):
    for text in (plan(B.stock_text(spark, SF)), plan(B.history_text(spark, SF))):
        assert "Window" not in text  # stored once, not made again by each
