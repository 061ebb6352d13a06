"""Vectors, tool calls and components against brute force and SQL; the pipeline end to end."""

import json
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

import corpus_pipeline
from annalist.llm import queries as Q
from annalist.llm.chat import link_tool_calls
from annalist.llm.components import connected_components
from annalist.llm.vector_dedup import near_vectors, sizes


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [*rng.integers(-300, 300, (260, 2)).tolist(), *[[i, i + 1] for i in range(5000, 5200)], [7, 7], [None, 1], [1, 2], [1, 2]]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            u, v = root(u), root(v)
            parent[max(u, v)] = min(u, v)
    df = spark.createDataFrame([tuple(e) for e in edges], "u long, v long")
    assert {r.node: r.component for r in connected_components(df).collect()} == {x: root(x) for x in list(parent)}
    assert connected_components(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(1)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            base = rng.standard_normal(24)
            for _ in range(rng.integers(1, 9)):
                rows.append((k, [float(x) for x in base + 0.09 * rng.standard_normal(24)], label))
                k += 1
        rows += [(k + i, [float(x) for x in base], label) for i in range(4)]
        k += 4
    rows += [(k, [0.0] * 24, 0), (k + 1, None, 0), (k + 2, [1.0, None], 0), (k + 3, [float("nan")] * 24, 0)]
    rows += [(k + 4, [1e300] * 24, 1), (k + 5, [1e-300] * 24, 1), (k + 6, [1.0, 2.0], 1), (k + 7, [2.0, 4.0], 1), (k + 8, [], 1)]
    rows += [(None, rows[0][1], 0), rows[0]]
    return rows


@pytest.mark.parametrize("chunk", [512, 3])
def test_near_vectors(spark, vectors, monkeypatch, chunk):
    monkeypatch.setattr("annalist.llm.vector_dedup.CHUNK", chunk)
    df = spark.createDataFrame([(*r, 1, "x") for r in vectors], "vec_id long, embedding array<double>, label int, table int, code string")
    unique = {r[0]: r for r in vectors if r[0] is not None}

    def unit(v):
        if not v or None in v:
            return None
        x = np.array(v, float)
        if not np.isfinite(x).all() or not x.any():
            return None
        x = x / np.abs(x).max()
        return x / np.linalg.norm(x)

    units = {i: unit(r[1]) for i, r in unique.items() if r[2] is not None}
    links = {i: set() for i in unique}
    for i, x in units.items():
        for j, y in units.items():
            if i < j and x is not None and y is not None and unique[i][2] == unique[j][2] and len(x) == len(y) and x @ y >= 0.98:
                links[i].add(j)
                links[j].add(i)
    label = {i: i for i in unique}
    for _ in unique:
        label = {i: min([label[i], *(label[j] for j in links[i])]) for i in unique}
    got = near_vectors(df).collect()
    want = Counter((r[0], 0 if r[0] is None else len(links[r[0]]), None if r[0] is None else label[r[0]]) for r in vectors)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert near_vectors(df.limit(0)).count() == 0


def test_recall_does_not_depend_on_size():
    for n in (10, 10_000, 10_000_000):
        bits, tables = sizes(n, 0.98)
        agree = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - agree) ** tables <= 1e-4 and 2**bits >= min(n, 4096)


TOOL = [("add", [("a", "integer", True), ("b", "number", False)])]


def test_tool_calls(spark):
    calls = [
        (1, "c1", None, "add", '{"b": 2.50, "a": 1}'),
        (1, "c2", "c1", "add", '{ "a" : "x" }'),
        (1, "c3", "c2", "add", '{"b": 1}'),
        (1, "c0", "c3", "add", '{"a": 1, "z": {"y": 1, "x": [null, "é\\n"]}}'),
        (2, "d1", "d2", "add", "{}"),
        (2, "d2", "d1", "add", "{}"),
        (2, "d3", "d1", "add", "{}"),
        (2, "d4", "gone", "sub", "{}"),
        (2, "d5", None, "add", "[1]"),
        (2, "d6", None, "add", None),
        (2, "d7", None, None, '{"a":1}'),
        (3, "e1", None, "add", '{"a": 1}'),
        (3, "e1", None, "add", '{"a": 1}'),
        (3, None, None, "add", "{}"),
        (None, "f1", None, "add", '{"a": 1, "b": "no"}'),
    ]
    results = [("c1", 5, "second", 0), ("c1", 2, "first", 0), ("e1", 1, None, 0), ("gone", 1, "x", 0), (None, 1, "x", 0)]
    c = spark.createDataFrame([(*x, 0) for x in calls], "conv_id long, call_id string, parent_id string, name string, arguments string, parsed int")
    r = spark.createDataFrame(results, "call_id string, turn long, content string, name int")
    s = spark.createDataFrame(TOOL, "name string, arguments array<struct<argument string, kind string, required boolean>>")
    got = {x.call_id: x for x in link_tool_calls(c, r, s).collect()}
    assert {k: x.status for k, x in got.items()} == {
        "c1": "several_results", "c2": "wrong_type", "c3": "missing_argument", "c0": "unknown_argument",
        "d1": "cycle", "d2": "cycle", "d3": "cycle", "d4": "unknown_tool", "d5": "invalid_json", "d6": "invalid_json",
        "d7": "unknown_tool", "e1": "ok", "f1": "wrong_type",
    }
    assert [got[k].position for k in ("c1", "c2", "c3", "c0")] == [0, 1, 2, 3]
    assert [got[k].depth for k in ("c1", "c2", "c3", "c0", "d1", "d4")] == [0, 1, 2, 3, None, 0]
    assert got["e1"].n_calls == 2 and got["c1"].n_results == 2
    assert got["c0"].record == (
        '{"arguments":{"a":1,"z":{"x":[null,"é\\n"],"y":1}},"id":"c0","name":"add","parent":"c3","result":null}'
    )
    assert json.loads(got["c1"].record)["result"] == "first" and '"arguments":{"a":1,"b":2.5}' in got["c1"].record
    assert link_tool_calls(c.limit(0), r.limit(0), s).count() == 0


def test_tool_calls_run_no_python(spark):
    plan = Q.queries()["op5_tool_call_linking"](spark, SF)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))


@pytest.mark.parametrize("name", list(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("conversations", "documents"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    twin = duck.execute(Q.oracle_sql()[name])
    columns = [d[0] for d in twin.description]
    got = Q.queries()[name](spark, SF).select(*columns)
    assert Counter(map(tuple, got.collect())) == Counter(twin.fetchall())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, SF)
        assert left.dtypes == docs.dtypes, name
        ids = {r.doc_id for r in left.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()} and len(ids) > 0.5 * before.count(), name
    packed = corpus_pipeline.STAGES[-1][1](spark, left, SF)
    run = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, run.select(*key).collect())) == Counter(map(tuple, packed.select(*key).collect()))
    assert {r.doc_id for r in run.collect()} == ids
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing",
    ]


def test_stages_hand_few_bytes_to_python_at_once(spark):
    docs = spark.range(9000).selectExpr("id as doc_id", "repeat('word ', 400) as text").repartition(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    stage = corpus_pipeline.small_batches(lambda spark, docs, sf_dir: docs.mapInArrow(sizes, "n long"))
    try:
        found = [r.n for r in stage(spark, docs, SF).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert sum(found) > 9000 * 2000 and max(found) < 5_000_000
    assert all(hasattr(stage, "__wrapped__") for _, stage in corpus_pipeline.STAGES)


def test_pipeline_on_odd_rows(spark):
    """Nulls, repeats, an empty table and a column that clashes with names used inside."""
    text = "the only text of this kind that there is, with some more words in it"
    rows = [(1, text, "en", "s", 9, 1), (1, text, "en", "s", 9, 1), (None, "der die das", None, None, None, None), (2, None, None, "s", 0, 2), (3, "", "en", "s", 0, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id long")
    for at in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            at = stage(spark, at, SF)
        assert {r.doc_id for r in at.collect()} <= {1, None}
