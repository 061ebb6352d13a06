"""Phrase counting against plain dictionaries, collocations against brute force and SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from annalist.llm import collocations as C
from annalist.llm import hat_trie as H
from annalist.llm import queries as Q


def pieces(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [[w for w in re.split(r"[ \t]+", p) if w] for p in re.split(r"[.,;:!?\x0a-\x0d]", lowered)]


def phrases(text, sizes=(1, 2, 3)):
    return [tuple(p[i : i + k]) for p in pieces(text) for k in sizes for i in range(len(p) - k + 1)]


def best(rows, least=10, share=50, top=2000):
    """The contract in plain words."""
    out = []
    for lang in {r[0] or "und" for r in rows}:
        f = Counter(x for g, t in rows if (g or "und") == lang for x in phrases(t))
        found = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        n, mine = sum(c for p, c in f.items() if len(p) == 1), []
        for p, a in found.items():
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            if not any(len(q) > len(p) and 100 * m >= share * a and p in (q[:2], q[1:]) for q, m in found.items()):
                mine.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(mine)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def some_rows(n=400, seed=3):
    rng = random.Random(seed)
    words = ["the", "The", "a", "é", "É", "of", "New", "york", "x\x00y", "ß", " ", "\x1c", *[f"w{i}" for i in range(12)]]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", "\n", "\x0b", "  ", "!?"]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "en", "de", None]), text))
    return [*rows, ("en", None), ("en", ""), (None, " . "), ("fr", "new york " * 700), ("fr", "new york " * 700), ("fr", "so be it. " * 30)]


@pytest.mark.parametrize(("burst", "spill", "window", "chunk"), [(8, 50, 7, 40), (64, 400, 1000, 1 << 20), (10**6, 10**9, 300_000, 1 << 20)])
def test_trie_counts_whatever_bursts_and_spills(monkeypatch, burst, spill, window, chunk):
    monkeypatch.setattr(H, "BURST", burst)
    monkeypatch.setattr(H, "WINDOW", window)
    monkeypatch.setattr(H, "CHUNK", chunk)
    counter = H.PhraseCounter(parts=8, spill=spill)
    runs, wanted = [], Counter()
    for lang, text in some_rows(120):
        runs += counter.add(lang or "und", (text or "").encode())
        wanted.update((lang or "und", p) for p in phrases(text))
    runs += counter.finish()
    got, seen = Counter(), set()
    for part, lang, depth in {r[:3] for r in runs}:
        names, words, counts = H.merge_runs([r[4] for r in runs if r[:3] == (part, lang, depth)], depth)
        assert names[1:] == sorted(names[1:]) and (np.diff(words[0]) >= 0).all()
        for w, c in zip(words.T.tolist(), counts.tolist(), strict=True):
            phrase = tuple(names[i].decode() for i in w if i)
            assert (lang, depth, tuple(w) if depth == 3 else phrase, part) not in seen
            seen.add((lang, depth, tuple(w) if depth == 3 else phrase, part))
            for k in (1,) if depth == 1 else range(2, len(phrase) + 1):
                got[lang, phrase[:k]] += c
    assert got == wanted
    assert len(runs) > 100 or spill > 100


def test_containers_burst_by_first_then_by_second_word(monkeypatch):
    monkeypatch.setattr(H, "BURST", 10)
    trie, rng = H.Trie(), np.random.default_rng(0)
    all_keys = []
    for _ in range(20):
        a, b, c = np.where(rng.random(500) < 0.5, 3, rng.integers(1, 40, 500)), rng.integers(1, 30, 500), rng.integers(0, 4, 500)
        keys = (a << 2 * H.BITS) | (b << H.BITS) | c
        trie.add(keys)
        all_keys += keys.tolist()
    assert len(trie.starts) > 40 and trie.starts == sorted(trie.containers)
    assert sum(start >> 2 * H.BITS == 3 for start in trie.starts) > 10
    wanted = Counter(all_keys)
    assert trie.find(all_keys[0]).n > 0
    keys, counts = trie.take(np.inf)
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == wanted and (np.diff(keys) > 0).all()


@pytest.fixture(scope="module")
def rows():
    return some_rows()


def test_collocations_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "1 AS f", "'x' AS phrase", "2 AS size").repartition(7)
    assert sorted(map(tuple, C.collocations(df).collect())) == best(rows)
    assert sorted(map(tuple, C.collocations(df, least=3, share=80, top=15).collect())) == best(rows, 3, 80, 15)


def test_query_equals_its_twin(spark, rows, tmp_path):
    spark.createDataFrame(rows, "lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.queries()["op13_phrase_collocations"](spark, str(tmp_path))
    con = duckdb.connect()
    con.register("documents", pa.table({"lang": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    wanted = con.sql(Q.oracle_sql()["op13_phrase_collocations"])
    assert sorted(got.columns) == sorted(wanted.columns)
    assert sorted(map(tuple, got.select(*wanted.columns).collect())) == sorted(wanted.fetchall())


def test_empty_and_small_tables(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(empty).count() == 0
    alone = spark.createDataFrame([("en", "word " * 9), ("en", None)], "lang string, text string")
    assert C.collocations(alone).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    counts = [(10, 10, 10), (3 * 10**14, 9 * 10**14, 3 * 10**14 + 1), (10**13 - 1, 10**13, 10**13), (10**9, 10**12 + 7, 10**9)]
    df = spark.createDataFrame(counts, "a long, l long, r long")
    got = [r.score for r in df.select(C.exact_score("a", "l", "r").alias("score")).collect()]
    assert got == [10**6 * a * a // (l * r) for a, l, r in counts]
