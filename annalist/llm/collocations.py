"""Phrases of two and three words that occur together more often than their parts would by chance.

Every task counts the phrases of its texts in a trie (``hat_trie``) and spills sorted runs; Spark brings the runs of a prefix
partition together, where they are merged. A phrase is counted by its first two words' partition, so a frequent first word
is spread over all of them, and equal phrases of a task are added up before the shuffle. Frequent phrases are then plain rows.
Scores are exact: products are decimals of 38 digits, which hold counts up to 10^15.

Defined cases: null texts are empty; null groups are ``und``; empty tables and texts without words give no rows; equal texts count as often as
they occur; texts of any length are read piece by piece; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.hat_trie import PhraseCounter, merge_runs
from annalist.llm.words import batched, partitions_for, ship
from annalist.session import materialize

_RUNS = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("depth", pa.int32()), ("n", pa.int64()), ("run", pa.binary())])
_PHRASES = pa.schema([("lang", pa.string()), ("size", pa.int32()), *[(f"w{i}", pa.string()) for i in (1, 2, 3)], ("f", pa.int64())])
#: bytes of text whose phrases one partition merges
MERGED_BYTES = 16_000_000
#: copies of the counts of parts, so that candidates with one frequent part are met in as many tasks
SALTS = 8


def frequent_phrases(docs: DataFrame, least: int, group: str = "lang", text: str = "text") -> DataFrame:
    """Phrases of one to three words that occur at least ``least`` times: ``lang, size, w1, w2, w3, f``.

    Rows of size 0 add up to the number of words of a group.
    """
    spark = docs.sparkSession
    ship(spark)
    given = docs.select(
        F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = partitions_for(spark, size, MERGED_BYTES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PhraseCounter(parts)

        def spilled() -> Iterator[tuple]:
            for batch in batches:
                langs = batch.column(0).to_pylist()
                for lang, value in zip(langs, batch.column(1), strict=True):
                    held.setdefault(lang, []).append(value.as_buffer().to_pybytes())
                    sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
                    if sizes[lang] >= 1 << 20:
                        yield from together(lang)
            for lang in list(held):
                yield from together(lang)
            yield from counter.finish()

        held: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def together(lang: str) -> Iterator[tuple]:
            sizes[lang] = 0
            return counter.add(lang, b"\n".join(held.pop(lang)))

        yield from batched(spilled(), _RUNS, 256)

    def merge(table: pa.Table) -> pa.Table:
        out = []
        keys = set(zip(table.column("lang").to_pylist(), table.column("depth").to_pylist(), strict=True))
        for lang, depth in sorted(keys):
            mine = table.filter(pa.compute.and_(pa.compute.equal(table["lang"], lang), pa.compute.equal(table["depth"], depth)))
            names, words, counts = merge_runs(mine.column("run").to_pylist(), depth)
            out += _kept(lang, depth, np.array(names, object), words, counts, least)
        return pa.concat_tables(out)

    import pyarrow.compute  # noqa: F401

    runs = given.mapInArrow(count, "part int, lang string, depth int, n long, run binary")
    merged = runs.repartition(parts, "part").groupBy("part").applyInArrow(merge, "lang string, size int, w1 string, w2 string, w3 string, f long")
    return materialize(merged, "phrases")


def _kept(lang: str, depth: int, names: np.ndarray, words: np.ndarray, counts: np.ndarray, least: int) -> list[pa.Table]:
    """The frequent ones of merged phrases; the number of all words where these are counted."""
    out = []

    def add(size: int, chosen: np.ndarray, f: np.ndarray) -> None:
        texts = [pa.array(names[w].tolist(), pa.binary()).cast(pa.string()) for w in chosen]
        texts += [pa.nulls(len(f), pa.string())] * (3 - len(texts))
        values = [pa.array([lang] * len(f), pa.string()), pa.array(np.full(len(f), size, np.int32)), *texts, pa.array(f)]
        out.append(pa.Table.from_arrays(values, schema=_PHRASES))

    if depth == 1:
        add(0, words[:0], counts.sum(keepdims=True))
        often = counts >= least
        add(1, words[:, often], counts[often])
        return out
    first = np.flatnonzero(np.r_[True, (words[:2, 1:] != words[:2, :-1]).any(axis=0)])
    pairs, totals = words[:2, first], np.add.reduceat(counts, first)
    often = (totals >= least) & (pairs[1] > 0)
    add(2, pairs[:, often], totals[often])
    often = (counts >= least) & (words[2] > 0)
    add(3, words[:, often], counts[often])
    return out


def exact_score(a: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(10^6 * a * a / (l * r)) of counts up to 10^15; a larger one is an error, not a wrong score."""
    n = lambda c: f"CAST({c} AS DECIMAL(15,0))"
    return F.expr(f"(CAST(1000000 AS DECIMAL(7,0)) * ({n(a)} * {n(a)})) DIV ({n(l)} * {n(r)})")


def collocations(docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """The best phrases of each ``lang``: ``lang, rank, phrase, a, l, r, n, score``.

    A candidate occurs ``a >= least`` times. Cut in two, its parts occur l and r times; the cut with the least
    floor(10^6 * a * a / (l * r)) counts, the earlier one of equals. Candidates go that lie in a longer one which
    occurs at least ``share`` percent as often. Ranked by score, then a, then the phrase in byte order.
    """
    found = frequent_phrases(docs, least)
    phrase = F.concat_ws(" ", "w1", "w2", "w3")
    parts = found.filter(F.col("size").isin(1, 2)).select("lang", phrase.alias("part"), "f")
    longer = found.filter("size > 1")
    cut = lambda k, left, right: F.struct(F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
    w1, w2, w3 = F.col("w1"), F.col("w2"), F.col("w3")
    cuts = F.when(F.col("size") == 2, F.array(cut(1, w1, w2))).otherwise(
        F.array(cut(1, w1, F.concat_ws(" ", w2, w3)), cut(2, F.concat_ws(" ", w1, w2), w3))
    )
    open_cuts = longer.select("lang", "size", phrase.alias("phrase"), F.col("f").alias("a"), F.inline(cuts))
    with_left = _look_up(open_cuts, parts, "left", "right", "l")
    with_both = _look_up(with_left, parts, "right", "left", "r")
    scored = with_both.withColumn("score", exact_score("a", "l", "r"))
    least_cut = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    candidates = scored.groupBy("lang", "size", "phrase", "a").agg(least_cut).select("lang", "size", "phrase", "a", "cut.*")

    inner = F.array(F.concat_ws(" ", w1, w2), F.concat_ws(" ", w2, w3))
    covered = (
        found.filter("size = 3")
        .select("lang", F.explode(inner).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("_longer"))
    )
    kept = candidates.join(covered, ["lang", "phrase"], "left").filter(
        (F.col("size") == 3) | F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("a"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = found.filter("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _look_up(rows: DataFrame, parts: DataFrame, part: str, other: str, name: str) -> DataFrame:
    """Add how often a part occurs. Rows with a frequent part are dealt by their other part as well."""
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("_salt")
    copies = parts.select(F.col("lang"), F.col("part").alias(part), F.col("f").alias(name), salts)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    return salted.join(copies, ["lang", part, "_salt"]).drop("_salt")
