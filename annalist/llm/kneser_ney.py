"""Interpolated modified Kneser-Ney language model over word pairs.

Counting is a Spark job: tasks count their pairs, the counts are added up by ranges of the hash of the
pair, so that the pairs of a common word are dealt over all ranges, and what is known of a word as a first and as a
second word is added up from the sums of these ranges by ranges of its own hash. Each range
becomes a file of sorted hash arrays in the shared folder; scoring tasks map these files and look up
sorted hashes, so no model is held in memory and no table is broadcast but the list of files.

p(w | v) = max(c(vw) - D, 0) / c(v) + g(v) p(w), p(w) = max(N(w) - D, 0) / N + g / (V + 1)

with N(w) the number of different words before w, and the three discounts D of each
level from its counts of counts. V + 1 stands for all training words, the end and an unknown word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annalist.llm.shards import map_arrays, write_arrays
from annalist.llm.words import (
    U64,
    byte_texts,
    hash_words,
    mix,
    part_of,
    partitions_for,
    runs,
    ship,
    split_by,
    with_columns,
    words_of,
)
from annalist.session import materialize, new_path

# no word holds a space
BEGIN, END = (U64(xxhash.xxh3_64_intdigest(x)) for x in (b" begin", b" end"))
#: tokens that a task counts or scores at a time
TOKENS = 1_000_000


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(v * U64(0x9E3779B97F4A7C15) + w)


def _pairs(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First and second word of every pair of the texts, begin and end included."""
    v = [x for h in hashes for x in (np.array([BEGIN]), h)]
    w = [x for h in hashes for x in (h, np.array([END]))]
    return np.concatenate(v), np.concatenate(w)


def _gathered(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Rows and the word hashes of their whole texts, about TOKENS at a time."""
    rows: list[tuple] = []
    hashes: list[np.ndarray] = []
    size = 0
    for batch in batches:
        keys = zip(*[batch.column(c).to_pylist() for c in columns], strict=True) if columns else [()] * batch.num_rows
        for key, text in zip(keys, byte_texts(batch.column("text")), strict=True):
            rows.append(key)
            hashes.append(hash_words(words_of(text)))
            size += len(hashes[-1]) + 1
            if size >= TOKENS:
                yield rows, hashes
                rows, hashes, size = [], [], 0
    if rows:
        yield rows, hashes


@dataclass
class Level:
    """Sum of counts and discounts of one level."""

    total: int
    discounts: tuple[float, float, float]

    @classmethod
    def of(cls, total: int, n: list[int]) -> Level:
        if not (n[0] and n[1]):
            return cls(total, (0.5, 0.5, 0.5))
        y = n[0] / (n[0] + 2 * n[1])
        found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else 0.5 for k in range(3)]
        return cls(total, tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)))

    def discount(self, c: np.ndarray) -> np.ndarray:
        return np.array([0.0, *self.discounts])[np.minimum(c, 3)]


@dataclass
class Model:
    parts: int
    pairs: dict[int, tuple[str, int, int]]  # range: file, number of pairs, of those that occur more than once
    words: dict[int, tuple[str, int, int]]  # range: file, number of first words, number of second words
    high: Level
    low: Level
    low_left: float  # weight of the uniform distribution
    n_docs: int
    n_tokens: int
    n_types: int

    def open(self) -> Reader:
        return Reader(self)


class Reader:
    """The mapped model of one worker."""

    def __init__(self, model: Model):
        self.model = model
        self.maps: dict[tuple[str, int], list[np.ndarray]] = {}

    def _shard(self, kind: str, part: int) -> list[np.ndarray] | None:
        if (kind, part) not in self.maps:
            m = self.model
            if kind == "pairs" and part in m.pairs:
                file, n, more = m.pairs[part]
                found = map_arrays(file, [("<u8", n - more), ("<u8", more), ("<u4", more)])
            elif kind == "words" and part in m.words:
                file, k, n = m.words[part]
                found = map_arrays(file, [("<u8", k), ("<i8", 4 * k), ("<u8", n), ("<u4", n)])
            else:
                found = None
            self.maps[kind, part] = found
        return self.maps[kind, part]

    @staticmethod
    def _find(keys: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(keys, q)
        at[at == len(keys)] = 0
        return at, keys[at] == q if len(keys) else np.zeros(len(q), bool)

    def counts(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Training count of each pair."""
        key, at = np.unique(pair_hash(v, w), return_index=True)
        out = np.zeros(len(key), np.int64)
        for part, i in split_by(part_of(key, self.model.parts)):
            if shard := self._shard("pairs", part):
                _, once = self._find(shard[0], key[i])
                out[i[once]] = 1
                i = i[~once]
                where, hit = self._find(shard[1], key[i])
                out[i[hit]] = shard[2][where[hit]]
        return out[np.searchsorted(key, pair_hash(v, w))]

    def word(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each word: (c, N1, N2, N3+) as a first word, and the number of different words before it."""
        first, before = np.zeros((len(h), 4), np.int64), np.zeros(len(h), np.int64)
        for part, i in split_by(part_of(h, self.model.parts)):
            if shard := self._shard("words", part):
                if len(shard[0]):
                    where, hit = self._find(shard[0], h[i])
                    first[i[hit]] = shard[1].reshape(-1, 4)[where[hit]]
                if len(shard[2]):
                    where, hit = self._find(shard[2], h[i])
                    before[i[hit]] = shard[3][where[hit]]
        return first, before

    def log10(self, v: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p(w | v), and the training count of each w."""
        m = self.model
        known, at = np.unique(np.r_[v, w], return_inverse=True)
        first, before = self.word(known)
        at_v, at_w = at[: len(v)], at[len(v) :]
        count = np.where(known == END, m.n_docs, first[:, 0])
        low = np.full(len(known), 1.0)
        if m.low.total:
            low = np.maximum(before - m.low.discount(before), 0) / m.low.total
        low = low * (1 if m.low.total else 0) + m.low_left / (m.n_types + 1)
        c = self.counts(v, w)
        of = first[at_v, 0]
        left = first[at_v, 1:] @ np.array(m.high.discounts)
        p = np.where(
            of > 0,
            (np.maximum(c - m.high.discount(c), 0) + left * low[at_w]) / np.maximum(of, 1),
            low[at_w],
        )
        return np.log10(p), count[at_w]


def _of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def train(docs: DataFrame) -> Model:
    """Count rows (text) of whole texts; null texts are empty. The files stay in the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("text")
    n_docs, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    parts = partitions_for(spark, size // 6, 3_000_000)
    folder = new_path(spark, "language-model")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, hashes in _gathered(batches, []):
            v, w = _pairs(hashes)
            _, at, c = np.unique(pair_hash(v, w), return_index=True, return_counts=True)
            v, w = v[at], w[at]
            order = np.argsort(v, kind="stable")  # equal first words stand together and compress
            v, w, c = v[order], w[order], c[order].astype("<u4")
            got = [(p, v[i].tobytes() + w[i].tobytes() + c[i].tobytes()) for p, i in split_by(part_of(pair_hash(v, w), parts))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.binary())], ["part", "packed"]
            )

    def add_pairs(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        blobs = [(x, len(x) // 20) for x in table.column("packed").to_pylist()]
        v = np.concatenate([np.frombuffer(x, U64, n) for x, n in blobs])
        w = np.concatenate([np.frombuffer(x, U64, n, 8 * n) for x, n in blobs])
        c = np.concatenate([np.frombuffer(x, "<u4", n, 16 * n) for x, n in blobs]).astype(np.int64)
        key = pair_hash(v, w)
        order = np.argsort(key)
        starts, _ = runs(key[order])
        c = np.add.reduceat(c[order], starts)
        v, w, key = v[order][starts], w[order][starts], key[order][starts]
        # most pairs occur once, which needs no number
        once = c == 1
        file = write_arrays(folder, f"pairs-{part}", [key[once], key[~once], c[~once].astype("<u4")])
        rows = [(part, None, 2, file, [len(key), int((~once).sum()), int(c.sum()), *_of_counts(c)])]
        first, at = np.unique(v, return_inverse=True)
        stats = np.stack([np.bincount(at, x, len(first)) for x in (c, c == 1, c == 2, c > 2)], 1).astype("<i8")
        second, before = np.unique(w, return_counts=True)
        # most words stand before and after one word only here, which needs no number
        sides = [
            (first, stats[:, 0] > 1, stats),
            (second, before > 1, before.astype("<u4")),
        ]
        for side, (word, several, numbers) in enumerate(sides):
            for p, i in split_by(part_of(word, parts)):
                one, more = i[~several[i]], i[several[i]]
                head = np.array([side, len(one), len(more)], "<u4").tobytes()
                rows.append((p, head + word[one].tobytes() + word[more].tobytes() + numbers[more].tobytes(), None, None, None))
        return _table(rows)

    def add_words(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        # the row that names the file of this range's pairs goes through
        rows = [tuple(r.values()) for r in table.filter(pc.is_valid(table.column("file"))).to_pylist()]
        packed = table.column("packed").drop_null()
        if not len(packed):
            return _table(rows)
        words, numbers = ([], []), ([], [])
        for x in packed.to_pylist():
            side, one, more = np.frombuffer(x, "<u4", 3).tolist()
            at = 12 + 8 * (one + more)
            words[side].append(np.frombuffer(x, U64, one + more, 12))
            if side:
                numbers[1].append(np.r_[np.ones(one, np.int64), np.frombuffer(x, "<u4", more, at)])
            else:
                single = np.tile(np.array([1, 1, 0, 0]), (one, 1))
                numbers[0].append(np.r_[single, np.frombuffer(x, "<i8", 4 * more, at).reshape(-1, 4)])
        empty = np.empty(0, U64)
        v, at = np.unique(np.concatenate([empty, *words[0]]), return_inverse=True)
        stats = np.zeros((len(v), 4), "<i8")
        if len(v):
            held = np.concatenate(numbers[0])
            stats = np.stack([np.bincount(at, held[:, k], len(v)) for k in range(4)], 1).astype("<i8")
        w, at = np.unique(np.concatenate([empty, *words[1]]), return_inverse=True)
        n = np.zeros(0, np.int64)
        if len(w):
            n = np.bincount(at, np.concatenate(numbers[1]), len(w)).astype(np.int64)
        file = write_arrays(folder, f"words-{part}", [v, stats.ravel(), w, n.astype("<u4")])
        return _table([*rows, (part, None, 1, file, [len(v), len(w), int(n.sum()), *_of_counts(n), int((n > 2).sum())])])

    kinds = "part int, packed binary, level int, file string, info array<long>"
    counted = docs.mapInArrow(count, "part int, packed binary").groupBy("part").applyInArrow(add_pairs, kinds)
    # what the pairs say of their words goes straight on to the words' ranges, and is on disk once, as this shuffle
    made = materialize(counted.groupBy("part").applyInArrow(add_words, kinds).drop("packed"), "files")
    # one short row per file
    files = made.collect()
    pairs, words = ([r for r in files if r["level"] == level] for level in (2, 1))
    n = [sum(r["info"][k] for r in pairs) for k in range(7)]
    k = [sum(r["info"][k] for r in words) for k in range(1, 8)]
    high, low = Level.of(n[2], n[3:7]), Level.of(k[1], k[2:6])
    left = (low.discounts[0] * k[2] + low.discounts[1] * k[3] + low.discounts[2] * k[6]) / k[1] if k[1] else 1.0
    return Model(
        parts,
        {r["part"]: (r["file"], r["info"][0], r["info"][1]) for r in pairs},
        {r["part"]: (r["file"], r["info"][0], r["info"][1]) for r in words},
        high,
        low,
        left,
        n_docs,
        n[2],
        k[0],
    )


def _table(rows: list[tuple]) -> pa.Table:
    kinds = (pa.int32(), pa.binary(), pa.int32(), pa.string(), pa.list_(pa.int64()))
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.Table.from_arrays(columns, ["part", "packed", "level", "file", "info"])


def score(
    docs: DataFrame, model: Model, held_out: Column, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity), one per row.

    Null texts are empty; an empty text has one token, the end. Scores are log10 probabilities of the
    whole text; ``base_score`` is that of single words with half a count added. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = with_columns(docs.withColumn("__held", held_out), doc_id=id_column, text=text_column, held_out="__held")
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    shared = spark.sparkContext.broadcast(model)  # file names and a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        reader = m.open()
        for rows, hashes in _gathered(batches, ["doc_id", "held_out"]):
            v, w = _pairs(hashes)
            logs, count = reader.log10(v, w)
            base = np.log10((count + 0.5) / (m.n_tokens + 0.5 * (m.n_types + 1)))
            sizes = np.array([len(h) + 1 for h in hashes])
            starts = np.cumsum(sizes) - sizes
            total = np.add.reduceat(logs, starts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.bool_()),
                    pa.array(sizes, pa.int64()),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), starts), pa.int64()),
                    pa.array(np.full(len(rows), m.n_tokens), pa.int64()),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(total),
                    pa.array(10.0 ** np.minimum(-total / sizes, 300.0)),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"],
            )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double, perplexity double"
    )
    return docs.mapInArrow(run, schema)
