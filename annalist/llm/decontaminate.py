"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a run of ``SEED`` tokens are joined on it. On such
a pair the longest common run of unmarked tokens is marked as a tile, again and again (running
Karp-Rabin finds runs of equal length; tiles never overlap), down to runs of ``SEED`` tokens. The share of
the item's tokens in tiles is its coverage, whatever order the tiles have, so a passage
that was cut and reordered counts as well.

The benchmark goes to the tasks in blocks of bounded size, one pass over the documents for each
block; the documents are never shuffled and a hot document is just a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.words import U64, byte_texts, few_rows, give_back, hash_words, ngrams, runs, ship, with_columns
from annalist.session import materialize

SEED = 5
COVERAGE = 0.8
#: tokens of the benchmark that one block holds (8 bytes each, times about four)
BLOCK = 4_000_000
_WORD = regex.compile(r"[\p{L}\p{N}]+")
_PLAIN = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(128)) + bytes(range(128, 256))


def tokens(text: bytes | None) -> list[bytes]:
    """Runs of letters and digits in lower case, so that case and punctuation do not matter."""
    if not text:
        return []
    if text.isascii():
        return text.lower().translate(_PLAIN).split()
    return [w.encode() for w in _WORD.findall(text.decode("utf-8", "replace").lower())]


def _common_runs(a: np.ndarray, b: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Places of equal runs of ``length`` unmarked tokens (0 is a mark), by their hashes."""
    if len(a) < length or len(b) < length:
        return []
    ha, hb = ngrams(a, length), ngrams(b, length)

    def free(x: np.ndarray) -> np.ndarray:
        marks = np.r_[0, np.cumsum(x == 0)]
        return np.flatnonzero(marks[length:] == marks[:-length])

    fa, fb = free(a), free(b)
    fb = fb[np.argsort(hb[fb], kind="stable")]
    lo, hi = np.searchsorted(hb[fb], ha[fa], "left"), np.searchsorted(hb[fb], ha[fa], "right")
    return [(int(i), int(j)) for i, x, y in zip(fa, lo, hi, strict=True) for j in fb[x:y]]


def tiles(item: np.ndarray, doc: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in document, length), longest first.

    Among equal lengths the first place in the item goes first, then the first in the document.
    """
    a, b = item.copy(), doc.copy()
    least = min(least, len(item))
    out: list[tuple[int, int, int]] = []
    if not least:
        return out
    top = len(a)
    while True:
        # the longest length with a common run: doubling is not needed, runs of n hold runs of n - 1
        low, high, found = least, top, []
        while low <= high:
            mid = (low + high) // 2
            if got := _common_runs(a, b, mid):
                low, found, length = mid + 1, got, mid
            else:
                high = mid - 1
        if not found:
            return out
        for i, j in found:
            if a[i : i + length].all() and b[j : j + length].all():
                a[i : i + length] = 0
                b[j : j + length] = 0
                out.append((i, j, length))
        top = length


class _Block:
    """A part of the benchmark: token hashes, and which items hold a seed."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = items
        seeds = [ngrams(x, SEED) for _, x in items]
        seed = np.concatenate([*seeds, np.empty(0, U64)])
        owner = np.repeat(np.arange(len(items)), [len(x) for x in seeds])
        order = np.argsort(seed, kind="stable")
        self.seed, self.owner = seed[order], owner[order]
        self.keys, (self.start, self.count) = np.unique(self.seed), runs(self.seed)
        self.short = sorted({len(x) for _, x in items if len(x) < SEED})

    def candidates(self, h: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Items with a seed in this document, and the distinct seeds found."""
        hits = [ngrams(h, n) for n in (SEED, *self.short) if len(h) >= n]
        if not hits or not len(self.keys):
            return []
        g = np.concatenate(hits)
        at = np.searchsorted(self.keys, g)
        at[at == len(self.keys)] = 0
        at = np.unique(at[self.keys[at] == g])
        if not len(at):
            return []
        n = self.count[at]
        entry = np.repeat(self.start[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        order = np.argsort(self.owner[entry], kind="stable")
        owner, keys = self.owner[entry][order], self.seed[entry][order]
        starts, lengths = runs(owner)
        return [(int(owner[s]), keys[s : s + k]) for s, k in zip(starts, lengths, strict=True)]


def _reachable(item: np.ndarray, seeds: np.ndarray) -> float:
    """Most of the item that tiles can cover: the tokens that lie in a shared seed."""
    least = min(SEED, len(item))
    place = np.flatnonzero(np.isin(ngrams(item, least), seeds))
    covered = np.zeros(len(item) + 1, np.int64)
    np.add.at(covered, place, 1)
    np.add.at(covered, place + least, -1)
    return float((np.cumsum(covered[:-1]) > 0).mean())


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The benchmark in blocks of at most BLOCK tokens, or one longer item."""
    block: list[tuple[int, np.ndarray]] = []
    size = 0
    for row in benchmark.toLocalIterator():  # a partition at a time
        h = np.maximum(hash_words(tokens(row["text"].encode())), U64(1))
        if len(h):
            if block and size + len(h) > BLOCK:
                yield block
                block, size = [], 0
            block.append((row["item_id"], h))
            size += len(h)
    if block:
        yield block


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (doc_id, item_id, n_item_tokens, n_tiles, covered, coverage) of contaminated documents.

    One row for every document row and benchmark item of which at least ``coverage`` of the tokens are
    tiled. Null or empty texts and items match nothing. An item shorter than a seed must be in the
    document whole. Repeated rows give repeated results; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = with_columns(docs, doc_id=id_column, text=text_column).filter("text is not null")
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    schema = "doc_id long, item_id long, n_item_tokens long, n_tiles long, covered long, coverage double"
    found = []
    for items in _blocks(with_columns(benchmark, item_id="item_id", text="text").filter("text is not null")):
        shared = spark.sparkContext.broadcast(items)  # at most BLOCK tokens, by construction

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = _Block(shared.value)
            for batch in few_rows(batches):
                rows = []
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True):
                    h = np.maximum(hash_words(tokens(text)), U64(1))
                    for k, seeds in block.candidates(h):
                        item_id, item = block.items[k]
                        if _reachable(item, seeds) >= coverage:
                            got = tiles(item, h)
                            n = sum(x[2] for x in got)
                            if n >= coverage * len(item):
                                rows.append((doc_id, item_id, len(item), len(got), n, n / len(item)))
                columns = list(zip(*rows, strict=True)) or [[]] * 6
                kinds = [pa.int64()] * 5 + [pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "n_item_tokens", "n_tiles", "covered", "coverage"],
                )
            give_back()

        found.append(materialize(docs.mapInArrow(run, schema), "contaminated"))
    if not found:
        return spark.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
