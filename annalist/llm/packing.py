"""Best-fit packing of token sequences by a configuration linear program.

Documents become token ids once, in the tasks; of each piece only its place, length and checksum
goes on. The histogram of piece lengths has at most ``capacity`` entries, whatever the corpus, so the plan is
made on the driver:

1. The linear program has a variable for every way to fill a sequence (a configuration). Multiplicative weights
   solve it: a length's price falls as its demand is covered, and a knapsack dynamic program
   over the capacity prices out the configuration that is worth most.
2. The solution is rounded down to whole sequences, and what is left over is packed by best fit
   decreasing, on the histogram again.

A piece finds its place from its length and its rank among the pieces of that length, by a
lookup in the plan, whose size depends on the capacity and not on the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.sharding import global_position
from annalist.llm.words import give_back, ship, with_columns
from annalist.session import materialize

#: distinct chunks a worker remembers; the memory of the cache, not a limit on the texts
CACHE_CHUNKS = 200_000
_UNSAFE = re.compile(r" (?:\s|\Z)")
#: fixed value: how byte-level BPE files of this kind split a text before merging
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of() -> dict[str, int]:
    """The printable character that byte-level vocabularies use for each byte, turned round."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(other)}


class Encoder:
    """Ids of a byte-level BPE file, with a memory of the ids of chunks between single spaces.

    Such chunks are encoded alone: no match of the pre-tokenizer runs over a single space
    that stands before a printed character. Other texts are encoded whole. The merges are done
    by tiktoken, several times as fast with the vocabulary of the file; a text that names
    a special token goes to the tokenizer that the file describes, which is kept from the first such text on.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        byte = _byte_of()
        ranks = {
            bytes(byte[c] for c in token): rank
            for token, rank in self.tokenizer.get_vocab(with_added_tokens=False).items()
            if token not in special
        }
        del self.tokenizer
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self.known: dict[str, bytes] = {}

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _learn(self, chunks: list[str]) -> None:
        """Encode chunks in one go and part the ids where the chunks end."""
        joined = " " + " ".join(chunks)
        ids = np.array(self.bpe.encode_ordinary(joined), "<u4")
        ends = np.cumsum([len(c.encode()) + 1 for c in chunks])
        cuts = 4 * np.searchsorted(np.cumsum(self.width[ids]), ends, "right")
        raw, first = ids.tobytes(), 0
        for chunk, cut in zip(chunks, cuts.tolist(), strict=True):
            self.known[chunk] = raw[first:cut]
            first = cut

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        if self.special and self.special.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        if _UNSAFE.search(text):
            return np.array(self.bpe.encode_ordinary(text), "<u4")
        first, *rest = text.split(" ")
        known = self.known
        if new := [c for c in set(rest) if c not in known]:
            if len(known) + len(new) > CACHE_CHUNKS:
                known.clear()
                new = list(set(rest))
            self._learn(new)
        head = np.array(self.bpe.encode_ordinary(first), "<u4").tobytes()
        return np.frombuffer(head + b"".join(map(known.__getitem__, rest)), "<u4")


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all full but the first."""
    head = n % capacity or capacity
    return [(0, head), *[(s, capacity) for s in range(head, n, capacity)]]


def _cut(batches: Iterator[pa.RecordBatch], encoder: Encoder, end: np.ndarray, capacity: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = np.concatenate([encoder.encode(text or ""), end])
            for k, (s, n) in enumerate(pieces_of(len(ids), capacity)):
                rows.append((doc_id, k, s, n, zlib.crc32(ids[s : s + n].tobytes())))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def tokenized_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        give_back()  # what reading the vocabulary took
        end = np.array([end_id], "<u4")
        yield from _cut(batches, encoder, end, capacity)
        del encoder
        give_back()

    return docs.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class _Knapsack:
    """The most valuable filling of every room up to the capacity, by dynamic programming over the lengths that are left.

    A length goes in as bundles of 1, 2, 4, ... pieces, so that no filling holds more pieces than there are.
    """

    def __init__(self, lengths: np.ndarray, rest: np.ndarray, price: np.ndarray, capacity: int) -> None:
        self.lengths, self.bundles = lengths, []
        for k, (n, left) in enumerate(zip(lengths.tolist(), rest.tolist(), strict=True)):
            left, size = min(left, capacity // n), 1
            while left > 0:
                self.bundles.append((k, min(size, left)))
                left, size = left - size, 2 * size
        value = np.zeros(capacity + 1)
        #: after each bundle, the last one that the filling of a room holds
        kind = np.int16 if len(self.bundles) < 1 << 15 else np.int32
        self.last = np.full((len(self.bundles) + 1, capacity + 1), -1, kind)
        for b, (k, m) in enumerate(self.bundles):
            weight = int(lengths[k]) * m
            other = value[: capacity + 1 - weight] + price[k] * m
            better = other > value[weight:] + 1e-9
            self.last[b + 1] = self.last[b]
            self.last[b + 1, weight:][better] = b
            value[weight:] = np.where(better, other, value[weight:])

    def filling(self, room: int) -> tuple[dict[int, int], int]:
        """Lengths and how often each, and what stays empty."""
        out: dict[int, int] = {}
        row = len(self.bundles)
        while (b := int(self.last[row, room])) >= 0:
            k, m = self.bundles[b]
            out[k] = out.get(k, 0) + m
            room, row = room - int(self.lengths[k]) * m, b
        return out, room


#: a configuration is taken for half of the sequences it could fill, so that others share its lengths
STEP = 0.5
#: shares of the tokens at which the state is kept, to hand over to best fit from
HAND_OVER = (0.8, 0.9, 0.95, 0.98, 0.99)
Plan = list[tuple[tuple[int, ...], int]]


def solve(histogram: dict[int, int], capacity: int) -> Plan:
    """Configurations (lengths in a sequence, longest first) and how many sequences each has.

    Rounds of pricing: a knapsack under weights, which fall as a length is covered, gives for every length that is left the best
    configuration with it. Those without waste are taken, in whole sequences. The rounds end when none is left without
    waste. What rounding leaves is packed by best fit, from the latest kept state that gives the fewest sequences.
    """
    plan: Plan = [((capacity,), histogram[capacity])] if histogram.get(capacity) else []
    lengths = np.array(sorted(n for n, k in histogram.items() if k and n < capacity), np.int64)
    demand = np.array([histogram[int(n)] for n in lengths], np.int64)
    rest, total = demand.copy(), int((lengths * demand).sum())
    states, ahead = [(len(plan), demand)], list(HAND_OVER)
    while (rest > 0).any() and _round(lengths, demand, rest, capacity, plan):
        share = 1 - int((lengths * rest).sum()) / total
        if ahead and share >= ahead[0]:
            states.append((len(plan), rest.copy()))
            ahead = [s for s in ahead if s > share]
    states.append((len(plan), rest))
    bound = -(-sum(n * k for n, k in histogram.items()) // capacity)
    best: tuple[int, Plan] | None = None
    for n, left in reversed(states):
        whole = plan[:n] + best_fit(dict(zip(lengths.tolist(), left.tolist(), strict=True)), capacity)
        used = sum(copies for _, copies in whole)
        if best is None or used < best[0]:
            best = used, whole
        if used == bound:
            break
    return best[1]


def _round(lengths: np.ndarray, demand: np.ndarray, rest: np.ndarray, capacity: int, plan: Plan) -> int:
    """One pricing round; takes pieces out of ``rest`` and gives the number of sequences."""
    alive = np.flatnonzero(rest > 0)
    some = lengths[alive]
    # a token is worth a token; among equal fillings the less covered and the longer ones count
    weight = np.exp(rest[alive] / demand[alive] - 1) * (some / capacity) ** 1.5
    knapsack, placed = _Knapsack(some, rest[alive], some + 0.9 * weight, capacity), 0
    for i in range(len(some) - 1, -1, -1):
        if rest[alive[i]] <= 0:
            continue
        config, waste = knapsack.filling(capacity - int(some[i]))
        if waste:
            continue
        config[i] = config.get(i, 0) + 1
        at, count = alive[list(config)], np.array(list(config.values()))
        most = int((rest[at] // count).min())
        if most:
            copies = max(1, int(most * STEP))
            rest[at] -= copies * count
            placed += copies
            plan.append((tuple(sorted((int(n) for n, c in zip(lengths[at], count, strict=True) for _ in range(c)), reverse=True)), copies))
    return placed


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit decreasing, many equal sequences at a time."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    for n in sorted(histogram, reverse=True):
        k = histogram[n]
        while k:
            room = min((r for r in open_ if r >= n), default=None)
            if room is None:
                full = capacity // n
                put, config = (k // full, (n,) * full) if k >= full else (1, (n,) * k)
                k -= put * len(config)
                room = capacity - n * len(config)
            else:
                config, there = next(iter(open_[room].items()))
                put = min(k, there)
                if put == there:
                    del open_[room][config]
                else:
                    open_[room][config] = there - put
                if not open_[room]:
                    del open_[room]
                k -= put
                config, room = (*config, n), room - n
            group = open_.setdefault(room, {})
            group[config] = group.get(config, 0) + put
    return [(c, k) for group in open_.values() for c, k in group.items()]


@dataclass
class Places:
    """The plan as a lookup: ranks of a length in [first, next first) go to sequence + (rank - first)."""

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


_RANK = 40


def places(plan: list[tuple[tuple[int, ...], int]]) -> Places:
    used: dict[int, int] = {}
    rows, base = [], 0
    for config, copies in plan:
        offset = 0
        for n in config:
            rank = used.get(n, 0)
            rows.append(((n << _RANK) + rank, base, offset))
            used[n] = rank + copies
            offset += n
        base += copies
    rows.sort()
    got = np.array(rows, np.int64).reshape(-1, 3)
    return Places(got[:, 0], got[:, 1], got[:, 2])


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset), one per piece.

    A document is its ids and ``end_id``; null and empty texts are the end alone. One longer than
    ``capacity`` is cut into full pieces, the first of which may be shorter. Sequence ids
    count from 0, offsets are gapless from 0. Repeated rows are packed each; an empty table
    gives an empty table; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = with_columns(docs, doc_id=id_column, text=text_column)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    cut = materialize(tokenized_pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = cut.groupBy("length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.collect()}  # at most ``capacity`` rows
    ordered = global_position(cut, ["length", "doc_id", "piece", "ids_crc32"], "position")
    lengths = np.array(sorted(histogram), np.int64)
    before = np.r_[0, np.cumsum([histogram[int(n)] for n in lengths])].astype(np.int64)
    shared = spark.sparkContext.broadcast((lengths, before, places(solve(histogram, capacity))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, before, plan = shared.value
        for batch in batches:
            n, position = batch.column("length").to_numpy(), batch.column("position").to_numpy()
            rank = position - before[np.searchsorted(lengths, n)]
            at = np.searchsorted(plan.key, (n << _RANK) + rank, "right") - 1
            sequence = plan.sequence[at] + rank - (plan.key[at] - (n << _RANK))
            columns = [batch.column(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(plan.offset[at])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ordered.mapInArrow(run, schema)
