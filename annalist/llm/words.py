"""Words, n-grams and packed columns, shared by the operators.

Inside a task whole Arrow batches become numpy arrays; Spark splits the work and moves
the rows. A packed blob is one binary value that holds many fixed-width entries, so that
millions of small entries cross a shuffle as a few rows.
"""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.session import materialize, shared_dir

U64 = np.uint64
#: distinct words a worker remembers; the memory of the cache, not a limit on the texts
CACHE_WORDS = 100_000
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / "annalist_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    shared_dir(spark)
    _SHIPPED.add(app)


def give_back() -> None:
    """Return the memory that a task has freed to the system, so that an idle worker does not hold it.

    Spark keeps workers for the next stage, beside the ones that work; what the C library can't return stays. Arrow's
    memory is a pool of its own, and the next task may fill the cache of hashes again.
    """
    _HASHES.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class _Hashes(dict):
    """Word to 64-bit hash, the same on every machine."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    return column.cast(pa.large_binary()).to_pylist()


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; none for null."""
    return text.lower().split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), U64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words, in text order; of the whole sequence if it is shorter."""
    if not len(h):
        return h
    k = min(k, len(h))
    out = np.full(len(h) - k + 1, k, U64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out * U64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return out


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct k-word shingles of a whole text."""
    return np.unique(ngrams(hash_words(words_of(text)), k))


def with_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Keep only the named columns, under the operator's names and types."""
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in columns.items()])


def few_rows(batches: Iterable[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a task turns few texts into Python values at once."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def split_by(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each part with the positions of its entries, in their order."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for idx in np.split(order, cuts):
        if len(idx):
            yield int(part[idx[0]]), idx


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal keys."""
    if not len(sorted_keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]])
    return starts, np.diff(np.r_[starts, len(sorted_keys)])


def batched(items: Iterable, schema: pa.Schema, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches."""
    got: list[tuple] = []
    for item in items:
        got.append(item)
        if len(got) >= rows:
            yield _batch(got, schema)
            got = []
    if got:
        yield _batch(got, schema)


def _batch(got: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), schema, strict=True)], schema=schema
    )


def partitions_for(spark: SparkSession, entries: int, per_partition: int = 2_000_000) -> int:
    """Number of parts for packed entries: in proportion to them, a power of two."""
    need = max(int(spark.conf.get("spark.sql.shuffle.partitions")), entries // per_partition + 1)
    return 1 << (need - 1).bit_length()


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """The part of a hash by its top bits, so that parts are ranges of hashes."""
    bits = parts.bit_length() - 1
    return (h >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)


#: bits of the filter that goes to all tasks: 8 MB, however many ids it holds
FILTER_BITS = 26


class Likely:
    """A bitmap of fixed size that says of an id whether it may be in ``ids``: yes for all that are, and few others.

    It is put together in blocks by the tasks and goes to all of them. The more ids it holds the less it
    tells. Null ids are not in it.
    """

    _BLOCK_BITS = 15

    def __init__(self, ids: DataFrame) -> None:
        width = self._BLOCK_BITS

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.unique(_place(batch.column(0)))
                got = [(b, (at[i] & ((1 << width) - 1)).astype("<u2").tobytes()) for b, i in split_by(at >> width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.binary())], ["block", "bits"]
                )

        def unite(table: pa.Table) -> pa.Table:
            at = np.unique(np.concatenate([np.frombuffer(x, "<u2") for x in table.column("bits").to_pylist()]))
            flags = np.zeros(1 << width, np.uint8)
            flags[at] = 1
            return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

        schema = "block int, bits binary"
        blocks = ids.select("doc_id").mapInArrow(pack, schema).groupBy("block").applyInArrow(unite, schema)
        bitmap = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
        size = (1 << width) // 8
        for row in blocks.collect():  # 8 MB at most
            bitmap[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
        self._shared = ids.sparkSession.sparkContext.broadcast(bitmap)

    def has(self, column: pa.Array) -> np.ndarray:
        """Which of a column's ids may be among them; for use in tasks."""
        bits, at = self._shared.value, _place(column)
        return ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1) & column.is_valid().to_numpy(False)


def _place(column: pa.Array) -> np.ndarray:
    known = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return (mix(known.view(U64)) >> U64(64 - FILTER_BITS)).astype(np.int64)


def split_likely(docs: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose doc_id may be in ``ids`` (all that are, and few others), and the rest.

    This spares the rest the shuffle of the exact join that follows. Null ids belong to the rest.
    """
    likely = Likely(ids)

    def part(wanted: bool) -> DataFrame:
        def keep(ids: pa.Array) -> pa.Array:
            return pa.array(likely.has(ids) == wanted)

        # only the ids go to Python; deterministic, it would be put to the other side of a join on them as well
        return docs.filter(F.arrow_udf(keep, "boolean").asNondeterministic()("doc_id"))

    return part(True), part(False)


def keep_likely(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return split_likely(docs, ids)[0]


def without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is in ``ids``; only likely ones are shuffled."""
    ids = materialize(ids.select("doc_id").distinct(), "ids")
    likely, rest = split_likely(docs, ids)
    return rest.unionByName(likely.join(ids, "doc_id", "left_anti").select(*docs.columns))
