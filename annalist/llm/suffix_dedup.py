"""Passages that several documents share, by sparse suffix arrays.

Suffixes are kept at minimiser positions only: the least hash among every ``WINDOW`` neighbouring runs of
``RUN`` words. The choice depends on the words alone, so both copies of a passage of ``LEAST`` words
keep a suffix at the same place. Two such suffixes match over r words to the right and l words to the left;
r + l >= 50 means that r >= 25, or l >= 25 and r >= 10. So there are two sorted arrays of keys, one of
what follows and one of what precedes, and only suffixes whose 25 words there occur in several documents go on.

Each of these is sorted once for every split of 50 words into what precedes and what follows, as far as it is the
minimiser of those 50 words: entries (hash of the 50 words, document). Equal entries meet whatever lies around
them, so every 50 words that two documents share are found; a longer passage is the union of its splits.

What a document shares with one of a smaller id is removed, so the first copy of each passage stays.
The splits of a key that very many suffixes have are not gathered: tasks add up the smallest and largest document
of each, which are written to sorted files, and every suffix looks its own splits up. Both ways find the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.shards import map_arrays, write_arrays
from annalist.llm.words import (
    U64,
    byte_texts,
    few_rows,
    give_back,
    hash_words,
    keep_likely,
    mix,
    part_of,
    partitions_for,
    runs,
    ship,
    split_by,
    split_likely,
    with_columns,
    words_of,
)
from annalist.session import materialize, new_path

LEAST, RUN, HALF = 50, 10, 25
WINDOW = LEAST - RUN + 1
#: suffixes with one key that are gathered in one task; those of a commoner key are looked up
CHUNK = 4096
#: splits that a task packs, adds up or looks up at a time
SPLITS = 1_000_000
#: splits of a suffix in the mean, to choose the number of parts
_MEAN = LEAST // 4
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = regex.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


class Rolling:
    """Hashes of any run of words of one text."""

    def __init__(self, h: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.r_[U64(0), np.cumsum(h * _powers(_BASE, len(h)), dtype=U64)]
            self.back = _powers(_INVERSE, len(h) + 1)

    def __call__(self, start: np.ndarray, n: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[start + n] - self.sums[start]) * self.back[start] + U64(n))


def minimisers(h: np.ndarray, rolling: Rolling) -> np.ndarray:
    """Kept positions: every LEAST words in a row hold one, chosen by the words alone."""
    if len(h) < LEAST:
        return np.empty(0, np.int64)
    g = rolling(np.arange(len(h) - RUN + 1), RUN)
    view = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    return np.unique(np.arange(len(view)) + view.argmin(1))


def _keys(h: np.ndarray) -> np.ndarray:
    """Keys of every kept suffix: of what follows and of what precedes."""
    rolling = Rolling(h)
    p = minimisers(h, rolling)
    right, left = p[p + HALF <= len(h)], p[p >= HALF]
    return np.r_[rolling(right, HALF), mix(rolling(left - HALF, HALF + RUN) + U64(1))]


def _scan(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, sig, packed): packed keys of the suffixes of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            n, sig, packed = [], [], []
            for text in byte_texts(batch.column("text")):
                h = hash_words(words_of(text))
                n.append(len(h))
                sig.append(xxhash.xxh3_128_digest(h.tobytes()))
                if len(h) < LEAST:
                    packed.append(b"")
                    continue
                packed.append(_keys(h).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.array(packed, pa.binary())],
                ["doc_id", "n", "sig", "packed"],
            )
        batch = text = h = n = sig = packed = None
        give_back()

    return docs.mapInArrow(run, "doc_id long, n long, sig binary, packed binary")


def _shared_keys(reps: DataFrame, parts: int) -> DataFrame:
    """Rows (doc_id, key, m): suffixes whose key occurs in several documents, m times."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column("packed").to_pylist()
            counts = [len(x) // 8 for x in packed]
            if not sum(counts):
                continue
            key = np.concatenate([np.frombuffer(x, U64, c) for x, c in zip(packed, counts, strict=True)])
            doc = np.repeat(batch.column("doc_id").to_numpy(), counts)
            yield _blobs((p, key[i].tobytes() + doc[i].tobytes()) for p, i in split_by(part_of(key, parts)))

    def meet(table: pa.Table) -> pa.Table:
        blobs = [(x, len(x) // 16) for x in table.column("packed").to_pylist()]
        key = np.concatenate([np.frombuffer(x, U64, c) for x, c in blobs])
        doc = np.concatenate([np.frombuffer(x, np.int64, c, 8 * c) for x, c in blobs])
        order = np.lexsort((doc, key))
        key, doc = key[order], doc[order]
        starts, lengths = runs(key)
        several = doc[starts] != doc[starts + lengths - 1]
        keep, m = np.repeat(several, lengths), np.repeat(lengths, lengths)
        doc, key, m = doc[keep], key[keep].view(np.int64), m[keep]
        del blobs, order, starts, lengths, several, keep
        give_back()
        return pa.table({"doc_id": doc, "key": key, "m": m})

    scattered = reps.mapInArrow(scatter, "part int, packed binary")
    return scattered.groupBy("part").applyInArrow(meet, "doc_id long, key long, m long")


def _blobs(got: Iterable[tuple[int, bytes]]) -> pa.RecordBatch:
    got = list(got)
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.binary())], ["part", "packed"]
    )


def _splits(h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Suffixes of a text whose key is among the sorted ``known``: index of the key, start of the first split and
    number of splits of each; and the hashes of all their splits.

    Each 50 words belong to their own minimiser, under the key of the side that holds 25 of them.
    """
    if len(h) < LEAST:
        return None
    rolling = Rolling(h)
    g = rolling(np.arange(len(h) - RUN + 1), RUN)
    view = np.lib.stride_tricks.sliding_window_view(g, WINDOW)
    behind = view.argmin(1)
    start = np.arange(len(view))
    first, n = runs((start + behind) * 2 + (behind > LEAST - HALF))
    place = first + behind[first]
    key = np.where(
        behind[first] > LEAST - HALF,
        mix(rolling(np.maximum(place - HALF, 0), HALF + RUN) + U64(1)),
        rolling(np.minimum(place, len(h) - HALF), HALF),
    )
    at = np.searchsorted(known, key)
    at[at == len(known)] = 0
    hit = known[at] == key
    first, n, at = first[hit], n[hit], at[hit]
    return at, first, n, rolling(_steps(first, n), LEAST)


def _steps(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each row, n numbers each."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _unpack(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, first start and number of splits of the packed suffixes, and the hashes of the splits."""
    out = []
    for x in blobs:
        r = int(np.frombuffer(x, "<u4", 1)[0])
        k = (len(x) - 4 - 13 * r) // 8
        out.append(
            (
                np.frombuffer(x, np.int64, r, 4),
                np.frombuffer(x, "<i4", r, 4 + 8 * r),
                np.frombuffer(x, np.uint8, r, 4 + 12 * r),
                np.frombuffer(x, U64, k, 4 + 13 * r),
            )
        )
    doc, first, n, split = (np.concatenate([o[k] for o in out]) for k in range(4))
    return doc, first.astype(np.int64), n.astype(np.int64), split


def _packed_splits(chosen: DataFrame, parts: int) -> DataFrame:
    """Rows (hot, part, packed) of rows (doc_id, text, chosen array<struct<key, m>>), parts by ranges of the key
    where suffixes are gathered."""

    def pack(got: list[tuple]) -> Iterator[pa.RecordBatch]:
        key, m, doc, first, n, split = (np.concatenate([g[k] for g in got]) for k in range(6))
        ends = np.cumsum(n)
        for hot in (False, True):
            mine = np.flatnonzero((m > CHUNK) == hot)
            if not len(mine):
                continue
            blobs = _blobs(
                (
                    p,
                    np.array([len(i)], "<u4").tobytes()
                    + doc[i].tobytes()
                    + first[i].astype("<i4").tobytes()
                    + n[i].astype(np.uint8).tobytes()
                    + split[_steps(ends[i] - n[i], n[i])].tobytes(),
                )
                # looked up, no key needs to meet others: suffixes stay in the order of their text
                for p, i in ([(0, mine)] if hot else [(p, mine[j]) for p, j in split_by(part_of(key[mine], parts))])
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(blobs), hot)), *blobs.columns], ["hot", "part", "packed"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, size = [], 0
        for batch in batches:
            lists = batch.column("chosen")
            cuts = lists.offsets.to_numpy()
            keys = lists.values.field("key").to_numpy().view(U64)
            often = lists.values.field("m").to_numpy()
            for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True)):
                known, where = np.unique(keys[cuts[i] : cuts[i + 1]], return_index=True)
                found = _splits(hash_words(words_of(text)), known)
                if found is None or not len(found[0]):
                    continue
                at, first, n, split = found
                m = often[cuts[i] : cuts[i + 1]][where]
                got.append((known[at], m[at], np.full(len(at), doc_id, np.int64), first, n, split))
                size += len(split)
                if size >= SPLITS:
                    yield from pack(got)
                    got, size = [], 0
        if got:
            yield from pack(got)
        batch = text = got = None
        give_back()

    return chosen.mapInArrow(run, "hot boolean, part int, packed binary")


_SPANS = "doc_id long, start long, stop long, first_doc_id long, removed long"


def _spans(doc: np.ndarray, first: np.ndarray, n: np.ndarray, least: np.ndarray, most: np.ndarray) -> pa.Table:
    """Passages of suffixes whose splits occur in documents from ``least`` to ``most``; those of suffixes that
    follow each other are one."""
    row = np.repeat(np.arange(len(n)), n)
    start, own = _steps(first, n), doc[row]
    out = []
    for removed, flag in ((1, least < own), (0, most > own)):
        i = np.flatnonzero(flag)
        if not len(i):
            continue
        begins = np.flatnonzero(np.r_[True, (np.diff(start[i]) != 1) | (np.diff(own[i]) != 0)])
        ends = np.r_[begins[1:], len(i)] - 1
        keeper = np.minimum.reduceat(least[i], begins) if removed else own[i[begins]]
        out.append((own[i[begins]], start[i[begins]], start[i[ends]] + LEAST, keeper, np.full(len(begins), removed)))
    names = [f.split()[0] for f in _SPANS.split(", ")]
    columns = [np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k in range(len(names))]
    return pa.table([pa.array(c.astype(np.int64)) for c in columns], names)


def _extremes(split: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct splits with their smallest and largest document, and the index of each entry among them."""
    kinds, at = np.unique(split, return_inverse=True)
    order = np.argsort(at, kind="stable")
    starts, _ = runs(at[order])
    return kinds, np.minimum.reduceat(least[order], starts), np.maximum.reduceat(most[order], starts), at


def _gathered(packed: DataFrame) -> DataFrame:
    """Spans of suffixes with a key that at most CHUNK suffixes have."""

    def meet(table: pa.Table) -> pa.Table:
        doc, first, n, split = _unpack(table.column("packed").to_pylist())
        own = np.repeat(doc, n)
        _, least, most, at = _extremes(split, own, own)
        found = _spans(doc, first, n, least[at], most[at])
        del doc, first, n, split, own, least, most, at
        give_back()
        return found

    return packed.select("part", "packed").groupBy("part").applyInArrow(meet, _SPANS)


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Unpacked blobs, about SPLITS splits at a time."""
    got, size = [], 0
    for batch in batches:
        for x in batch.column("packed").to_pylist():
            got.append(x)
            size += len(x) // 8
            if size >= SPLITS:
                yield _unpack(got)
                got, size = [], 0
    if got:
        yield _unpack(got)


def _looked_up(packed: DataFrame, parts: int) -> DataFrame:
    """Spans of suffixes with a commoner key; no task holds them all."""
    spark = packed.sparkSession
    folder = new_path(spark, "splits")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, _, n, split in _several(batches):
            own = np.repeat(doc, n)
            kinds, least, most, _ = _extremes(split, own, own)
            yield _blobs(
                (p, kinds[i].tobytes() + least[i].tobytes() + most[i].tobytes()) for p, i in split_by(part_of(kinds, parts))
            )

    def write(table: pa.Table) -> pa.Table:
        blobs = [(x, len(x) // 24) for x in table.column("packed").to_pylist()]
        split, least, most = (
            np.concatenate([np.frombuffer(x, kind, c, 8 * c * k) for x, c in blobs])
            for k, kind in enumerate((U64, np.int64, np.int64))
        )
        kinds, least, most, _ = _extremes(split, least, most)
        held = least < most
        part = table.column("part")[0].as_py()
        file = write_arrays(folder, f"splits-{part}", [kinds[held], least[held], most[held]])
        return pa.table({"part": pa.array([part], pa.int32()), "file": [file], "n": pa.array([int(held.sum())], pa.int64())})

    added = packed.mapInArrow(add, "part int, packed binary").groupBy("part").applyInArrow(write, "part int, file string, n long")
    # one short row per file
    files = spark.sparkContext.broadcast({r["part"]: (r["file"], r["n"]) for r in materialize(added, "files").collect()})

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, first, n, split in _several(batches):
            own = np.repeat(doc, n)
            kinds, at = np.unique(split, return_inverse=True)
            place = np.full(len(kinds), -1)
            low, high, seen = [], [], 0
            for part, i in split_by(part_of(kinds, parts)):
                file, size = files.value[part]
                known, least, most = map_arrays(file, [("<u8", size), ("<i8", size), ("<i8", size)])
                where = np.searchsorted(known, kinds[i])
                where[where == size] = 0
                hit = known[where] == kinds[i] if size else np.zeros(len(i), bool)
                place[i[hit]] = seen + np.arange(hit.sum())
                low.append(least[where[hit]])
                high.append(most[where[hit]])
                seen += int(hit.sum())
            place = place[at]
            low, high = np.r_[np.concatenate(low), 0], np.r_[np.concatenate(high), 0]
            shared = place >= 0
            yield from _spans(doc, first, n, np.where(shared, low[place], own), np.where(shared, high[place], own)).to_batches()

    return packed.mapInArrow(find, _SPANS)


def _merged(spans: DataFrame) -> DataFrame:
    """Overlapping spans of a document become one; at most its words of rows per document."""
    one = spans.groupBy("doc_id", "removed", "start").agg(F.max("stop").alias("stop"), F.min("first_doc_id").alias("first_doc_id"))
    by_start = Window.partitionBy("doc_id", "removed").orderBy("start")
    before = F.max("stop").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    grouped = one.withColumn("begins", begins).withColumn("g", F.sum("begins").over(by_start))
    return grouped.groupBy("doc_id", "removed", "g").agg(
        F.min("start").alias("start_word"), F.max("stop").alias("stop_word"), F.min("first_doc_id").alias("first_doc_id")
    )


def shared_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, start_word, stop_word, n_words, first_doc_id, removed): passages of documents that
    other documents have too, of at least 50 words.

    ``removed`` is true where a document of a smaller id holds the passage; a passage that stays has a
    row as well. ``first_doc_id`` is the smallest document the passage was matched with. Words are
    ``[^\\x20\\x09-\\x0D]+`` in lower case. Documents that share nothing, null, empty and short texts and null ids
    have no rows. Rows that repeat a doc_id count as one document, and one with several texts has those spans of each.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = with_columns(docs, doc_id=id_column, text=text_column)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long")).filter("doc_id is not null and text is not null")
    scanned = materialize(_scan(docs).filter(F.col("n") >= LEAST), "suffixes")
    # equal texts are one text in the arrays
    classes = scanned.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.max("n").alias("n"))
    reps = scanned.groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.first("packed").alias("packed"))
    total = scanned.agg((F.sum(F.length("packed")) / 8).cast("long")).first()[0] or 0
    keys = _shared_keys(reps.select("doc_id", "packed"), partitions_for(spark, total))
    keys = materialize(keys, "keys")
    shared, hot = keys.agg(F.count("*"), F.count(F.when(F.col("m") > CHUNK, 1))).first()
    chosen = keys.groupBy("doc_id").agg(F.collect_list(F.struct("key", "m")).alias("chosen"))
    parts = partitions_for(spark, shared * _MEAN)
    packed = materialize(_packed_splits(keep_likely(docs, chosen).join(chosen, "doc_id"), parts), "splits")
    found = _gathered(packed.filter("not hot"))
    if hot:
        found = found.unionByName(_looked_up(packed.filter("hot"), partitions_for(spark, hot * _MEAN)))
    copied = classes.filter("rep != last")
    copies = (
        scanned.select("doc_id", "sig")
        .join(copied, "sig")
        .select(
            "doc_id",
            F.lit(0).cast("long").alias("start"),
            F.col("n").alias("stop"),
            F.col("rep").alias("first_doc_id"),
            (F.col("doc_id") != F.col("rep")).cast("long").alias("removed"),
        )
    )
    spans = materialize(_merged(found.unionByName(copies)), "spans")
    gone = spans.filter("removed = 1").select("doc_id", F.col("start_word").alias("s"), F.col("stop_word").alias("e"))
    stays = spans.filter("removed = 0").join(gone, "doc_id", "left").groupBy("doc_id", "removed", "g").agg(
        F.first("start_word").alias("start_word"),
        F.first("stop_word").alias("stop_word"),
        F.first("first_doc_id").alias("first_doc_id"),
        F.max(F.coalesce((F.col("s") <= F.col("start_word")) & (F.col("e") >= F.col("stop_word")), F.lit(False))).alias("within"),
    )
    return spans.filter("removed = 1").unionByName(stays.filter("not within").drop("within")).select(
        "doc_id",
        "start_word",
        "stop_word",
        (F.col("stop_word") - F.col("start_word")).alias("n_words"),
        "first_doc_id",
        (F.col("removed") == 1).alias("removed"),
    )


def without_passages(docs: DataFrame, passages: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with removed passages cut out of their texts; one whose words all go is dropped.

    All other columns stay as they are.
    """
    spans = passages.filter("removed").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start_word", "stop_word"))).alias("__spans")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            texts = []
            at = batch.schema.get_field_index(text_column)
            for text, spans in zip(byte_texts(batch.column(at)), batch.column("__spans").to_pylist(), strict=True):
                if spans and text is not None:
                    words = [m.span() for m in _WORD.finditer(text)]
                    ends = [e for _, e in words]
                    out, done = [], 0
                    for s in spans:
                        if s["start_word"] < len(words):
                            out.append(text[done : words[s["start_word"]][0]])
                            done = ends[min(s["stop_word"], len(words)) - 1]
                    text = b"".join([*out, text[done:]]).decode()
                    texts.append(text if text.strip(" \t\n\v\f\r") else None)
                else:
                    texts.append(None if text is None else text.decode())
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema.set(at, pa.field(text_column, pa.string())))
        batch = texts = text = words = ends = out = columns = None
        give_back()

    spans = materialize(spans, "cuts")
    likely, rest = split_likely(docs, spans)
    touched = likely.join(spans, "doc_id", "left")
    changed = touched.mapInArrow(cut, touched.schema)
    stays = F.col(text_column).isNotNull() | F.col("__spans").isNull()
    return rest.unionByName(changed.filter(stays).select(*docs.columns))
