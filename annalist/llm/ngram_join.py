"""N-gram Jaccard join as a blocked sparse matrix product.

Rows of the incidence matrix are the distinct n-gram sets, columns are n-grams.

1. Equal sets become one row of the matrix.
2. The columns are cut into as many blocks as a linked pair may have differing n-grams, and a few
   more, so that a linked pair is equal in at least one block (pigeonhole; sizes decide the number of
   blocks). Rows that are equal in a block meet; sets of up to ``SMALL`` n-grams meet in one of
   their first n-grams in hash order instead.
3. Of those that meet, sets whose parity sketches differ in more places than linked sets may have differing
   n-grams are told apart: each such place holds at least one n-gram of one set alone, so no link is lost.
   Who is left together, directly or through others, is a cluster. Without this step common n-grams
   chain unlike texts to one cluster that grows with the corpus.
4. Each cluster is ordered by size and cut into tiles of bounded weight. Only pairs of tiles whose
   sizes can reach the threshold are multiplied: overlap counts are accumulated over the rare
   columns first, pairs below the bound their sizes set are discarded, then the frequent columns are
   added for the rest. A tile gives back degrees and a spanning forest, never all pairs. The sets lie in
   files of the shared folder, written once; a tile reads its own, so that no shuffle copies them.

Nothing is dropped or capped. In the worst case, many different sets of one size in one cluster, the
number of tiles is quadratic in their number; their output stays linear.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.components import connected_components
from annalist.llm.shards import Writer, read_ranges
from annalist.llm.words import (
    U64,
    Likely,
    batched,
    byte_texts,
    few_rows,
    give_back,
    mix,
    part_of,
    partitions_for,
    runs,
    ship,
    shingle_set,
    split_by,
    with_columns,
)
from annalist.session import materialize, new_path

SMALL = 32
RATIO = 1.6
#: n-grams (or 200 for a smaller set) that one tile holds of each side
TILE = 200_000
LIGHT = 64
#: sets that meet in one key and are compared by their sketches at once; more of them are one cluster as they are
GROUP = 8192
#: bits of a parity sketch, a power of two by the size of its set
SKETCH_BITS = (64, 16_384)


def _levels(n: int) -> list[tuple[int, int]]:
    """Size ranges [a, b) up to n: level i is out[i - 1]."""
    out, a = [], SMALL + 1
    while a <= n or not out:
        b = math.ceil(a * RATIO)
        out.append((a, b))
        a = b
    return out


class Threshold:
    """Jaccard of at least num/den, in integers."""

    def __init__(self, num: int, den: int):
        if not 0 < 2 * num and num <= den:
            raise ValueError("the threshold lies in (0, 1]")
        self.num, self.den = num, den

    def needed(self, a, b):
        """Least overlap of linked sets of a and b n-grams."""
        return -(-self.num * (a + b) // (self.num + self.den))

    def differing(self, a: int, b: int) -> int:
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def largest(self, n: int) -> int:
        return n * self.den // self.num

    def blocks(self, a: int, b: int) -> int:
        q = self.differing(b - 1, b - 1) + 1
        return q + 1 + round(2 * q * math.exp(-1.25 * a / q))

    def keys(self, s: np.ndarray) -> np.ndarray:
        """Where this sorted set can meet the sets it is linked with."""
        n = len(s)
        if not n:
            return s
        out, top = [], self.largest(n)
        if n <= SMALL:
            out.append(mix(s[: n - -(-self.num * n // self.den) + 1]))
        for level, (a, b) in enumerate(_levels(top), 1):
            if n < b and top >= a:  # a set that is not smaller may lie in this range
                out.append(self._blocks_of(s, level, a, b))
        return np.concatenate(out)

    def _blocks_of(self, s: np.ndarray, level: int, a: int, b: int) -> np.ndarray:
        q, n = self.blocks(a, b), len(s)
        block = ((s >> U64(32)) * U64(q)) >> U64(32)
        starts, _ = runs(block)
        block = block[starts]
        with np.errstate(over="ignore"):
            place = U64(level << 32) + block
            found = mix(np.add.reduceat(mix(s ^ U64(0x5851F42D4C957F2D)), starts) + mix(place))
        if q - self.differing(n, min(self.largest(n), b - 1)) > q - len(block):
            return found
        # so many blocks are empty that a linked set might be equal in those alone
        empty = np.setdiff1d(np.arange(q, dtype=U64), block)
        return np.concatenate([found, mix(U64(level << 32) + empty)])


def _signature(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a, b = mix(s).sum(dtype=U64), mix(s ^ U64(0xD1B54A32D192ED03)).sum(dtype=U64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def parity_sketch(s: np.ndarray) -> np.ndarray:
    """Whether each bucket of hashes holds an odd number of the set's n-grams, as bits of 64-bit words.

    Two sets have at least as many n-grams that only one of them has as their sketches have differing bits.
    """
    bits = min(max(1 << (3 * len(s) // 2).bit_length(), SKETCH_BITS[0]), SKETCH_BITS[1])
    odd = np.bincount((s & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(U64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same set in fewer words."""
    while len(sketch) > words:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def _signatures(docs: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, n, s1, s2, sketch): size, signature and parity sketch of each row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            n, sigs, sketches = [], [], []
            for text in byte_texts(batch.column("text")):
                s = shingle_set(text, k)
                n.append(len(s))
                sigs.append(_signature(s))
                sketches.append(parity_sketch(s).tobytes())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64())]
            columns += [pa.array([x[i] for x in sigs], pa.int64()) for i in (0, 1)]
            columns.append(pa.array(sketches, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "s1", "s2", "sketch"])
        batch = text = s = columns = n = sigs = sketches = None
        give_back()

    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, sketch binary")


_STORED = pa.schema(
    [*[(c, pa.int64()) for c in ("doc_id", "n", "s1", "s2")], ("file", pa.string()), ("place", pa.int64())]
)


def _stored_sets(docs: DataFrame, k: int, likely: Likely, folder: str) -> DataFrame:
    """Rows (doc_id, n, s1, s2, file, place): the sets themselves lie in files of the shared folder, one per task.

    They are written once and read where a tile needs them, so that no shuffle copies them. A repeated task writes
    a file of its own, and its rows name that one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Writer(folder)

        def rows() -> Iterator[tuple]:
            for batch in few_rows(batches):
                batch = batch.filter(pa.array(likely.has(batch.column("doc_id"))))
                for doc, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True):
                    s = shingle_set(text, k)
                    if len(s):
                        yield doc, len(s), *_signature(s), out.name, out.add(s)

        try:
            yield from batched(rows(), _STORED)
        finally:
            out.close()
        give_back()

    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, file string, place long")


def _meetings(docs: DataFrame, k: int, limit: Threshold, likely: Likely, parts: int) -> DataFrame:
    """Rows (meeting, doc_id, large): who has a key in common, of likely documents.

    Keys with the same documents are one meeting. A large one, of more than ``GROUP`` documents, is named by its smallest.
    """
    most = GROUP

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = keys = rep = key = got = None
        for batch in few_rows(batches):
            batch = batch.filter(pa.array(likely.has(batch.column("doc_id"))))
            keys = [limit.keys(shingle_set(text, k)) for text in byte_texts(batch.column("text"))]
            if not keys:
                continue
            rep = np.repeat(batch.column("doc_id").to_numpy(), [len(x) for x in keys])
            key = np.concatenate(keys)
            got = [(p, key[i].tobytes() + rep[i].tobytes()) for p, i in split_by(part_of(key, parts))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in got], pa.int32()), pa.array([x[1] for x in got], pa.binary())], ["part", "packed"]
            )
        batch = keys = rep = key = got = None
        give_back()

    def meet(table: pa.Table) -> pa.Table:
        both = [np.frombuffer(x, np.int64) for x in table.column("packed").to_pylist()]
        key = np.concatenate([x[: len(x) // 2] for x in both])
        rep = np.concatenate([x[len(x) // 2 :] for x in both])
        del both
        order = np.lexsort((rep, key))
        key, rep = key[order], rep[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (rep[1:] != rep[:-1])
        key, rep = key[first], rep[first]
        starts, lengths = runs(key)
        del key, order, first
        if not len(starts):
            return pa.table({"meeting": rep, "doc_id": rep, "large": np.zeros(0, bool)})
        with np.errstate(over="ignore"):
            name = mix(np.add.reduceat(mix(rep.view(U64)), starts) + lengths.astype(U64)).view(np.int64)
        large = lengths > most
        name[large] = rep[starts[large]]
        named = np.lexsort((large, name))
        again = np.zeros(len(name), bool)
        again[named[1:]] = (name[named[1:]] == name[named[:-1]]) & ~large[named[1:]] & ~large[named[:-1]]
        wanted = np.repeat((lengths > 1) & ~again, lengths)
        got = [x[wanted] for x in (np.repeat(name, lengths), rep, np.repeat(large, lengths))]
        del rep, name, wanted, starts, lengths
        give_back()
        return pa.table(dict(zip(("meeting", "doc_id", "large"), got, strict=True)))

    scattered = docs.mapInArrow(scatter, "part int, packed binary").repartition(parts, "part")
    return scattered.groupBy("part").applyInArrow(meet, "meeting long, doc_id long, large boolean").distinct()


def alike(n: np.ndarray, sketches: list[np.ndarray], limit: Threshold) -> np.ndarray:
    """For each set the first one that it is chained with by pairs that may be linked, by their sizes and sketches."""
    words = min(map(len, sketches))
    bits = np.stack([folded(x, words) for x in sketches])
    label, left = np.arange(len(n)), np.arange(len(n))
    while len(left):
        root, left = left[0], left[1:]
        waiting = [root]
        while waiting and len(left):
            x = waiting.pop()
            need = limit.needed(n[left], n[x])
            apart = np.bitwise_count(bits[left] ^ bits[x]).sum(1, dtype=np.int64)
            near = (need <= np.minimum(n[left], n[x])) & (apart <= n[left] + n[x] - 2 * need)
            label[left[near]] = root
            waiting.extend(left[near])
            left = left[~near]
    return label


def _edges(meetings: DataFrame, classes: DataFrame, limit: Threshold) -> DataFrame:
    """Rows (u, v) that connect all linked sets of a meeting, and few others."""
    spark = meetings.sparkSession

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("meeting", "ascending"), ("doc_id", "ascending")])
        doc, n = table.column("doc_id").to_numpy(), table.column("n").to_numpy()
        sketches = [np.frombuffer(x, U64) for x in table.column("sketch").to_pylist()]
        low = doc.copy()
        for start, length in zip(*runs(table.column("meeting").to_numpy()), strict=True):
            if length > 1:
                at = slice(start, start + length)
                low[at] = doc[at][alike(n[at], sketches[at], limit)]
        del table, sketches
        give_back()
        far = doc != low
        return pa.table({"u": doc[far], "v": low[far]})

    meetings = materialize(meetings, "meetings")
    small = meetings.filter("not large")
    # a sketch has 2 KB at most
    parts = partitions_for(spark, small.count(), 50_000)
    small = small.join(classes.select(F.col("rep").alias("doc_id"), "n", "sketch"), "doc_id")
    small = small.withColumn("part", F.pmod(F.xxhash64("meeting"), F.lit(parts))).drop("large")
    found = small.repartition(parts, "part").groupBy("part").applyInArrow(run, "u long, v long")
    return found.unionByName(meetings.filter("large").select(F.col("doc_id").alias("u"), F.col("meeting").alias("v"))).distinct()


def overlaps(a: list[np.ndarray], b: list[np.ndarray], limit: Threshold, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the linked pairs of two tiles of sets; of one tile, i < j, if they are the same."""
    na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    need = limit.needed(na[:, None], nb[None, :])
    alive = need <= np.minimum(na[:, None], nb[None, :])
    if same:
        alive &= np.arange(len(a))[:, None] < np.arange(len(b))[None, :]
    ia, ib = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
    if not len(ia) or not len(ib):
        return ia[:0], ib[:0]
    ga, gb = np.concatenate([a[i] for i in ia]), np.concatenate([b[i] for i in ib])
    ra, rb = np.repeat(ia, na[ia]), np.repeat(ib, nb[ib])
    columns = np.intersect1d(ga, gb)
    ca, cb = np.searchsorted(columns, ga), np.searchsorted(columns, gb)
    in_a, in_b = ca < len(columns), cb < len(columns)
    in_a[in_a] = columns[ca[in_a]] == ga[in_a]
    in_b[in_b] = columns[cb[in_b]] == gb[in_b]
    ca, ra, cb, rb = ca[in_a], ra[in_a], cb[in_b], rb[in_b]
    ca, ra = ca[o := np.argsort(ca, kind="stable")], ra[o]
    cb, rb = cb[o := np.argsort(cb, kind="stable")], rb[o]
    da, db = np.bincount(ca, minlength=len(columns)), np.bincount(cb, minlength=len(columns))
    light = da * db <= LIGHT
    # rare columns: each adds the product of its two columns of the matrix
    total = np.zeros(len(a) * len(b), np.int64)
    fa, fb = np.r_[0, np.cumsum(da)[:-1]], np.r_[0, np.cumsum(db)[:-1]]
    entries = np.flatnonzero(light[ca])
    reps = db[ca[entries]]
    left = np.repeat(ra[entries], reps)
    step = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    right = rb[np.repeat(fb[ca[entries]], reps) + step]
    total += np.bincount(left * len(b) + right, minlength=len(total))
    total = total.reshape(len(a), len(b))
    heavy = np.flatnonzero(~light)
    if len(heavy):
        ha = np.bincount(ra[~light[ca]], minlength=len(a))
        hb = np.bincount(rb[~light[cb]], minlength=len(b))
        alive &= total + np.minimum(ha[:, None], hb[None, :]) >= need
        rows_a, rows_b = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if len(rows_a):
            at_a, at_b = np.full(len(a), -1), np.full(len(b), -1)
            at_a[rows_a], at_b[rows_b] = np.arange(len(rows_a)), np.arange(len(rows_b))
            more = np.zeros((len(rows_a), len(rows_b)), np.float32)
            for first in range(0, len(heavy), 1024):
                block = heavy[first : first + 1024]
                x = np.zeros((len(rows_a), len(block)), np.float32)
                y = np.zeros((len(rows_b), len(block)), np.float32)
                for j, c in enumerate(block):
                    i = at_a[ra[fa[c] : fa[c] + da[c]]]
                    x[i[i >= 0], j] = 1
                    i = at_b[rb[fb[c] : fb[c] + db[c]]]
                    y[i[i >= 0], j] = 1
                more += x @ y.T
            total[np.ix_(rows_a, rows_b)] += more.astype(np.int64)
    return np.nonzero(alive & (total >= need))


def smallest_label(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node connected with it by the pairs (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _products(tiles: DataFrame, limit: Threshold, folder: str) -> DataFrame:
    """Rows (u, s1, s2, v, links): a set of u is linked with ``links`` other rows, and connected with v."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("doc_id", "ascending")])
        side, same = table.column("side").to_numpy(), table.column("i")[0] == table.column("j")[0]
        sets = read_ranges(folder, table.column("file").to_pylist(), table.column("place").to_numpy(), table.column("n").to_numpy())
        at_a = np.flatnonzero(side == 0)
        at_b = at_a if same else np.flatnonzero(side == 1)
        i, j = overlaps([sets[x] for x in at_a], [sets[x] for x in at_b], limit, same)
        i, j = at_a[i], at_b[j]
        doc, weight = table.column("doc_id").to_numpy(), table.column("weight").to_numpy()
        links = np.bincount(i, weight[j], len(doc)) + np.bincount(j, weight[i], len(doc))
        order = np.argsort(doc, kind="stable")  # the smallest row is then the smallest document
        place = np.empty(len(doc), np.int64)
        place[order] = np.arange(len(doc))
        label = order[smallest_label(len(doc), place[i], place[j])][place]
        got = links > 0
        sig = {c: table.column(c).to_numpy()[got] for c in ("s1", "s2")}
        return pa.table({"u": doc[got], **sig, "v": doc[label][got], "links": links[got].astype(np.int64)})

    return tiles.groupBy("cluster", "i", "j").applyInArrow(run, "u long, s1 long, s2 long, v long, links long")


def _chunks(sets: DataFrame) -> DataFrame:
    """Add ``chunk``: the weight before a row, in the order of cluster and size, in units of a tile.

    Rows are sorted by range, and each range counts on from the weight of those before it. So a
    cluster that holds most rows is spread over many ranges.
    """
    keys = ["cluster", "n", "doc_id", "s1", "s2"]
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = sets.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged.withColumn("_load", F.greatest("n", F.lit(200))), "ranges")
    loads = ranged.groupBy("_range").agg(F.sum("_load").alias("_sum"))
    before = F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = loads.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.sum("_load").over(Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    # one row per range: bounded by the number of ranges, not by the data
    joined = ranged.withColumn("_inside", inside).join(F.broadcast(starts), "_range")
    chunk = F.floor((F.col("_before") + F.col("_inside") - 1) / F.lit(TILE)).cast("long")
    return joined.withColumn("chunk", chunk).drop("_range", "_load", "_inside", "_before")


def _tiles(sets: DataFrame, limit: Threshold) -> DataFrame:
    """Every row once for each tile that it is part of; ``side`` 0 or 1."""
    rows = materialize(_chunks(sets), "chunks")
    sizes = rows.groupBy("cluster", "chunk").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a = sizes.select("cluster", F.col("chunk").alias("i"), F.col("high").alias("a_high"))
    b = sizes.select("cluster", F.col("chunk").alias("j"), F.col("low").alias("b_low"))
    pairs = a.join(b, "cluster").filter(
        (F.col("i") <= F.col("j")) & (F.col("b_low") * limit.num <= F.col("a_high") * limit.den)
    )
    pairs = materialize(pairs.select("cluster", "i", "j"), "tiles")
    ends = F.when(F.col("i") == F.col("j"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    places = pairs.select("cluster", "i", "j", F.explode(ends).alias("side")).withColumn(
        "chunk", F.when(F.col("side") == 0, F.col("i")).otherwise(F.col("j"))
    )
    # the rows are narrow, so their bytes say little about the work: a few tiles go to each task
    tasks = partitions_for(sets.sparkSession, pairs.count(), 8)
    return rows.join(places, ["cluster", "chunk"]).repartition(tasks, "cluster", "i", "j")


def jaccard_components(
    docs: DataFrame, k: int, num: int, den: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles, n_links, component_id.

    Two rows are linked when ``den * overlap >= num * union`` of their sets of distinct k-word
    shingles. ``n_links`` counts the other rows linked directly. Null or empty texts have no
    shingles and no links. Rows with one doc_id are one node, whatever their texts; a row with a
    null doc_id is linked with nothing and has a null component. Other columns are ignored.
    """
    spark, limit = docs.sparkSession, Threshold(num, den)
    ship(spark)
    docs = with_columns(docs, doc_id=id_column, text=text_column)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = materialize(_signatures(docs, k), "sets")
    known = rows.filter((F.col("n") > 0) & F.col("doc_id").isNotNull())
    by_set = ["n", "s1", "s2"]
    classes = materialize(
        known.groupBy(*by_set).agg(
            F.min("doc_id").alias("rep"), F.count("*").alias("weight"), F.first("sketch").alias("sketch")
        ),
        "classes",
    )
    total = classes.agg(F.sum("n")).first()[0] or 0

    there = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    # One row of each class is keyed, the one with its smallest id. The bitmap lets a few more through: they meet as themselves
    # and are dropped where the members are joined with the classes.
    first = Likely(classes.select(F.col("rep").alias("doc_id")))
    meetings = _meetings(there, k, limit, first, partitions_for(spark, total))
    clusters = connected_components(_edges(meetings, classes, limit))
    classes = classes.drop("sketch")

    clustered = materialize(clusters.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster")), "clusters")
    mine = classes.withColumnRenamed("rep", "doc_id").join(clustered, "doc_id")
    folder = new_path(spark, "ngram-sets")
    stored = materialize(_stored_sets(there, k, Likely(clustered), folder), "stored-sets")
    sets = stored.join(mine, ["doc_id", *by_set]).dropDuplicates(["doc_id", "s1", "s2"])
    linked = materialize(_products(_tiles(sets, limit), limit, folder), "links")

    of_row = known.select("doc_id", *by_set).join(classes, by_set).select("doc_id", "n", "s1", "s2", "rep", "weight")
    one_node = of_row.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("u"))
    shared = of_row.join(one_node.filter("u != v").select("doc_id", "v"), "doc_id").select(F.col("rep").alias("u"), "v")
    nodes = connected_components(linked.select("u", "v").unionByName(shared))
    degree = linked.groupBy(F.col("u").alias("rep"), "s1", "s2").agg(F.sum("links").alias("links"))
    named = (
        of_row.select(*by_set, "rep", "weight")
        .distinct()
        .join(degree, ["rep", "s1", "s2"], "left")
        .join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            *by_set,
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    lone = F.col("doc_id").isNull()
    return rows.join(named, by_set, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(lone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(~lone, F.coalesce("component", "doc_id")).alias("component_id"),
    )
