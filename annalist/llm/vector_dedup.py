"""Near-duplicate vectors: random-hyperplane hashing, exact cosines, connected components.

Every vector gets one sign code in each of several tables; vectors of one label that agree in a
code meet in a bucket, and each pair that meets is compared by its exact cosine in double precision. A
pair at cosine 0.98 disagrees on a hyperplane with probability 0.064; the number of bits follows the number of
rows, and the number of tables is the one that misses such a pair with a chance of ``MISS`` at most.

Equal vectors are one node with a weight. A bucket is cut into chunks of bounded size and the
chunks are compared two at a time, so a bucket that holds a third of all rows is many tasks. A pair counts in the
first table where it meets; a task gives back degrees and a spanning forest, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.components import connected_components
from annalist.llm.ngram_join import smallest_label
from annalist.llm.words import ship, with_columns
from annalist.session import materialize

SEED = 11
#: chance of missing a pair that is just close enough
MISS = 1e-4
#: vectors in a chunk of a bucket
CHUNK = 512


def sizes(n: int, least: float, miss: float = MISS) -> tuple[int, int]:
    """Bits that keep chance meetings rare among n vectors, and tables that keep the recall."""
    bits = min(max(12, (max(n, 1) - 1).bit_length()), 30)
    agree = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-agree)) if agree < 1 else 1


def planes(dim: int, bits: int, tables: int, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, bits * tables))


def codes(x: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """One code per vector and table."""
    signs = (x @ planes(x.shape[1], bits, tables, seed) > 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits))


def _usable(vectors: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None where one is null, empty, zero or not finite."""
    out: list[np.ndarray | None] = []
    for v in vectors.to_pylist():
        x = None if not v or None in v else np.array(v, np.float64)
        out.append(x if x is not None and np.isfinite(x).all() and x.any() else None)
    return out


def _coded(rows: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """Rows (vec_id, label, packed, codes); vectors that link with nothing have null ``packed``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _usable(batch.column("embedding"))
            got: list[list[int] | None] = [None] * len(vectors)
            for dim in {len(v) for v in vectors if v is not None}:
                at = [i for i, v in enumerate(vectors) if v is not None and len(v) == dim]
                found = codes(np.stack([vectors[i] for i in at]), bits, tables, seed)
                for i, c in zip(at, found.tolist(), strict=True):
                    got[i] = c
            packed = [None if v is None else (v + 0.0).tobytes() for v in vectors]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(packed, pa.binary()), pa.array(got, pa.list_(pa.int32()))],
                ["vec_id", "label", "packed", "codes"],
            )

    return rows.mapInArrow(run, "vec_id long, label long, packed binary, codes array<int>")


def _linked(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the pairs of one bucket task that meet here first and are close enough."""
    x = np.stack([np.frombuffer(v, np.float64) for v in table.column("packed").to_pylist()])
    c = np.array(table.column("codes").to_pylist())
    at = int(table.column("table")[0].as_py())
    side, same = table.column("side").to_numpy(), table.column("i")[0] == table.column("j")[0]
    scale = np.abs(x).max(1, keepdims=True)
    unit = x / scale
    unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
    a = np.flatnonzero(side == 0)
    b = a if same else np.flatnonzero(side == 1)
    i, j = np.nonzero(unit[a] @ unit[b].T >= least - 1e-9)
    i, j = a[i], b[j]
    if same:
        i, j = i[i < j], j[i < j]
    dot = (x[i] / scale[i] * (x[j] / scale[j])).sum(1)
    norm = np.sqrt(((x / scale) ** 2).sum(1))
    first = ~(c[i, :at] == c[j, :at]).any(1)
    close = first & (dot / (norm[i] * norm[j]) >= least)
    return i[close], j[close]


def near_vectors(
    rows: DataFrame,
    least: float = 0.98,
    miss: float = MISS,
    seed: int = SEED,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept.

    Rows with equal labels and a cosine of at least ``least`` are linked. A row is linked with nothing if
    its label or id is null, or its vector is null, empty, zero or holds a null or non-finite
    number; vectors of different lengths are never linked. Rows that repeat an id with its label and
    vector count as one vector; an empty table gives an empty table. Other columns are ignored.
    """
    spark = rows.sparkSession
    ship(spark)
    rows = with_columns(rows, vec_id=id_column, embedding=vector_column, label=label_column)
    rows = rows.withColumns({"vec_id": F.col("vec_id").cast("long"), "label": F.col("label").cast("long")})
    bits, tables = sizes(rows.count(), least, miss)
    coded = materialize(_coded(rows, bits, tables, seed), "coded")
    usable = coded.filter("packed is not null and label is not null and vec_id is not null")
    usable = usable.dropDuplicates(["vec_id", "label", "packed"])
    # equal vectors are one node; the partial sums are combined before the shuffle
    nodes = materialize(
        usable.groupBy("label", "packed").agg(
            F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.min("codes").alias("codes")
        ),
        "nodes",
    )
    places = nodes.select("label", "rep", F.posexplode("codes").alias("table", "code"), F.octet_length("packed").alias("d"))
    bucket = ["label", "d", "table", "code"]
    full = places.groupBy(*bucket).agg(F.count("*").alias("m")).filter("m > 1")
    chunks = F.ceil(F.col("m") / CHUNK).cast("int")
    mine = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    in_bucket = places.join(full, bucket).withColumn("chunks", chunks).withColumn("mine", mine)
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tasks = in_bucket.withColumn("other", other).select(
        *bucket,
        "rep",
        F.least("mine", "other").alias("i"),
        F.greatest("mine", "other").alias("j"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"),
    )
    vectors = nodes.select("label", "rep", "weight", "packed", "codes", F.octet_length("packed").alias("d"))
    tasks = tasks.join(vectors, ["label", "rep", "d"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by task: cut where the task changes, carry the last one over."""
        key = [*bucket, "i", "j"]
        rest: pa.Table | None = None

        def done(t: pa.Table) -> pa.RecordBatch:
            rep, weight = t.column("rep").to_numpy(), t.column("weight").to_numpy()
            i, j = _linked(t, least)
            links = np.bincount(i, weight[j], len(rep)) + np.bincount(j, weight[i], len(rep))
            order = np.argsort(rep, kind="stable")
            place = np.empty(len(rep), np.int64)
            place[order] = np.arange(len(rep))
            label = order[smallest_label(len(rep), place[i], place[j])][place]
            got = links > 0
            return pa.RecordBatch.from_arrays(
                [pa.array(rep[got]), pa.array(rep[label][got]), pa.array(links[got].astype(np.int64)),
                 t.column("label").combine_chunks().filter(pa.array(got))],
                ["u", "v", "links", "label"],
            )

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if rest is None else pa.concat_tables([rest, t])
            changed = np.zeros(max(len(t) - 1, 0), bool)
            for k in key:
                v = t.column(k).to_numpy()
                changed |= v[1:] != v[:-1]
            cuts = [0, *(np.flatnonzero(changed) + 1).tolist()]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e - s > 1:
                    yield done(t.slice(s, e - s))
            rest = t.slice(cuts[-1])
        if rest is not None and len(rest) > 1:
            yield done(rest)

    ordered = tasks.repartition(*bucket, "i", "j").sortWithinPartitions(*bucket, "i", "j", "rep")
    found = materialize(ordered.mapInArrow(compare, "u long, v long, links long, label long"), "links")

    of_row = usable.join(nodes.drop("codes"), ["label", "packed"]).select("vec_id", "label", "rep", "packed", "weight")
    one_node = of_row.groupBy("vec_id").agg(F.min("rep").alias("v"), F.max("rep").alias("u")).filter("u != v")
    shared = of_row.join(one_node.select("vec_id", "v"), "vec_id").select(F.col("rep").alias("u"), "v")
    components = connected_components(found.select("u", "v").unionByName(shared))
    degree = found.groupBy(F.col("u").alias("rep"), "label").agg(F.sum("links").alias("links"))
    named = (
        nodes.select("label", "packed", "rep", "weight")
        .join(degree, ["rep", "label"], "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label",
            "packed",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = coded.join(named, ["label", "packed"], "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id",
        F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
