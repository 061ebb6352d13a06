"""Connected components of an edge table.

Large-star and small-star rounds: a node links its larger neighbours, then its smaller ones, to its
smallest neighbour, until every component is a star. Nodes are spread over tasks by hash, as many tasks as
the edges need; the edges are stored after every round, so a lost executor costs a reread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.words import U64, mix, part_of, runs, split_by
from annalist.session import materialize

#: edges that one task holds, about
EDGES = 500_000
_STATE = "part int, packed binary, changed long"


def _sent(key: np.ndarray, other: np.ndarray, parts: int, changed: int) -> list[tuple[int, bytes, int]]:
    """Pairs packed for the task that holds their key."""
    out = [(p, key[i].tobytes() + other[i].tobytes(), 0) for p, i in split_by(part_of(mix(key.view(U64)), parts))]
    return [(p, blob, changed if k == 0 else 0) for k, (p, blob, _) in enumerate(out)]


def _table(rows: list[tuple[int, bytes, int]]) -> pa.Table:
    kinds = (pa.int32(), pa.binary(), pa.int64())
    columns = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["part", "packed", "changed"])


def _grouped(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, what they are paired with, and the smallest of each key's pairs."""
    both = [np.frombuffer(x, np.int64) for x in table.column("packed").to_pylist()]
    key = np.concatenate([x[: len(x) // 2] for x in both])
    other = np.concatenate([x[len(x) // 2 :] for x in both])
    order = np.lexsort((other, key))
    key, other = key[order], other[order]
    first = np.r_[True, (key[1:] != key[:-1]) | (other[1:] != other[:-1])]
    key, other = key[first], other[first]
    starts, lengths = runs(key)
    return key, other, np.repeat(other[starts], lengths)


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (u, v) to rows (node, component): component is the smallest node reachable.

    Nodes are integers; nodes without an edge to another node do not appear. Nulls, loops
    and repeated edges are ignored; an empty table gives an empty table.
    """
    plain = edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
    plain = materialize(plain.filter(F.col("u") != F.col("v")), "edges")
    parts = 1 << (plain.count() // EDGES + 3).bit_length()

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = batch.column("u").to_numpy(), batch.column("v").to_numpy()
            yield from _table(_sent(np.r_[u, v], np.r_[v, u], parts, 1)).to_batches()

    def large(table: pa.Table) -> pa.Table:
        key, other, low = _grouped(table)
        low = np.minimum(key, low)
        up = other > key
        return _table(_sent(other[up], low[up], parts, int((low[up] != key[up]).sum())))

    def small(table: pa.Table) -> pa.Table:
        key, other, low = _grouped(table)
        changed = int((other != low).sum()) + int(table.column("changed").to_pandas().sum())
        u, v = np.r_[other, key], np.r_[low, low]
        u, v = u[u != v], v[u != v]
        return _table(_sent(np.r_[u, v], np.r_[v, u], parts, changed))

    state = plain.mapInArrow(scatter, _STATE)
    while True:
        state = state.groupBy("part").applyInArrow(large, _STATE).groupBy("part").applyInArrow(small, _STATE)
        state = materialize(state, "stars")
        if not state.agg(F.sum("changed")).first()[0]:
            break

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [np.frombuffer(x, np.int64) for x in batch.column("packed").to_pylist()]
            if both:
                node = np.concatenate([x[: len(x) // 2] for x in both])
                other = np.concatenate([x[len(x) // 2 :] for x in both])
                low = np.minimum(node, other)  # the centre of a star is its smallest node
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(low)], ["node", "component"])

    return state.select("packed").mapInArrow(unpack, "node long, component long").distinct()
