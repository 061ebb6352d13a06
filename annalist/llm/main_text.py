"""Main text of web pages: flat text blocks, classified by a decision tree.

A block is judged by its words and link density, those of its neighbours, and by what the markup around it says. The tree is
grown from the small labelled table in ``page_examples`` (Gini impurity, best split first, no
randomness), once on the driver, and goes to the tasks with their code; its size is that of the table.

Defined cases: null and empty pages, and pages without article blocks, give an empty text; a page of any length is read
whole, one page at a time; repeated rows give a row each; other columns stay out.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.html_blocks import Block, blocks_of
from annalist.llm.page_examples import PAGES
from annalist.llm.words import ship

FEATURES = (
    "words",
    "link density",
    "words before",
    "link density before",
    "words after",
    "link density after",
    "in content",
    "in frame",
    "named as frame",
    "named as content",
    "heading",
    "item",
)
MAX_DEPTH, MIN_LEAF = 8, 2


def features(blocks: Sequence[Block]) -> np.ndarray:
    """One row per block; beyond the page's ends there are no words."""
    own = np.array([[b.words, b.link_words / b.words, *b[3:]] for b in blocks], np.float64).reshape(-1, 8)
    sizes = np.zeros((len(own) + 2, 2))
    sizes[1:-1] = own[:, :2]
    return np.hstack([own[:, :2], sizes[:-2], sizes[2:], own[:, 2:]])


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays: a row with ``x[feature] <= threshold`` goes to ``low``, others to ``high``; a leaf goes to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.low[at], self.high[at])
        return self.share[at] >= 0.5


def _best_split(x: np.ndarray, y: np.ndarray, min_leaf: int) -> tuple[float, int, float] | None:
    """The split with the least weighted impurity; the first feature and threshold among equals."""
    n, best = len(y), None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        values, hits = x[order, f], np.cumsum(y[order])
        left = np.arange(1, n)
        ok = (values[1:] > values[:-1]) & (left >= min_leaf) & (n - left >= min_leaf)
        if not ok.any():
            continue
        p, q = hits[:-1] / left, (hits[-1] - hits[:-1]) / (n - left)
        impurity = np.where(ok, (left * p * (1 - p) + (n - left) * q * (1 - q)) / n, np.inf)
        i = int(np.argmin(impurity))
        if best is None or impurity[i] < best[0] - 1e-12:
            best = float(impurity[i]), f, float((values[i] + values[i + 1]) / 2)
    return best


def grow(x: np.ndarray, y: np.ndarray, max_depth: int = MAX_DEPTH, min_leaf: int = MIN_LEAF) -> Tree:
    """A tree by recursive splits, until a node is pure, small or deep."""
    nodes: list[list[float]] = []

    def add(rows: np.ndarray, depth: int) -> int:
        me, share = len(nodes), float(y[rows].mean())
        nodes.append([0, np.inf, me, me, share])
        split = _best_split(x[rows], y[rows], min_leaf) if depth < max_depth and 0 < share < 1 else None
        if split is not None and split[0] < share * (1 - share) - 1e-12:
            _, f, threshold = split
            goes_low = x[rows, f] <= threshold
            nodes[me][:4] = [f, threshold, add(rows[goes_low], depth + 1), add(rows[~goes_low], depth + 1)]
        return me

    add(np.arange(len(y)), 0)
    columns = np.array(nodes, np.float64).T
    return Tree(*(columns[i].astype(np.int64) if i in (0, 2, 3) else columns[i] for i in range(5)), depth=max_depth)


def labelled_blocks(pages: Sequence[Sequence[tuple[bool, str]]] = PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of labelled pages."""
    xs, ys = [], []
    for page in pages:
        html, labels = "", []
        for label, piece in page:
            html += piece
            labels += [label] * (len(blocks_of(html)) - len(labels))
        xs.append(features(blocks_of(html)))
        ys += labels
    return np.vstack(xs), np.array(ys, np.float64)


def train(pages: Sequence[Sequence[tuple[bool, str]]] = PAGES) -> Tree:
    return grow(*labelled_blocks(pages))


def article(page: str | None, tree: Tree) -> list[str]:
    """The texts of the article's blocks in page order."""
    blocks = blocks_of(page)
    return [b.text for b, keep in zip(blocks, tree.predict(features(blocks)), strict=True) if keep] if blocks else []


def main_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """Takes ``page_id, url, html``; gives ``page_id, url, text, n_blocks`` with the article's blocks, one per line."""
    ship(pages.sparkSession)
    tree = tree or train()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 256):  # few texts at once, whatever their length
                rows = batch.slice(start, 256)
                found = [article(page.as_py(), tree) for page in rows.column(2)]
                texts = pa.array(["\n".join(f) for f in found], pa.string())
                counts = pa.array([len(f) for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), texts, counts], ["page_id", "url", "text", "n_blocks"]
                )

    given = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {c: given.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return given.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_blocks long")
