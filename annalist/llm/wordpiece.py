"""Word-piece counts by linear longest match.

The vocabulary is a trie with failure links: where no edge goes on, the pieces that greedy
longest match would have cut off by then are popped and the link leads to the node of the rest. Only
the number of popped pieces is stored with the node, so a word is counted in one pass over its characters, and no
piece is ever built.

A word is tried with the word mark in front: pieces that begin with the mark open a word, the
others continue it. A word that cannot be cut counts as one unknown piece.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annalist.llm.words import byte_texts, ship, with_columns

MARK = "▁"
#: distinct words a worker remembers; the memory of the cache, not a limit on the texts
CACHE_WORDS = 400_000
_ROOT, _INNER, _NONE = 0, 1, -1


def read_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]


class Automaton:
    """Counts the pieces of greedy longest match in time linear in the word."""

    def __init__(self, pieces: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        token = [False, False]
        for piece in pieces:
            node = _ROOT if piece.startswith(MARK) else _INNER
            for ch in piece:
                step = self.next[node]
                if ch not in step:
                    step[ch] = len(self.next)
                    self.next.append({})
                    token.append(False)
                node = step[ch]
            token[node] = node > _INNER
        self.fail = [_NONE] * len(self.next)
        self.pops = [0] * len(self.next)
        queue = deque([_ROOT, _INNER])
        while queue:
            parent = queue.popleft()
            for ch, node in self.next[parent].items():
                if token[node]:
                    self.fail[node], self.pops[node] = _INNER, 1
                else:
                    link, popped = self.fail[parent], self.pops[parent]
                    while link != _NONE and ch not in self.next[link]:
                        popped += self.pops[link]
                        link = self.fail[link]
                    if link != _NONE:
                        self.fail[node], self.pops[node] = self.next[link][ch], popped
                queue.append(node)

    def count(self, word: str) -> int:
        """Number of pieces; 0 if the word cannot be cut."""
        node, n = _ROOT, 0
        step, fail, pops = self.next, self.fail, self.pops
        for ch in MARK + word:
            while ch not in step[node]:
                if fail[node] == _NONE:
                    return 0
                n += pops[node]
                node = fail[node]
            node = step[node][ch]
        while node != _INNER:
            if fail[node] == _NONE:
                return 0
            n += pops[node]
            node = fail[node]
        return n


class _Counts(dict):
    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(word.decode("utf-8", "replace"))
        return n


def token_counts(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, n_words, n_tokens, n_unknown), one per row of ``docs``.

    ``vocabulary`` is the path of a sentencepiece file. Words are ``[^\\x20\\x09-\\x0D]+`` of the whole
    text; null and empty texts have none. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(read_pieces(vocabulary))  # bounded by the vocabulary file
    docs = with_columns(docs, doc_id=id_column, text=text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(Automaton(shared.value))
        for batch in batches:
            rows = []
            for text in byte_texts(batch.column(1)):
                words = text.split() if text else []
                n = np.fromiter(map(counts.__getitem__, words), np.int64, len(words))
                unknown = int((n == 0).sum())
                rows.append((len(words), int(n.sum()) + unknown, unknown))
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in columns]],
                ["doc_id", "n_words", "n_tokens", "n_unknown"],
            )

    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    return docs.mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
