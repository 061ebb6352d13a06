"""Language identification by averaged hashed subword embeddings and a linear softmax.

A word is its character n-grams and itself, hashed into ``BUCKETS`` rows of an embedding table; a text is the
mean of its words' subwords; a linear softmax reads off the language. Trained by stochastic
gradient descent in numpy on a bounded sample of labelled rows. As the layers are linear,
scoring needs one row of class scores per bucket, and per distinct word their sum.

The temperature is fitted on rows that were not trained on. A text is rejected if its confidence is below what
nearly all rightly predicted ones of these rows reach in its language, and if the model rather doubts its answer; wrong
labels among the rows lower the confidence, but never decide alone. Where a language has no such row, or the
model no label, only texts without a letter are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annalist.llm.words import U64, few_rows, give_back, mix, ship, with_columns
from annalist.session import materialize

BUCKETS, DIM, EPOCHS, RATE = 1 << 15, 16, 6, 0.5
#: most labelled rows that a model is trained and calibrated on, for each language
SAMPLE = 1500
#: share of rightly predicted rows that may lie below the threshold of their language
QUANTILE = 0.005
#: an answer with at least this calibrated probability is accepted in any case
SURE = 0.5
UNDETERMINED = "und"
#: distinct words a worker remembers; the memory of the cache, not a limit on the texts
CACHE_WORDS = 200_000
_LETTER = regex.compile(r"\p{L}")


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word with its ends marked, and of its character 1- to 4-grams; with the word's number."""
    marked = [f"<{w.lower()}>" for w in words]
    points = np.frombuffer("".join(marked).encode("utf-32-le"), "<u4").astype(U64)
    lengths = np.array([len(w) for w in marked])
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    with np.errstate(over="ignore"):
        at = (np.arange(len(points)) - starts[word] + 5).astype(U64)
        owners, found = [np.arange(len(words))], [mix(np.add.reduceat(mix(points + (at << U64(32))), starts))]
        h = np.zeros(len(points), U64)
        for n in range(1, 5):
            h = mix(h[: len(points) - n + 1] * U64(31) + points[n - 1 :] + U64(n))
            inside = word[: len(h)] == word[n - 1 :]
            owners.append(word[: len(h)][inside])
            found.append(h[inside])
    return np.concatenate(owners), (np.concatenate(found) & U64(BUCKETS - 1)).astype(np.int64)


def letters(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their shares."""
    counts: dict[str, int] = {}
    for w in text.split():
        counts[w] = counts.get(w, 0) + 1
    owner, bucket = subwords(list(counts))
    total = np.bincount(bucket, np.array(list(counts.values()))[owner], BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at] / total.sum()


@dataclass
class Model:
    labels: list[str]
    scores: np.ndarray  # bucket x language, embeddings times the linear layer
    bias: np.ndarray
    temperature: float = 1.0
    #: by language; a confidence below it is rejected
    thresholds: np.ndarray | None = None

    def rejects(self, label: int, confidence: float) -> bool:
        return self.thresholds is not None and confidence < self.thresholds[label]

    def confidence(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(-1, keepdims=True))
        return z / z.sum(-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], labels: list[str], seed: int = 5) -> Model:
    """Stochastic gradient descent over (buckets, shares, label number)."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, DIM)) / DIM
    layer, bias = np.zeros((DIM, len(labels))), np.zeros(len(labels))
    weight = np.bincount([y for *_, y in rows], minlength=len(labels)).astype(float)
    weight = len(rows) / (len(labels) * np.maximum(weight, 1))
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(rows)):
            at, share, y = rows[k]
            rate = RATE * (1 - done / steps)
            done += 1
            hidden = share @ table[at]
            z = hidden @ layer + bias
            z = np.exp(z - z.max())
            error = -z / z.sum()
            error[y] += 1
            error *= rate * min(weight[y], 5.0)
            back = layer @ error
            layer += np.outer(hidden, error)
            bias += 0.1 * error
            # the share of a bucket is small: the step is taken for the mean, as if all had moved
            table[at] += np.outer(share / share.max(), back)
    return Model(labels, table @ layer, bias)


def calibrate(model: Model, rows: list[tuple[np.ndarray, np.ndarray, int]], quantile: float = QUANTILE) -> Model:
    """Temperature by likelihood; thresholds by the confidence of the rows that are predicted rightly."""
    model.thresholds = np.zeros(len(model.labels))
    if not rows:
        return model
    logits = np.stack([share @ model.scores[at] + model.bias for at, share, _ in rows])
    y = np.array([y for *_, y in rows])
    best = None
    for t in np.geomspace(0.05, 20, 49):
        model.temperature = t
        p = model.confidence(logits)[np.arange(len(y)), y]
        loss = -np.log(np.maximum(p, 1e-12)).mean()
        if best is None or loss < best[0]:
            best = (loss, t)
    model.temperature = float(best[1])
    p = model.confidence(logits)
    top, label = p.max(1), p.argmax(1)
    for k in np.unique(label[label == y]):
        right = top[(label == k) & (y == k)]
        model.thresholds[k] = min(SURE, float(np.quantile(right, quantile, method="lower")))
    return model


def _sample(labelled: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows of each language, the lowest in a seeded hash: kept small before the shuffle."""
    pick = F.struct(F.xxhash64(F.lit(3), "doc_id").alias("h"), "doc_id")
    hashed = labelled.select("lang", pick.alias("p"))
    # twice the share that is needed goes on, so that no window holds all rows of a language
    counts = hashed.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), 2.0 * F.lit(size) / F.col("n") + 20 / F.col("n"))
    # one row per language, as many as the model has labels
    low = hashed.join(F.broadcast(counts), "lang").filter((F.pmod(F.col("p.h"), F.lit(1_000_003)) / 1_000_003.0) < share)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("p"))
    chosen = low.withColumn("r", rank).filter(F.col("r") <= size).select("lang", F.col("p.doc_id").alias("doc_id"), "r")
    # bounded by ``size`` and the number of languages
    return labelled.join(F.broadcast(chosen), ["lang", "doc_id"]).dropDuplicates(["lang", "doc_id"])


def fit(docs: DataFrame, sample: int = SAMPLE, quantile: float = QUANTILE) -> Model | None:
    """Train on rows (doc_id, text, lang); None if no row has a language and a letter.

    At most ``sample`` rows of each language are used, every fifth of them for calibration.
    """
    ship(docs.sparkSession)
    labelled = docs.select("doc_id", "text", "lang").filter("text is not null and lang is not null and doc_id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch.column(k).to_pylist() for k in ("text", "lang", "r"))
            for text, lang, rank in zip(*columns, strict=True):
                if letters(text):
                    at, share = features(text)
                    out.append((lang, rank, at.astype("<i4").tobytes(), share.astype("<f4").tobytes()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["lang", "r", "at", "share"]
            )

    taken = _sample(labelled, sample).select("text", "lang", "r")
    rows = materialize(taken.mapInArrow(run, "lang string, r int, at binary, share binary"), "features")
    got = rows.orderBy("lang", "r").collect()  # at most ``sample`` rows of each language, BUCKETS entries each
    labels = sorted({r["lang"] for r in got})
    if not labels:
        return None
    ready = [
        (np.frombuffer(r["at"], "<i4"), np.frombuffer(r["share"], "<f4"), labels.index(r["lang"]))
        for r in got
    ]
    held = [r["r"] % 5 == 0 for r in got]
    model = train([x for x, h in zip(ready, held, strict=True) if not h] or ready, labels)
    return calibrate(model, [x for x, h in zip(ready, held, strict=True) if h], quantile)


class _Words(dict):
    """Word to the row of its class scores, and the number of its subwords."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.rows = model, np.zeros((1024, len(model.labels) + 1))

    def learn(self, words: list[str]) -> None:
        """Rows for new words, all at once."""
        first = len(self)
        if first + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows[:first], np.zeros((first + 2 * len(words), self.rows.shape[1]))])
        owner, bucket = subwords(words)
        for k in range(len(self.model.labels)):
            self.rows[first : first + len(words), k] = np.bincount(owner, self.model.scores[bucket, k], len(words))
        self.rows[first : first + len(words), -1] = np.bincount(owner, minlength=len(words))
        self.update(zip(words, range(first, first + len(words)), strict=True))


#: texts that are judged together
GROUP = 256


class _Judge:
    """A model in a task: the verdicts on texts."""

    def __init__(self, model: Model | None):
        self.model, self.words = model, _Words(model) if model else None

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        return [v for k in range(0, len(texts), GROUP) for v in self._group(texts[k : k + GROUP])]

    def _group(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        model, words = self.model, self.words
        split = [t.split() if letters(t) else None for t in texts]
        if words is not None:
            if len(words) > CACHE_WORDS:
                words.clear()
            if new := list({w for s in split if s for w in s if w not in words}):
                words.learn(new)
        out = []
        for found in split:
            if found is None or words is None:
                out.append((UNDETERMINED, 0.0, found is None))
                continue
            total = words.rows[np.fromiter(map(words.__getitem__, found), np.int64, len(found))].sum(0)
            p = model.confidence(total[:-1] / total[-1] + model.bias)
            out.append((model.labels[int(p.argmax())], float(p.max()), model.rejects(int(p.argmax()), float(p.max()))))
        return out


def predict(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score, rejected), one per row of ``docs``.

    Null texts and texts without a letter are ``und`` with score 0 and rejected. Without a model, which no label
    leaves, the other texts are ``und`` as well, but not rejected. Whole texts are read; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = with_columns(docs, doc_id=id_column, text=text_column)
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    shared = spark.sparkContext.broadcast(model)  # BUCKETS rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(shared.value)
        for batch in batches:
            columns = list(zip(*judge(batch.column("text").to_pylist()), strict=True)) or [[]] * 3
            kinds = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`predict` does not reject, with all their columns, in one pass."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(shared.value)
        for batch in few_rows(batches):
            at = batch.schema.get_field_index(text_column)
            yield batch.filter(pa.array([not v[2] for v in judge(batch.column(at).to_pylist())], pa.bool_()))
        del judge
        give_back()

    return docs.mapInArrow(run, docs.schema)


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % folds, F.lit(0))
