"""A corpus pipeline: each stage works on all documents its predecessor kept.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written as Parquet and
read again as the next one's documents. All but the last keep the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from annalist.llm import decontaminate, langid, ngram_join, packing, suffix_dedup
from annalist.llm.queries import tokenizer_file
from annalist.llm.words import without_ids
from annalist.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: documents are wide: so many bytes of them go to a Python worker at once, if the session does not say how many
BATCH_BYTES = "4m"
_BATCHES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(stage: Stage) -> Stage:
    """The same stage in a session whose Arrow batches are bounded by bytes; the setting stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(_BATCHES, None) is None:
            spark.conf.set(_BATCHES, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told with confidence go.

    Learns from the labelled documents outside fold 2 of 4.
    """
    return langid.accepted(docs, langid.fit(docs.filter(langid.fold("doc_id", 4) != 2)))


@small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Five-word shingles, Jaccard of at least 0.8. Rows that repeat a doc_id are one document and stay together.
    """
    found = ngram_join.jaccard_components(docs, k=5, num=80, den=100)
    return without_ids(docs, found.filter(F.col("component_id") < F.col("doc_id")))


@small_batches
def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more stay in the document with the smallest id and are cut from the others.

    ``n_chars`` follows the text. A document that only repeats others goes.
    """
    cut = suffix_dedup.without_passages(docs, suffix_dedup.shared_passages(docs))
    if "n_chars" not in docs.columns:
        return cut.select(*docs.columns)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*docs.columns)


@small_batches
def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, in any order of its parts, go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without_ids(docs, decontaminate.contamination(docs, items))


@small_batches
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("suffix_array_dedup", passages),
    ("benchmark_decontamination", benchmark),
    ("best_fit_packing", sequences),
]
#: the stages hold a trained model, iterative searches and a tokenizer, which SQL can't express
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
