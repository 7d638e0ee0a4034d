"""Clean a corpus in stages, each of which reads what its predecessor kept.

Quality first, as it is cheap and drops whole documents; then one document of each
group of near copies stays; then documents with benchmark passages go; then personal
data is blotted out; what is left is cut into pieces for training.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.llm import decontamination, ngram_join, pieces, pii, quality
from touchline.llm.queries import model_file
from touchline.llm.shared import stored


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from those of ``docs`` that have labels."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five words, similarity of 0.8 or more) the smallest ``doc_id``."""
    return ngram_join.deduplicate(docs, k=5, num=80, den=100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def blot_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return pii.redacted(docs)


def cut_into_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Count and digests of the pieces of every document, and of the text decoded from them."""
    return pieces.digests(docs, model_file())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", accept_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", decontaminate),
    ("PII", blot_personal_data),
    ("SentencePiece encoding and decoding", cut_into_pieces),
]

#: Models and tokenizers have no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
