"""The operators of this subpackage as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import (
    alignment,
    decontamination,
    embedding_join,
    host_rules,
    langid,
    licenses,
    ngram_join,
    pieces,
    pii,
    quality,
    secret_scan,
    spelling,
    urls,
)
from touchline.llm.sql import oracle_sql as oracle_sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_file() -> str:
    """The vocabulary that the installed package of public tokenizers offers."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_file() -> str:
    """The byte-level vocabulary of the same package."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("text_key")


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = _table(spark, sf_dir, "documents")
    return langid.predicted(docs, langid.learn(docs)).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences named or quoted in every document."""
    return licenses.scanned(_table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        "n_words",
        "CAST(size(filter(places, p -> p.base)) AS BIGINT) AS n_base",
        "array_min(transform(filter(places, p -> p.base), p -> p.start)) AS first_word",
        "array_max(transform(filter(places, p -> p.base), p -> p.start)) AS last_word",
        "array_join(array_sort(array_distinct(transform(filter(places, p -> p.base), p -> p.label))), ',') AS base_labels",
        "array_join(array_sort(array_distinct(transform(places, p -> p.label))), ',') AS labels",
        "coalesce(array_max(transform(places, p -> p.share)), 0D) AS score",
    )


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page by its URL."""
    return urls.judged(_table(spark, sf_dir, "pages"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under a similarity of 0.85 of its 4-word shingles."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), k=4, num=85, den=100).drop("text_key")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector under a cosine of 0.93 within its label."""
    return embedding_join.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.93)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    base = len(pii.BASE_KINDS)
    return pii.detected(_table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        *(f"CAST(size(filter(spans, x -> x.kind = '{k}')) AS BIGINT) AS n_{k}" for k in pii.BASE_KINDS),
        f"sha2({_joined(f'filter(spans, x -> x.rank < {base})')}, 256) AS base_sha256",
        f"{_joined('spans')} AS spans",
    )


def op8_pieces(spark: SparkSession, sf_dir: str, file: str | None = None) -> DataFrame:
    """Pieces of every document, as digests of their ids and of the text decoded from them."""
    return pieces.digests(_table(spark, sf_dir, "documents"), file or model_file())


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    base = len(secret_scan.BASE)
    return secret_scan.scanned(_table(spark, sf_dir, "documents")).selectExpr(
        "doc_id",
        *(
            f"CAST(size(filter(spans, x -> x.kind = '{r.kind}')) AS BIGINT) AS n_{r.kind}"
            for r in secret_scan.BASE
        ),
        f"sha2({_joined(f'filter(spans, x -> x.rank < {base})')}, 256) AS base_sha256",
        f"{_joined('spans')} AS spans",
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = decontamination.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on every document, and on the sources that publish them."""
    return host_rules.judged(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies aligned in every document."""
    return alignment.alignments(_table(spark, sf_dir, "documents"), byte_file(), model_file())


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of every word of the documents."""
    return spelling.variants(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality,
            op2_langid,
            op3_licenses,
            op4_ngram_join,
            op5_urls,
            op6_embeddings,
            op7_pii,
            op8_pieces,
            op9_secrets,
            op10_decontamination,
            op11_host_rules,
            op12_alignment,
            op13_spelling,
        )
    }

