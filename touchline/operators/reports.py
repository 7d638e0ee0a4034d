"""Counts and top lists over staging, validation and audit tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.hashtags import detect_club
from touchline.operators.costs import with_api_cost
from touchline.vocabulary import BUDGET_LIMIT, LATENCY_BUCKETS


def staging_total(staging: DataFrame) -> DataFrame:
    return staging.agg(F.count("*").alias("total"))


def ordered_counts(df: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    return df.groupBy(key).agg(F.count("*").alias(n)).orderBy(F.desc(n), F.asc(key))


def theme_counts(staging: DataFrame) -> DataFrame:
    return ordered_counts(staging.select(F.explode("themes").alias("theme")), "theme")


def duplicate_ids(staging: DataFrame, limit: int = 50) -> DataFrame:
    """The ``limit`` post ids that occur most often, and more than once; 50 as published."""
    counted = staging.groupBy("tweet_id").agg(F.count("*").alias("n"))
    return counted.where("n > 1").orderBy(F.desc("n"), F.asc("tweet_id")).limit(limit)


def top_engaged(staging: DataFrame, limit: int = 50) -> DataFrame:
    """The ``limit`` posts with a theme that have most engagement, ties by id; 50 as published."""
    return (
        staging.where(F.size("themes") > 0)
        .select("tweet_id", "engagement", "themes", "hashtags", "created_at")
        .orderBy(F.desc("engagement"), F.asc("tweet_id"))
        .limit(limit)
    )


def count_distinct_authors(
    tweets: DataFrame, author: str = "author_id", approximate: bool = False
) -> DataFrame:
    """Number of different non-empty authors; a sketch on request."""
    named = F.nullif(F.col(author), F.lit(""))
    counter = F.approx_count_distinct if approximate else F.count_distinct
    return tweets.agg(counter(named).alias("authors"))


def valid_invalid_counts(validated: DataFrame) -> DataFrame:
    valid = F.size("errors") == 0
    return validated.agg(F.count_if(valid).alias("valid"), F.count_if(~valid).alias("invalid"))


def rejects_by_reason(validated: DataFrame) -> DataFrame:
    return ordered_counts(validated.select(F.explode("errors").alias("reason")), "reason")


def sent_by_club(valid: DataFrame, hashtags: Column | str = "hashtags") -> DataFrame:
    return ordered_counts(valid.select(detect_club(hashtags).alias("club")), "club")


def delivery_failures(audit: DataFrame, prefix: str = "__connect.errors.") -> DataFrame:
    """Failed deliveries per topic, read from dead-letter headers."""
    topics = F.filter("headers", lambda h: h["key"] == f"{prefix}topic")
    return ordered_counts(
        audit.where(F.size(topics) > 0).select(F.get(topics, F.lit(0))["value"].cast("string").alias("topic")),
        "topic",
    )


def latency_histogram(
    df: DataFrame, seconds: str, buckets: Sequence[float] = LATENCY_BUCKETS
) -> DataFrame:
    """Cumulative bucket counts with the overall count and sum, from one pass."""
    value = F.col(seconds)
    counted = df.agg(
        *[F.count_if(value <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(buckets)],
        F.count(value).alias("count"),
        F.coalesce(F.sum(value), F.lit(0.0)).alias("sum"),
    )
    entries = [
        F.struct(F.lit(f"{b:g}").alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(buckets)
    ]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("count").alias("n")))
    return counted.select(F.inline(F.array(*entries)), "count", "sum")


def run_summary(
    merged: DataFrame,
    run: str = "run_id",
    author: str = "author_id",
    observed_at: str | None = None,
    budget: str = BUDGET_LIMIT,
    runs: DataFrame | None = None,
) -> DataFrame:
    """One row per collection run.

    ``runs`` (run, ``errors``) names all runs: one without posts gets a row of zeros, and one
    with errors counts as failed. Without it only runs with posts are known, and none failed.

    Input: merged and validated posts with ``errors`` and ``enriched``. Counting
    per run and author first keeps the distinct counts exact without expanding
    the rows, and combines a busy run or author before the shuffle. A valid post is sent
    unless ``flatten_error``, where that column is there, tells that it cannot be flattened.
    """
    named = F.nullif(F.col(author), F.lit(""))
    flattens = F.col("flatten_error").isNull() if "flatten_error" in merged.columns else F.lit(True)
    when = F.col(observed_at) if observed_at else F.lit(None).cast("timestamp")
    per_author = merged.groupBy(F.col(run), named.alias("_author")).agg(
        F.count("*").alias("_rows"),
        F.count_if(F.size("errors") == 0).alias("_valid"),
        F.count_if((F.size("errors") == 0) & flattens).alias("_sent"),
        F.max(F.coalesce("enriched", F.lit(False))).alias("_known"),
        F.min(when).alias("_first"),
        F.max(when).alias("_last"),
    )
    summed = per_author.groupBy(run).agg(
        F.sum("_rows").alias("tweets_fetched"),
        F.count_if(F.col("_known") & F.col("_author").isNotNull()).alias("users_enriched"),
        F.sum("_valid").alias("tweets_valid"),
        F.sum("_sent").alias("tweets_sent_to_kafka"),
        F.count("_author").alias("author_ids_found"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    if runs is None:
        summed = summed.withColumn("_errors", F.expr("CAST(array() AS ARRAY<STRING>)"))
    else:
        named_runs = runs.select(run, F.col("errors").alias("_errors"))
        counts = [c for c in summed.columns if c not in (run, "_first", "_last")]
        summed = named_runs.join(summed, run, "left").fillna(0, counts)
    costed = with_api_cost(summed, "tweets_fetched", budget)
    return costed.select(
        run,
        (F.size("_errors") == 0).alias("success"),
        "tweets_fetched",
        "users_enriched",
        F.col("tweets_fetched").alias("tweets_enriched"),
        "tweets_valid",
        (F.col("tweets_fetched") - F.col("tweets_valid")).alias("tweets_invalid"),
        "tweets_sent_to_kafka",
        F.round("api_cost", 2).alias("api_cost_estimate"),
        F.round("remaining_budget", 2).alias("remaining_budget"),
        "author_ids_found",
        F.col("_errors").alias("errors"),
        F.create_map(
            F.lit("started_at"), F.date_format("_first", "yyyy-MM-dd'T'HH:mm:ssXXX"),
            F.lit("finished_at"), F.date_format("_last", "yyyy-MM-dd'T'HH:mm:ssXXX"),
        ).alias("metadata"),
    )
