"""Bronze message -> typed, enriched staging row, for static and streaming input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from touchline.functions.text import with_themes
from touchline.schemas import STAGING_COLUMNS, TWEET_SCHEMA

_COUNTERS = ("like_count", "retweet_count")


def parse_tweets(raw: DataFrame, value: str = "value", coerce_counters: bool = False) -> DataFrame:
    """Parse the JSON ``value`` (string or binary) into the typed columns.

    ``inline`` over a one-element array keeps the parse in a generator, so a
    later filter on a parsed field does not make Catalyst parse twice.
    With ``coerce_counters`` numeric strings count as numbers; by default a
    counter of the wrong type becomes null, like any other mistyped field.
    """
    schema = TWEET_SCHEMA
    if coerce_counters:
        schema = StructType(
            [
                StructField(f.name, StringType() if f.name in _COUNTERS else f.dataType, True)
                for f in schema.fields
            ]
        )
    parsed = raw.select(F.inline(F.array(F.from_json(F.col(value).cast("string"), schema))))
    if coerce_counters:
        parsed = parsed.withColumns({c: F.col(c).try_cast(LongType()) for c in _COUNTERS})
    return parsed


def drop_unparseable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("tweet_id").isNotNull())


def engagement(likes: Column | str = "like_count", retweets: Column | str = "retweet_count") -> Column:
    """Likes plus retweets, missing counters as 0; null on 64-bit overflow."""
    return F.try_add(F.coalesce(likes, F.lit(0)), F.coalesce(retweets, F.lit(0)))


def with_engagement(df: DataFrame) -> DataFrame:
    return df.withColumn("engagement", engagement(F.col("like_count"), F.col("retweet_count")))


def parse_created_at(df: DataFrame) -> DataFrame:
    """ISO text to timestamp; empty or malformed text gives null, also in ANSI mode."""
    return df.withColumn("created_at", F.try_to_timestamp(F.col("created_at")))


def with_processed_at(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.current_timestamp())


def enrich(df: DataFrame, coerce_counters: bool = False) -> DataFrame:
    """Add engagement and themes to flat posts, keeping every other column."""
    if coerce_counters:
        df = df.withColumns({c: F.col(c).try_cast(LongType()) for c in _COUNTERS})
    return df.transform(with_engagement).transform(with_themes)


def to_staging(raw: DataFrame, coerce_counters: bool = False) -> DataFrame:
    """Raw messages to the eleven staging columns."""
    return (
        parse_tweets(raw, coerce_counters=coerce_counters)
        .transform(drop_unparseable)
        .transform(enrich)
        .transform(parse_created_at)
        .transform(with_processed_at)
        .select(*STAGING_COLUMNS)
    )


# The streaming job and batch callers use the same function.
enrich_stream = to_staging


def to_kafka_frame(enriched: DataFrame) -> DataFrame:
    """Silver message: key is the post id, value the staging row as JSON."""
    return enriched.select(
        F.col("tweet_id").cast("string").alias("key"),
        F.to_json(F.struct(*STAGING_COLUMNS)).alias("value"),
    )
