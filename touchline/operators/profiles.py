"""Author profiles: tolerant normalisation, lookup join, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.once import once
from touchline.functions.variants import as_variant, field, first_truthy, text_of, truthy
from touchline.schemas import PROFILE_LOOKUP_COLUMNS, PROFILE_SCHEMA


def normalize_profiles(df: DataFrame, body: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Loosely shaped profile objects to the eleven typed columns.

    Alternative spellings fill in for missing or empty values, counters default
    to 0 and flags follow JSON truthiness. Profiles without an id are dropped.
    """
    staged = once(df, _p=as_variant(df, body)).select(*keep, "_p")
    p = F.col("_p")

    def text(name: str, other: str | None = None) -> Column:
        value = field(p, name)
        return text_of(first_truthy(value, field(p, other)) if other else value)

    def count(name: str) -> Column:
        value = field(p, name)
        number = F.try_variant_get(value, "$", "bigint")
        return F.when(truthy(value), F.coalesce(number, F.lit(0))).otherwise(F.lit(0)).cast("long")

    columns = {
        "user_id": text("user_id", "id"),
        "username": text("username", "screen_name"),
        "name": text("name"),
        "followers_count": count("followers_count"),
        "following_count": count("following_count"),
        "verified": truthy(field(p, "verified")),
        "description": text("description", "bio"),
        "profile_image_url": text("profile_image_url", "profile_image_url_https"),
        "location": text("location"),
        "created_at": text("created_at"),
        "is_blue_verified": truthy(field(p, "is_blue_verified")),
    }
    ordered = [columns[name].alias(name) for name in PROFILE_SCHEMA.fieldNames()]
    usable = truthy(first_truthy(field(p, "user_id"), field(p, "id")))
    return staged.where(usable).select(*keep, *ordered)


def last_profile(profiles: DataFrame, sequence: str) -> DataFrame:
    """One row per user: the one with the highest ``sequence``.

    ``max_by`` aggregates on the map side, so repeats of one user shrink to a
    row per task before the shuffle.
    """
    others = [c for c in profiles.columns if c != "user_id"]
    return (
        profiles.groupBy("user_id")
        .agg(F.max_by(F.struct(*others), F.col(sequence)).alias("_last"))
        .select("user_id", *[F.col("_last")[c].alias(c) for c in others])
    )


def merge_profiles(
    tweets: DataFrame,
    profiles: DataFrame,
    author: str = "author_id",
    spread_by: str | None = None,
    salt: int = 1,
) -> DataFrame:
    """Left lookup of one profile per author: eight ``user_*`` columns and ``enriched``.

    ``profiles`` must be unique on ``user_id`` (see :func:`last_profile`). No
    broadcast is forced: Spark broadcasts when the measured size allows it and
    otherwise AQE splits skewed join partitions. Posts without an author cannot
    match, so with ``spread_by`` they get distinct null-equivalent keys instead of
    piling up in one partition. With ``salt`` > 1 every author is spread over that
    many partitions and the profiles are repeated as often, for clusters that run
    without AQE.
    """
    right = profiles.select(
        F.col("user_id").alias("_key"),
        *[F.col(c).alias(f"user_{c}") for c in PROFILE_LOOKUP_COLUMNS],
        F.lit(True).alias("enriched"),
    )
    key = F.nullif(F.col(author), F.lit(""))
    left = tweets.withColumn("_key", key)
    keys = ["_key"]
    if spread_by is not None:
        if salt > 1:
            left = left.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salt)).cast("int"))
            right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
            keys.append("_salt")
        # A NUL prefix never occurs in an author id, so such keys stay unmatched.
        left = left.withColumn(
            "_key", F.coalesce("_key", F.concat(F.lit("\x00"), F.col(spread_by).cast("string")))
        )
    return left.join(right, keys, "left").drop(*keys)


def distinct_authors(tweets: DataFrame, author: str = "author_id") -> DataFrame:
    return tweets.where(F.col(author) != "").select(author).distinct()


def matched_authors(tweets: DataFrame, profiles: DataFrame, author: str = "author_id") -> DataFrame:
    """Authors that have a profile."""
    known = profiles.select(F.col("user_id").alias(author))
    return distinct_authors(tweets, author).join(known, author, "left_semi")


def unmatched_authors(tweets: DataFrame, profiles: DataFrame, author: str = "author_id") -> DataFrame:
    """Authors without a profile; distinct first, so a busy author is one row."""
    known = profiles.select(F.col("user_id").alias(author))
    return distinct_authors(tweets, author).join(known, author, "left_anti")


def distinct_usernames(tweets: DataFrame, sequence: str) -> DataFrame:
    """Usernames (``author_username``, else ``username``) in first-seen order."""
    name = F.coalesce(F.nullif("author_username", F.lit("")), F.nullif("username", F.lit("")))
    return (
        tweets.select(name.alias("username"), F.col(sequence).alias("_seq"))
        .where(F.col("username").isNotNull())
        .groupBy("username")
        .agg(F.min("_seq").alias("first_seen"))
        .orderBy("first_seen", "username")
    )


def profile_stats(tweets: DataFrame, profiles: DataFrame, author: str = "author_id") -> DataFrame:
    """How many distinct authors were found and not found."""
    known = profiles.select(F.col("user_id").alias(author), F.lit(True).alias("_found"))
    looked_up = distinct_authors(tweets, author).join(known, author, "left")
    return looked_up.agg(
        F.count_if(F.col("_found").isNotNull()).alias("success"),
        F.count_if(F.col("_found").isNull()).alias("failed"),
    )
