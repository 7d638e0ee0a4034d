"""Typed shapes shared by the operators."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    # Every field is nullable: a malformed record gives nulls, never a failure.
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# Message value as parsed by the streaming job; the embedded raw payload is left
# out because nothing downstream of the parse reads it.
TWEET_SCHEMA = _struct(
    tweet_id=StringType(),
    text=StringType(),
    created_at=StringType(),
    author_id=StringType(),
    lang=StringType(),
    like_count=LongType(),
    retweet_count=LongType(),
    hashtags=ArrayType(StringType()),
)

STAGING_SCHEMA = _struct(
    tweet_id=StringType(),
    author_id=StringType(),
    lang=StringType(),
    text=StringType(),
    hashtags=ArrayType(StringType()),
    like_count=LongType(),
    retweet_count=LongType(),
    engagement=LongType(),
    themes=ArrayType(StringType()),
    created_at=TimestampType(),
    processed_at=TimestampType(),
)
STAGING_COLUMNS = STAGING_SCHEMA.fieldNames()

HEADERS_TYPE = ArrayType(_struct(key=StringType(), value=BinaryType()))
MESSAGE_SCHEMA = _struct(key=BinaryType(), value=StringType(), headers=HEADERS_TYPE)

PROFILE_SCHEMA = _struct(
    user_id=StringType(),
    username=StringType(),
    name=StringType(),
    followers_count=LongType(),
    following_count=LongType(),
    verified=BooleanType(),
    description=StringType(),
    profile_image_url=StringType(),
    location=StringType(),
    created_at=StringType(),
    is_blue_verified=BooleanType(),
)

# Profile columns carried onto a matched post, each under a ``user_`` prefix.
PROFILE_LOOKUP_COLUMNS = [
    "username",
    "name",
    "followers_count",
    "following_count",
    "verified",
    "description",
    "location",
    "is_blue_verified",
]

PAGE_SCHEMA = _struct(run_id=StringType(), page=IntegerType(), body=StringType())
METRIC_SCHEMA = _struct(
    ts=TimestampType(),
    metric=StringType(),
    labels=MapType(StringType(), StringType()),
    value=DoubleType(),
)
