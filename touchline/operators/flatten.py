"""Nested API post -> flat bronze message, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.hashtags import nested_hashtags
from touchline.functions.variants import (
    as_json_text,
    body_is_text,
    field,
    is_object,
    text_of,
    truthy,
    with_post,
)
from touchline.vocabulary import MSG_BODY_NOT_OBJECT, MSG_MISSING

# Flat field -> (path in the nested post, JSON default when the key is absent).
_SOURCES = {
    "text": ("text", '""'),
    "created_at": ("created_at", '""'),
    "author_id": ("author_id", '""'),
    "lang": ("lang", '"unknown"'),
    "like_count": ("public_metrics.like_count", "0"),
    "retweet_count": ("public_metrics.retweet_count", "0"),
}


def flatten_tweets(
    df: DataFrame,
    body: str = "value",
    output: str = "flat",
    author: str | None = None,
    raw: str | None = None,
) -> DataFrame:
    """Add the flat JSON message and a ``flatten_error`` (null where it worked).

    Defaults fill absent keys only: a key holding null stays null, and values
    keep their JSON type. The original body is embedded as ``raw_payload``.

    ``body`` is JSON text or an already parsed VARIANT; for the latter ``raw`` names
    the column with the original text. With ``author`` the author id is added under
    that name, from the same parse.
    """
    raw = as_json_text(df, raw or body)
    staged = with_post(df, body, "_post") if body_is_text(df, body) else df.withColumn("_post", F.col(body))
    staged = staged.withColumn("_raw", raw)
    post = F.col("_post")
    error = (
        F.when(post.isNull() | ~is_object(post, "id"), F.lit(MSG_BODY_NOT_OBJECT))
        .when(~truthy(field(post, "id")), F.lit(MSG_MISSING.format(field="id")))
    )
    fields = [field(post, "id").alias("tweet_id")]
    for name, (path, default) in _SOURCES.items():
        fields.append(F.coalesce(field(post, path), F.parse_json(F.lit(default))).alias(name))
    fields.append(nested_hashtags(post).alias("hashtags"))
    head = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    # Splice the payload in as text so that its bytes survive unchanged.
    flat = F.concat(F.rtrim(head, F.lit("}")), F.lit(',"raw_payload":'), F.col("_raw"), F.lit("}"))
    if author is not None:
        staged = staged.withColumn(author, text_of(post, "author_id"))
    return (
        staged.withColumn("flatten_error", error)
        .withColumn(output, F.when(F.col("flatten_error").isNull(), flat))
        .drop("_post", "_raw")
    )


def decode_flat(df: DataFrame, body: str = "value", output: str = "post") -> DataFrame:
    """Decode a flat message to VARIANT; invalid UTF-8 or JSON gives null."""
    text = F.col(body)
    if df.schema[body].dataType.typeName() == "binary":
        text = F.try_validate_utf8(text.cast("string"))
    return df.withColumn(output, F.try_parse_json(text))
