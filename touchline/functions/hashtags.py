"""Hashtag extraction, club detection and message keys."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.variants import field, is_list, text_of, truthy
from touchline.vocabulary import CLUB_FALLBACK, CLUB_HASHTAGS, KEY_FALLBACK


def nested_hashtags(post: Column | str) -> Column:
    """``entities.hashtags[].tag`` of a VARIANT post, empty tags and non-objects skipped.

    Only an object can have a ``tag``, so testing for one covers both.
    """
    entries = F.try_variant_get(post, "$.entities.hashtags", "array<variant>")
    tags = F.transform(
        F.filter(entries, lambda h: truthy(field(h, "tag"))),
        lambda h: text_of(h, "tag"),
    )
    return F.coalesce(tags, F.expr("CAST(array() AS ARRAY<STRING>)"))


def extract_hashtags(post: Column | str) -> Column:
    """Nested hashtags, or the older flat ``hashtags`` list where none are nested."""
    nested = field(post, "entities.hashtags")
    flat = F.coalesce(
        F.try_variant_get(post, "$.hashtags", "array<string>"),
        F.expr("CAST(array() AS ARRAY<STRING>)"),
    )
    has_nested = F.coalesce(is_list(nested) & truthy(nested), F.lit(False))
    return F.when(has_nested, nested_hashtags(post)).otherwise(flat)


def detect_club(
    hashtags: Column | str,
    clubs: Mapping[str, str] = CLUB_HASHTAGS,
    fallback: str = CLUB_FALLBACK,
) -> Column:
    """Club of the first hashtag found in the map, else the fallback."""
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(clubs.items())])
    found = F.transform(hashtags, lambda t: F.try_element_at(lookup, F.ltrim(F.lower(t), F.lit("#"))))
    return F.coalesce(F.get(F.filter(found, lambda c: c.isNotNull()), F.lit(0)), F.lit(fallback))


def partition_key(author_id: Column | str) -> Column:
    """Binary message key: the author, or a fixed key where there is none."""
    author = F.col(author_id) if isinstance(author_id, str) else author_id
    return F.coalesce(F.nullif(author, F.lit("")), F.lit(KEY_FALLBACK)).cast("binary")
