"""Validation with reasons, routing of rejects, and the audit side of the topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import vocabulary as V
from touchline.functions.once import once
from touchline.functions.variants import (
    as_json_text,
    as_variant,
    body_is_text,
    display_text,
    field,
    is_boolean,
    is_list,
    is_number,
    is_object,
    is_string,
    with_post,
)


def _missing(name: str) -> Column:
    return F.lit(V.MSG_MISSING.format(field=name))


def _required(post: Column, names: Sequence[str]) -> list[Column]:
    return [F.when(field(post, n).isNull(), _missing(n)) for n in names]


def _required_metrics(post: Column) -> list[Column]:
    holder = field(post, "public_metrics")
    # Null, number and boolean cannot be searched for a key at all. A holder with a
    # first metric is none of these.
    present = field(post, f"public_metrics.{V.NESTED_METRICS[0]}").isNotNull()
    unsearchable = (
        ~present
        & holder.isNotNull()
        & (F.is_variant_null(holder) | is_number(holder) | is_boolean(holder))
    )
    rules = [F.when(unsearchable, F.lit(V.MSG_NOT_AN_OBJECT.format(field="public_metrics")))]
    for name in V.NESTED_METRICS:
        absent = field(post, f"public_metrics.{name}").isNull() & ~unsearchable
        rules.append(F.when(absent, _missing(f"public_metrics.{name}")))
    return rules


def _language(post: Column, allowed: Sequence[str]) -> list[Column]:
    lang = field(post, "lang")
    accepted = is_string(lang) & F.try_variant_get(lang, "$", "string").isin(list(allowed))
    message = F.concat(
        F.lit(V.MSG_LANG_PREFIX),
        display_text(lang),
        F.lit(V.MSG_LANG_SUFFIX.format(allowed=list(allowed))),
    )
    return [F.when(lang.isNotNull() & ~accepted, message)]


def _counts(post: Column, paths: dict[str, str]) -> list[Column]:
    rules = []
    for name, path in paths.items():
        value = field(post, path)
        comparable = is_number(value) | is_boolean(value)
        negative = F.try_variant_get(value, "$", "double") < 0
        rules.append(
            F.when(value.isNotNull() & ~comparable, F.lit(V.MSG_NOT_A_NUMBER.format(field=name)))
            .when(negative, F.lit(V.MSG_NEGATIVE.format(field=name)))
        )
    return rules


def _must_be_string(post: Column, name: str) -> Column:
    value = field(post, name)
    return F.when(value.isNotNull() & ~is_string(value), F.lit(V.MSG_NOT_A_STRING.format(field=name)))


def _must_be_list(post: Column, path: str, name: str) -> Column:
    value = field(post, path)
    return F.when(value.isNotNull() & ~is_list(value), F.lit(V.MSG_NOT_A_LIST.format(field=name)))


def _nested_rules(post: Column, allowed: Sequence[str]) -> list[Column]:
    entities = field(post, "entities")
    return [
        *_required(post, V.NESTED_REQUIRED),
        *_required_metrics(post),
        *_language(post, allowed),
        *_counts(post, {m: f"public_metrics.{m}" for m in V.NESTED_METRICS}),
        F.when(
            entities.isNotNull() & ~is_object(entities, "hashtags"),
            F.lit(V.MSG_NOT_AN_OBJECT.format(field="entities")),
        ),
        _must_be_list(post, "entities.hashtags", "hashtags"),
        _must_be_string(post, "id"),
    ]


def _flat_rules(post: Column, allowed: Sequence[str]) -> list[Column]:
    return [
        *_required(post, V.FLAT_REQUIRED),
        *_language(post, allowed),
        *_counts(post, {c: c for c in V.FLAT_COUNTERS}),
        _must_be_list(post, "hashtags", "hashtags"),
        _must_be_string(post, "tweet_id"),
    ]


# A key nearly every post has, nested or flat.
_USUAL_KEY = "text"

_PROFILES = {"nested": _nested_rules, "flat": _flat_rules}


def validate_tweets(
    df: DataFrame,
    body: str = "value",
    profile: str = "nested",
    allowed_langs: Sequence[str] = V.ALLOWED_LANGS,
) -> DataFrame:
    """Add ``errors``, the list of reasons against each post (empty when valid).

    ``body`` is JSON text or a VARIANT already parsed by ``with_post``. Bodies that
    are not JSON objects belong in the dead letter (:func:`split_unreadable`); here
    they get a single reason.
    """
    text = body_is_text(df, body)
    staged = with_post(df, body, "_post") if text else df
    post = F.col("_post" if text else body)
    errors = F.array_compact(F.array(*_PROFILES[profile](post, allowed_langs)))
    unreadable = post.isNull() | ~is_object(post, _USUAL_KEY)
    checked = once(
        staged, errors=F.when(unreadable, F.array(F.lit(V.MSG_BODY_NOT_OBJECT))).otherwise(errors)
    )
    return checked.drop("_post")


def is_valid(errors: Column | str = "errors") -> Column:
    return F.size(errors) == 0


def validation_errors(df: DataFrame, id_column: str) -> DataFrame:
    """One row per post and reason, with the reason's position in the list."""
    return df.select(id_column, F.posexplode("errors").alias("position", "reason"))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected posts as two lazy views of one validated input."""
    valid = is_valid("errors")
    return validated.where(valid), validated.where(~valid)


def split_unreadable(df: DataFrame, body: str = "value") -> tuple[DataFrame, DataFrame]:
    """Readable JSON objects, and everything else."""
    readable = readable_post(as_variant(df, body))
    return df.where(readable), df.where(~readable)


def readable_post(post: Column) -> Column:
    return F.coalesce(is_object(post, _USUAL_KEY), F.lit(False))


def audit_header(kind: str) -> Column:
    return F.array(
        F.struct(F.lit(V.AUDIT_HEADER).alias("key"), F.lit(kind).cast("binary").alias("value"))
    )


def to_audit_event(rejects: DataFrame, body: str = "value") -> DataFrame:
    """Rejected posts as audit messages ``(key, value, headers)``.

    The post is embedded as it came; its text is already known to be JSON.
    """
    head = F.to_json(
        F.struct(
            F.lit(V.EVENT_VALIDATION).alias("type"),
            F.lit(V.AUDIT_SOURCE).alias("source"),
            F.col("errors"),
        )
    )
    value = F.concat(
        F.rtrim(head, F.lit("}")), F.lit(',"raw_tweet":'), as_json_text(rejects, body), F.lit("}")
    )
    return rejects.select(
        F.lit(V.AUDIT_VALIDATION).cast("binary").alias("key"),
        value.alias("value"),
        audit_header(V.AUDIT_VALIDATION).alias("headers"),
    )


def to_dead_letter(unreadable: DataFrame, topic: str, body: str = "value", reason: str | None = None) -> DataFrame:
    """Unreadable records as audit messages carrying their context in headers."""
    context = {
        "topic": topic,
        "connector.name": "archive",
        "exception.message": reason or V.MSG_BODY_NOT_OBJECT,
    }
    headers = F.array(
        *[
            F.struct(
                F.lit(V.DEAD_LETTER_HEADER_PREFIX + name).alias("key"),
                F.lit(text).cast("binary").alias("value"),
            )
            for name, text in context.items()
        ]
    )
    return unreadable.select(
        F.lit(None).cast("binary").alias("key"),
        F.col(body).cast("string").alias("value"),
        headers.alias("headers"),
    )


def audit_category(headers: Column | str = "headers") -> Column:
    """Which producer wrote an audit message, from its headers alone."""

    def typed(kind: str) -> Column:
        return F.exists(
            headers,
            lambda h: (h["key"] == V.AUDIT_HEADER) & (h["value"].cast("string") == kind),
        )

    dead = F.exists(headers, lambda h: h["key"].startswith(V.DEAD_LETTER_HEADER_PREFIX))
    return (
        F.when(typed(V.AUDIT_VALIDATION), F.lit(V.AUDIT_VALIDATION))
        .when(typed(V.AUDIT_APP_LOG), F.lit(V.AUDIT_APP_LOG))
        .when(dead, F.lit("dead_letter"))
        .otherwise(F.lit("unknown"))
    )


def route_audit(messages: DataFrame) -> DataFrame:
    return messages.withColumn("category", audit_category("headers"))


def audit_union(*parts: DataFrame) -> DataFrame:
    """Messages of several producers as one audit stream; missing columns are null."""
    first, *others = parts
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
