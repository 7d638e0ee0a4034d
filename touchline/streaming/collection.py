"""One collection run: stored responses -> merged posts -> archive, bronze, audit and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.variants import text_of, with_post
from touchline.operators.flatten import flatten_tweets
from touchline.operators.profiles import merge_profiles
from touchline.operators.reports import run_summary
from touchline.operators.search import read_response_pages
from touchline.operators.validation import (
    audit_union,
    readable_post,
    split_unreadable,
    split_valid,
    to_audit_event,
    to_dead_letter,
    validate_tweets,
)
from touchline.schemas import PROFILE_LOOKUP_COLUMNS
from touchline.session import stored
from touchline.sinks.messages import MessageTarget, flattened, publish_audit, publish_bronze
from touchline.sinks.tables import log_failure, write_raw_archive, write_variant_archive
from touchline.vocabulary import MAX_RESULTS_PER_COLLECT, TOPIC_BRONZE


def merged_posts(posts: DataFrame, profiles: DataFrame) -> DataFrame:
    """``posts`` (run_id, rank, post) with the author's profile inside the post itself, as JSON in ``value``.

    A post whose author has a profile gets the eight ``user_*`` members and ``enriched``;
    any other stays as it is.
    """
    keyed = posts.withColumn("author_id", text_of("post", "author_id"))
    merged = merge_profiles(keyed, profiles, spread_by="rank")
    user = [f"user_{c}" for c in PROFILE_LOOKUP_COLUMNS]
    more = F.to_json(F.struct(*user, "enriched"), {"ignoreNullFields": "false"})
    body = F.to_json("post")
    inner = F.substring(body, F.lit(2), F.length(body) - 2)
    joined = F.concat(F.lit("{"), inner, F.when(inner != "", F.lit(",")).otherwise(F.lit("")), F.substring(more, 2, 1 << 30))
    is_object = F.schema_of_variant("post").startswith("OBJECT")
    value = F.when(F.coalesce("enriched", F.lit(False)) & is_object, joined).otherwise(body)
    return merged.select("run_id", "rank", "author_id", "enriched", value.alias("value"))


def run_collection(
    pages: DataFrame,
    profiles: DataFrame,
    target: MessageTarget,
    archive: str,
    run: str,
    batch_id: int = 0,
    failures: DataFrame | None = None,
    cap: int | None = MAX_RESULTS_PER_COLLECT,
    ingested_at: Column | None = None,
    variant_archive: bool = False,
) -> DataFrame:
    """Carry one batch of runs from stored pages to their topics; returns one summary row per run.

    Posts are archived before validation, and a failing archive stops nothing. Valid
    posts go to bronze, all others to audit. ``failures`` (run_id, error) names what went wrong
    while collecting; such a run has a summary with its errors, and a run without posts one of zeros.

    A merged post is parsed and validated once and then stored as VARIANT; archive, topics and summary read that
    table. The archive is NDJSON, or with ``variant_archive`` Parquet with the posts as VARIANT.
    """
    merged = validate_tweets(with_post(merged_posts(read_response_pages(pages, cap), profiles)), "post")
    # Text is only kept where it is not that of an object.
    odd = F.when(~readable_post(F.col("post")), F.col("value"))
    collected = stored(merged.withColumn("value", odd).select("run_id", "author_id", "enriched", "post", "errors", "value"), "collected")
    if variant_archive:
        write_variant_archive(collected, archive, ingested_at, on_error=log_failure)
    else:
        text = F.coalesce("value", F.to_json("post")).alias("value")
        write_raw_archive(collected.select(text), archive, ingested_at, on_error=log_failure, body="value", computed=True)
    readable, unreadable = split_unreadable(collected, "post")
    valid, rejected = split_valid(readable)
    messages, unflattened = flattened(valid, "post")
    # The posts of an author lie together since they met their profile.
    publish_bronze(messages, target, batch_id, run, together=True)
    audit = audit_union(
        to_audit_event(rejected, "post"), to_audit_event(unflattened, "post"), to_dead_letter(unreadable, TOPIC_BRONZE)
    )
    publish_audit(audit, target, batch_id, "collector", run)
    runs = pages.select("run_id", F.lit(None).cast("string").alias("error"))
    if failures is not None:
        runs = runs.unionByName(failures.select("run_id", "error"))
    named = runs.groupBy("run_id").agg(F.array_sort(F.collect_set("error")).alias("errors"))
    return run_summary(flatten_tweets(collected, "post"), runs=named)
