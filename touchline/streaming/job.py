"""The streaming jobs: enrich, validate and route, ship logs, deduplicate, count."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.functions.hashtags import detect_club, extract_hashtags
from touchline.functions.variants import with_post
from touchline.operators.flatten import flatten_tweets
from touchline.operators.applogs import drop_blank_lines, parse_app_logs, to_log_event
from touchline.operators.posts import enrich_stream
from touchline.operators.validation import (
    audit_union,
    split_unreadable,
    split_valid,
    to_audit_event,
    to_dead_letter,
    validate_tweets,
)
from touchline.session import build_session, scratch_root
from touchline.sinks.messages import MessageTarget, flattened, publish_audit, publish_bronze
from touchline.sinks.slots import slot
from touchline.sinks.tables import StagingTableSink, archive_stream
from touchline.sources.files import read_app_logs
from touchline.sources.logtail import follow_app_logs
from touchline.sources.stream import StreamConfig, config_from_env, read_tweets
from touchline.vocabulary import TOPIC_BRONZE

BatchSink = Callable[[DataFrame, int], None]


def start(
    df: DataFrame, sink: BatchSink, checkpoint: str, trigger: dict[str, str | bool], name: str | None = None
) -> StreamingQuery:
    """Start an append-mode query that hands each micro-batch to ``sink``."""
    writer = df.writeStream.foreachBatch(sink).outputMode("append")
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def run_stream(
    spark: SparkSession, config: StreamConfig, sink: BatchSink, source: DataFrame | None = None
) -> StreamingQuery:
    """Bronze -> enriched rows -> ``sink``.

    Restarting with the same checkpoint continues after the last finished batch.
    """
    raw = source if source is not None else read_tweets(spark, config)
    return start(enrich_stream(raw), sink, config.checkpoint(spark), config.trigger())


class RoutingSink:
    """Per batch: valid posts to bronze, everything else to audit.

    Audit takes rejects, unreadable records, and valid posts that cannot be flattened, so
    each record ends in exactly one of the two topics. The validated batch is cached, so
    the body is parsed once for both writes. A bad record only ever changes its own route.
    """

    def __init__(
        self, target: MessageTarget, body: str = "value", topic: str = TOPIC_BRONZE, run: str | None = None
    ) -> None:
        self._target = target
        self._body = body
        self._topic = topic
        self._run = run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        parsed = with_post(batch_df, self._body)
        validated = validate_tweets(parsed, "post").persist()
        try:
            readable, unreadable = split_unreadable(validated, "post")
            valid, rejected = split_valid(readable)
            messages, unflattened = flattened(valid, "post", raw=self._body)
            publish_bronze(messages, self._target, batch_id, self._run)
            audit = audit_union(
                to_audit_event(rejected, self._body),
                to_audit_event(unflattened, self._body),
                to_dead_letter(unreadable, self._topic, self._body),
            )
            publish_audit(audit, self._target, batch_id, "routing", self._run)
        finally:
            validated.unpersist()


class CounterSink:
    """Per batch: sent and rejected counters as a small table.

    One row per counter and label; summing over runs and batches gives totals that
    survive restarts and retried batches. Sent is what can be flattened and so is written.
    """

    def __init__(self, path: str, body: str = "value", run: str | None = None) -> None:
        self._path = path
        self._body = body
        self._run = run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        readable, _ = split_unreadable(with_post(batch_df, self._body), "post")
        validated = flatten_tweets(validate_tweets(readable, "post"), "post", raw=self._body)
        failed = F.when(F.size("errors") == 0, F.array_compact(F.array("flatten_error"))).otherwise(F.col("errors"))
        validated = validated.withColumn("errors", failed)
        club = detect_club(extract_hashtags("post"))
        sent = F.struct(F.lit("sent").alias("counter"), club.alias("label"))
        rejected = F.transform(
            "errors", lambda e: F.struct(F.lit("rejected").alias("counter"), e.alias("label"))
        )
        increments = F.when(F.size("errors") == 0, F.array(sent)).otherwise(rejected)
        counted = validated.select(F.inline(increments)).groupBy("counter", "label").agg(F.count("*").alias("n"))
        counted.write.mode("overwrite").parquet(f"{self._path}/{slot(batch_df, batch_id, self._run)}")


def stream_metrics(counters: DataFrame) -> DataFrame:
    """Running totals of the counter table."""
    return counters.groupBy("counter", "label").agg(F.sum("n").alias("n"))


def observe_counters(validated: DataFrame, name: str = "posts") -> DataFrame:
    """Attach sent and rejected counts to each micro-batch's progress event."""
    valid = F.size("errors") == 0
    return validated.observe(name, F.count_if(valid).alias("sent"), F.count_if(~valid).alias("rejected"))


class LogSink:
    """Log lines to audit messages."""

    def __init__(self, target: MessageTarget, run: str | None = None) -> None:
        self._target = target
        self._run = run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        events = to_log_event(parse_app_logs(drop_blank_lines(batch_df)))
        publish_audit(events, self._target, batch_id, "logs", self._run)


def stream_dedup(enriched: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First copy of each post to arrive; copies within ``delay`` of it are dropped.

    Time is that of arrival, which is one value per micro-batch and never goes back. So no
    post is ever late, however old it is, and state is kept for ``delay``.
    """
    return enriched.withWatermark("processed_at", delay).dropDuplicatesWithinWatermark(["tweet_id"])


def staging_path(spark: SparkSession, config: StreamConfig) -> str:
    """Folder of the staging table in the folder that the cluster shares."""
    return f"{scratch_root(spark)}/tables/{config.staging_table.replace('.', '/')}"


def run_routing(spark: SparkSession, config: StreamConfig, target: MessageTarget) -> StreamingQuery:
    """Nested posts -> bronze and audit."""
    return start(read_tweets(spark, config), RoutingSink(target), config.checkpoint(spark), config.trigger())


def run_app_logs(spark: SparkSession, config: StreamConfig, target: MessageTarget) -> StreamingQuery:
    """Finished log files below ``source_path`` -> audit."""
    return start(read_app_logs(spark, config.source_path), LogSink(target), config.checkpoint(spark), config.trigger())


def run_log_tail(spark: SparkSession, config: StreamConfig, target: MessageTarget) -> StreamingQuery:
    """Lines appended to ``log_file``, also while it is rotated -> audit."""
    folder, name = os.path.split(config.log_file)
    lines = follow_app_logs(spark, folder, config.log_from_start, pattern=f"{name}*", live=name)
    return start(lines.select("value"), LogSink(target), config.checkpoint(spark), config.trigger())


def run_archive(spark: SparkSession, config: StreamConfig, path: str) -> StreamingQuery:
    """Messages of a topic -> dated NDJSON; those from a folder get the time of their reading."""
    messages = read_tweets(spark, config)
    if "timestamp" not in messages.columns:
        messages = messages.withColumn("timestamp", F.current_timestamp())
    return archive_stream(messages.select("value", "timestamp"), path, config.checkpoint(spark), trigger=config.trigger())


def main(job: str = "enrich") -> int:
    """Run one of the jobs: enrich, route, logs, tail or archive."""
    config = config_from_env(os.environ)
    spark = build_session()
    target = MessageTarget(brokers=config.brokers)
    if job == "enrich":
        query = run_stream(spark, config, StagingTableSink(staging_path(spark, config)))
    elif job == "route":
        query = run_routing(spark, config, target)
    elif job == "logs":
        query = run_app_logs(spark, config, target)
    elif job == "tail":
        query = run_log_tail(spark, config, target)
    elif job == "archive":
        query = run_archive(spark, config, f"{scratch_root(spark)}/archive/{config.topic}")
    else:
        raise ValueError(f"no such job: {job}")
    query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:2]))
