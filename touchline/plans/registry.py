"""Named queries: each operator applied to inputs derived from the given tables.

Every query maps ``(spark, sf_dir)`` to a DataFrame over whole tables. Arrays are
joined, times formatted and money widened so that results compare across engines.
Sinks and streams write below the session's shared scratch folder and the query
reads back what they wrote.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from touchline.functions import hashtags as H
from touchline.functions import text as X
from touchline.functions.variants import text_of, with_post
from touchline.operators import alerts, applogs, asof, costs, dedup, flatten, profiles, reports, search, sketches, statements
from touchline.operators import posts as P
from touchline.operators import validation as val
from touchline.operators.statements import register_staging
from touchline.plans import inputs
from touchline.session import scratch_path, stored
from touchline.sinks import messages as msg
from touchline.sinks import tables as tab
from touchline.sinks.keyed import KeyedTable
from touchline.sources.files import read_app_logs, read_profiles, read_raw_archive, read_variant_archive
from touchline.sources.logtail import follow_app_logs, local_path
from touchline.sources.stream import StreamConfig, config_from_env, read_tweets, source_options
from touchline.streaming import alerting, collection, job
from touchline.vocabulary import MAX_RESULTS_PER_COLLECT, TOPIC_AUDIT, TOPIC_BRONZE, TOPIC_SILVER

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_NOW = {"availableNow": True}


def _register(fn: Query) -> Query:
    _QUERIES[fn.__name__.removeprefix("query_")] = fn
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared shapes -----------------------------------------------------------


def _time(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss").alias(column)


def _joined(column: str, sep: str = ",") -> Column:
    return F.array_join(column, sep).alias(column)


def _staging_view(staging: DataFrame) -> DataFrame:
    """The staging row without its processing time."""
    return staging.select(
        "tweet_id", "author_id", "lang", F.md5("text").alias("text_md5"), _joined("hashtags"),
        "like_count", "retweet_count", "engagement", _joined("themes"), _time("created_at"),
    )


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.to_staging(inputs.flat_messages(spark, sf_dir))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable nested posts, parsed once into ``post``, with their errors."""
    readable, _ = val.split_unreadable(with_post(inputs.nested_messages(spark, sf_dir)), "post")
    return val.validate_tweets(readable, "post")


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiles.normalize_profiles(inputs.profile_messages(spark, sf_dir), keep=("version",))
    return profiles.last_profile(rows, "version").drop("version")


def _decoded(column: str, *names: str) -> list[Column]:
    """Members of a JSON text column as strings."""
    return [F.get_json_object(column, f"$.{n}").alias(n) for n in names]


def _folder_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream; works for a single file and for a folder."""
    schema = inputs.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def _as_files(spark: SparkSession, df: DataFrame, name: str, files: int | None = None) -> str:
    """Write a one-column frame as text files into scratch."""
    path = scratch_path(spark, name)
    (df.repartition(files) if files else df).write.text(path)
    return path


def _replay(spark: SparkSession, sf_dir: str, sink: Callable[[DataFrame, int], None]) -> None:
    """Flat messages from NDJSON files through the enrichment job into ``sink``."""
    source = _as_files(spark, inputs.flat_messages(spark, sf_dir).select("value"), "bronze")
    config = StreamConfig(
        source_path=source,
        trigger_interval="availableNow",
        checkpoint_location=scratch_path(spark, "checkpoint"),
    )
    job.run_stream(spark, config, sink).awaitTermination()


def _drain(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to the end of its input, one table partition per micro-batch."""
    out = scratch_path(spark, name)
    job.start(
        stream, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch_id={n}"),
        scratch_path(spark, "checkpoint"), _NOW,
    ).awaitTermination()
    return spark.read.parquet(out)


# --- sources -----------------------------------------------------------------


@_register
def query_read_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _as_files(spark, inputs.flat_messages(spark, sf_dir).select("value"), "bronze")
    read = _drain(spark, read_tweets(spark, StreamConfig(source_path=path)), "read-tweets")
    return read.select(*_decoded("value", "tweet_id", "author_id", "retweet_count"))


def _in_waves(spark: SparkSession, df: DataFrame, waves: list[str]) -> str:
    """Write ``value`` of the rows of each condition, one folder after the other; returns a pattern over all files."""
    path = scratch_path(spark, "waves")
    for n, condition in enumerate(waves):
        df.where(condition).select("value").write.text(f"{path}/{n}")
    return f"{path}/*"


_WAVES = ["doc_id % 4 = 0", "doc_id % 4 <= 1", "doc_id % 4 IN (1, 2)", "doc_id % 4 >= 2", "doc_id % 4 IN (0, 3)"]


@_register
def max_per_trigger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At one file per micro-batch: the most files that any batch saw, whether there were several, and rows read."""
    path = _in_waves(spark, inputs.flat_messages(spark, sf_dir), [f"doc_id % 3 = {i}" for i in range(3)])
    stream = read_tweets(spark, StreamConfig(source_path=path, max_offsets_per_trigger=1))
    read = _drain(spark, stream.withColumn("file", F.input_file_name()), "max-per-trigger")
    per_batch = read.groupBy("batch_id").agg(F.count_distinct("file").alias("files"), F.count("*").alias("n"))
    return per_batch.agg(
        F.max("files").alias("files"), (F.count("*") >= 3).alias("several"), F.sum("n").alias("n")
    )


@_register
def starting_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job configured from the environment reads its source from the start, one file per batch."""
    path = _in_waves(spark, inputs.flat_messages(spark, sf_dir), [f"doc_id % 3 = {i}" for i in range(3)])
    config = config_from_env({"SOURCE_PATH": path, "STARTING_OFFSETS": "earliest", "MAX_OFFSETS_PER_TRIGGER": "1"})
    read = _drain(spark, read_tweets(spark, config), "configured")
    options = F.lit(source_options(replace(config, source_path=None))["startingOffsets"])
    return read.agg(F.count("*").alias("n"), (F.max("batch_id") >= 2).alias("several")).withColumn("start", options)


@_register
def stream_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment job with source, trigger and checkpoint from the environment."""
    source = _as_files(spark, inputs.flat_messages(spark, sf_dir).select("value"), "bronze")
    config = config_from_env(
        {"SOURCE_PATH": source, "TRIGGER_INTERVAL": "availableNow", "CHECKPOINT_LOCATION": scratch_path(spark, "checkpoint")}
    )
    path = scratch_path(spark, "staging")
    job.run_stream(spark, config, tab.StagingTableSink(path)).awaitTermination()
    return tab.read_staging(spark, path).select("tweet_id", "engagement")


@_register
def utc_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of posts as text, though the caller's session was in another zone."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    return P.parse_created_at(inputs.posts(spark, sf_dir)).select("tweet_id", _time("created_at"))


@_register
def read_response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As a collection reads them, up to its published limit."""
    found = search.read_response_pages(inputs.response_pages(spark, sf_dir), cap=MAX_RESULTS_PER_COLLECT)
    return search.post_fields(found).withColumn("text", F.md5("text"))


@_register
def read_response_pages_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses without a limit."""
    found = search.read_response_pages(inputs.response_pages(spark, sf_dir))
    return search.post_fields(found).withColumn("text", F.md5("text"))


@_register
def read_response_pages_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored responses without a limit, of many runs and one long one that reach nearly every document."""
    found = search.read_response_pages(inputs.response_pages_many(spark, sf_dir))
    return search.post_fields(found).withColumn("text", F.md5("text"))


@_register
def page_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = search.page_prefix(inputs.response_pages(spark, sf_dir), cap=MAX_RESULTS_PER_COLLECT)
    return kept.select("run_id", "page", "n_items", "n_before")


@_register
def query_read_app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _as_files(spark, inputs.log_lines(spark, sf_dir).select("value"), "logs")
    return _drain(spark, read_app_logs(spark, path), "read-logs").select(F.col("value").alias("line"))


@_register
def query_follow_app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log files that grow in three waves and are rotated in between, followed by a query that starts anew for each."""
    folder = local_path(scratch_path(spark, "growing"))
    out, checkpoint = scratch_path(spark, "followed"), scratch_path(spark, "checkpoint")
    lines = inputs.log_lines(spark, sf_dir)
    for wave in range(3):
        inputs.append_lines(lines.where(f"event_id % 3 = {wave}"), folder, wave)
        if wave == 1:
            for name in os.listdir(folder):
                os.rename(f"{folder}/{name}", f"{folder}/{name}.1")
        job.start(
            follow_app_logs(spark, folder), lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch_id={n}"),
            checkpoint, _NOW,
        ).awaitTermination()
    return spark.read.schema("value string").parquet(out).select(F.col("value").alias("line"))


def _archived(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "archive")
    rows = inputs.posts(spark, sf_dir).drop("doc_id", "source")
    moment = F.coalesce(F.try_to_timestamp("created_at"), F.lit("2024-02-01").cast("timestamp"))
    written, given = tab.write_raw_archive(rows, path, moment), rows.count()
    if written != given:
        raise ValueError(f"{written} of {given} rows archived")
    return path


_ARCHIVED = StructType([StructField("tweet_id", StringType()), StructField("retweet_count", LongType())])


@_register
def query_read_raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One archived month, read through partition pruning."""
    archive = read_raw_archive(spark, _archived(spark, sf_dir), _ARCHIVED)
    return archive.where("year = '2024' AND month = '01'")


@_register
def query_read_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _as_files(spark, inputs.profile_messages(spark, sf_dir).select("value"), "profiles")
    return read_profiles(spark, path).select("user_id", "username", "followers_count", "verified")


# --- sinks -------------------------------------------------------------------


@_register
def staging_table_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch delivered twice, as after a failed commit: rows appear once."""
    path = scratch_path(spark, "staging")
    sink = tab.StagingTableSink(path, "query")
    batch = _staging(spark, sf_dir)
    sink(batch, 0)
    sink(batch, 0)
    return _staging_view(tab.read_staging(spark, path))


@_register
def staging_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the posts through two checkpoints in several batches; the last batch once more."""
    path, posts = scratch_path(spark, "staging"), inputs.flat_messages(spark, sf_dir)
    for half in (0, 1):
        source = _in_waves(spark, posts.where(f"doc_id % 2 = {half}"), [f"doc_id % 3 = {i}" for i in range(3)])
        config = StreamConfig(
            source_path=source, trigger_interval="availableNow", max_offsets_per_trigger=1,
            checkpoint_location=scratch_path(spark, "checkpoint"),
        )
        sink = tab.StagingTableSink(path)

        def twice(batch: DataFrame, n: int, sink: tab.StagingTableSink = sink) -> None:
            sink(batch, n)
            sink(batch, n)

        job.run_stream(spark, config, twice).awaitTermination()
    return _staging_view(tab.read_staging(spark, path))


@_register
def compact_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging copied into few files per date, twice over."""
    path, into = scratch_path(spark, "staging"), scratch_path(spark, "compact")
    sink, batch = tab.StagingTableSink(path, "query"), _staging(spark, sf_dir)
    for n in range(2):
        sink(batch.where(f"pmod(hash(tweet_id), 2) = {n}"), n)
    for _ in range(2):
        tab.compact_staging(spark, path, into, before="9999-01-01")
    return _staging_view(tab.read_staging(spark, into))


def _sql_view(spark: SparkSession, sf_dir: str) -> str:
    """Staging as two runs wrote it, the second one a third of the posts again, known to SQL."""
    path, posts = scratch_path(spark, "staging"), inputs.flat_messages(spark, sf_dir)
    tab.StagingTableSink(path, "first")(P.to_staging(posts), 0)
    tab.StagingTableSink(path, "second")(P.to_staging(posts.where("doc_id % 3 = 0")), 0)
    return register_staging(spark, path, f"staging_{uuid.uuid4().hex}")


@_register
def sql_top_engaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = spark.sql(statements.TOP_ENGAGED.format(table=_sql_view(spark, sf_dir)))
    return top.select("tweet_id", "engagement", _joined("themes"), _joined("hashtags"), _time("created_at"))


@_register
def sql_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(statements.TOTAL.format(table=_sql_view(spark, sf_dir)))


@_register
def sql_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(statements.THEMES.format(table=_sql_view(spark, sf_dir)))


@_register
def sql_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(statements.DUPLICATES.format(table=_sql_view(spark, sf_dir)))


_SILVER_FIELDS = ("tweet_id", "engagement", "author_id", "created_at", "retweet_count")


@_register
def silver_publisher(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    msg.SilverPublisher(target, run="query")(_staging(spark, sf_dir), 0)
    published = target.read(spark, TOPIC_SILVER)
    return published.select(F.col("key").cast("string").alias("key"), *_decoded("value", *_SILVER_FIELDS))


@_register
def dual_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One streamed batch into the silver topic and the staging table."""
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    path = scratch_path(spark, "staging")
    _replay(spark, sf_dir, tab.DualSink(msg.SilverPublisher(target), tab.StagingTableSink(path)))
    silver = target.read(spark, TOPIC_SILVER).select(F.lit("silver").alias("sink"), F.col("key").cast("string").alias("tweet_id"))
    staging = tab.read_staging(spark, path).select(F.lit("staging").alias("sink"), "tweet_id")
    return silver.unionByName(staging)


@_register
def write_raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_raw_archive(spark, _archived(spark, sf_dir), _ARCHIVED)


@_register
def archive_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tab.archive_counts(read_raw_archive(spark, _archived(spark, sf_dir), _ARCHIVED))


@_register
def archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages, archived by their day in Europe/Paris."""
    events = _folder_stream(spark, sf_dir, "events")
    stream = events.select(
        F.to_json(F.struct("event_id", "user_id")).alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )
    path = scratch_path(spark, "archive-stream")
    tab.archive_stream(
        stream, path, scratch_path(spark, "checkpoint"), trigger=_NOW
    ).awaitTermination()
    schema = StructType([StructField("event_id", LongType()), StructField("user_id", LongType())])
    return read_raw_archive(spark, path, schema)


@_register
def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, unreadable = val.split_unreadable(inputs.nested_messages(spark, sf_dir))
    letters = val.to_dead_letter(unreadable, TOPIC_BRONZE)
    return letters.select(
        "value",
        F.array_join(F.transform("headers", lambda h: F.concat(h["key"], F.lit("="), h["value"].cast("string"))), ";").alias("headers"),
    )


@_register
def publish_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    valid, _ = val.split_valid(_validated(spark, sf_dir))
    messages, _ = msg.flattened(valid, "post", raw="value")
    msg.publish_bronze(messages, target, 0, run="query")
    return target.read(spark, TOPIC_BRONZE).select(
        F.col("key").cast("string").alias("key"),
        *_decoded("value", "tweet_id", "lang", "like_count", "retweet_count", "created_at"),
        F.get_json_object("value", "$.raw_payload.id").alias("raw_id"),
    )


@_register
def publish_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    _, rejected = val.split_valid(_validated(spark, sf_dir))
    msg.publish_audit(val.to_audit_event(rejected), target, 0, "collector", run="query")
    return target.read(spark, TOPIC_AUDIT).select(
        F.col("key").cast("string").alias("key"),
        F.get("headers", F.lit(0))["value"].cast("string").alias("audit_type"),
        *_decoded("value", "type", "source"),
        F.get_json_object("value", "$.raw_tweet.id").alias("raw_id"),
        F.array_join(F.from_json(F.get_json_object("value", "$.errors"), "array<string>"), "|").alias("errors"),
    )


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = flatten.flatten_tweets(_validated(spark, sf_dir), "post", raw="value")
    keyed = validated.select(
        "run_id", "doc_id", "errors", "flatten_error", text_of("post", "author_id").alias("author_id")
    )
    merged = profiles.merge_profiles(keyed, _profiles(spark, sf_dir), spread_by="doc_id")
    return reports.run_summary(merged)


_SUMMARY_COLUMNS = [
    "run_id", "success", "tweets_fetched", "users_enriched", "tweets_enriched", "tweets_valid",
    "tweets_invalid", "tweets_sent_to_kafka", "author_ids_found",
]


@_register
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    money = [F.col(c).cast("double").alias(c) for c in ("api_cost_estimate", "remaining_budget")]
    return _summary(spark, sf_dir).select(*_SUMMARY_COLUMNS, *money)


@_register
def write_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "summary")
    tab.write_run_summary(_summary(spark, sf_dir), path, {"keywords": "Ligue1"})
    schema = "run_id string, tweets_fetched long, tweets_valid long, api_cost_estimate double, arg_keywords string"
    return spark.read.schema(schema).json(path)


# --- parsing and enrichment ----------------------------------------------------


@_register
def parse_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message, unreadable ones as all-null rows."""
    parsed = P.parse_tweets(inputs.flat_messages(spark, sf_dir))
    return parsed.withColumn("text", F.md5("text")).withColumn("hashtags", F.array_join("hashtags", ","))


@_register
def parse_tweets_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = P.parse_tweets(inputs.flat_messages(spark, sf_dir), coerce_counters=True)
    return P.with_engagement(P.drop_unparseable(parsed)).select("tweet_id", "like_count", "retweet_count", "engagement")


@_register
def drop_unparseable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.drop_unparseable(P.parse_tweets(inputs.flat_messages(spark, sf_dir))).select("tweet_id", "lang")


@_register
def with_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.with_engagement(inputs.posts(spark, sf_dir)).select("tweet_id", "like_count", "retweet_count", "engagement")


@_register
def with_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.with_themes(inputs.posts(spark, sf_dir)).select("tweet_id", _joined("themes"))


@_register
def tag_themes_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    themes = X.tag_themes_udf()("text", "hashtags").alias("themes")
    return inputs.posts(spark, sf_dir).select("tweet_id", themes).select("tweet_id", _joined("themes"))


@_register
def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.enrich(inputs.posts(spark, sf_dir)).select("tweet_id", "author_id", "engagement", _joined("themes"))


@_register
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    normal = X.normalize_text("text")
    return inputs.posts(spark, sf_dir).select("tweet_id", F.md5(normal).alias("normal_md5"), F.length(normal).alias("n"))


@_register
def match_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that mention any of a few words as whole words."""
    matched = X.match_keywords(X.normalize_text("text"), X.hashtag_text("hashtags"), ["les", "the", "Hors jeu"])
    return inputs.posts(spark, sf_dir).select("tweet_id", matched.alias("matched"))


@_register
def parse_created_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.parse_created_at(inputs.posts(spark, sf_dir)).select("tweet_id", _time("created_at"))


@_register
def with_processed_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts per processing stamp: the stamp is one value for the whole input."""
    stamped = P.with_processed_at(inputs.posts(spark, sf_dir))
    return stamped.groupBy("processed_at").agg(F.count("*").alias("n")).select("n")


@_register
def to_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staging_view(_staging(spark, sf_dir))


@_register
def to_kafka_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    framed = P.to_kafka_frame(_staging(spark, sf_dir))
    return framed.select("key", *_decoded("value", *_SILVER_FIELDS))


@_register
def flatten_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten.flatten_tweets(inputs.nested_messages(spark, sf_dir))
    names = ("tweet_id", "created_at", "author_id", "lang", "like_count", "retweet_count")
    tags = F.from_json(F.get_json_object("flat", "$.hashtags"), "array<string>")
    return flat.select(
        "doc_id", "flatten_error", *_decoded("flat", *names),
        F.md5(F.get_json_object("flat", "$.text")).alias("text_md5"), F.array_join(tags, ",").alias("hashtags"),
    )


@_register
def decode_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.flat_messages(spark, sf_dir).withColumn("value", F.col("value").cast("binary"))
    decoded = flatten.decode_flat(messages)
    return decoded.select("doc_id", text_of("post", "tweet_id").alias("tweet_id"), text_of("post", "like_count").alias("like_count"))


@_register
def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.posts(spark, sf_dir).select("tweet_id", H.partition_key("author_id").cast("string").alias("key"))


@_register
def extract_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = inputs.nested_messages(spark, sf_dir)
    return with_post(nested).select("doc_id", F.array_join(H.extract_hashtags("post"), ",").alias("hashtags"))


@_register
def detect_club(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.posts(spark, sf_dir).select("tweet_id", H.detect_club("hashtags").alias("club"))


# --- validation and audit --------------------------------------------------------


@_register
def validate_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select("doc_id", _joined("errors", "|"), val.is_valid().alias("is_valid"))


@_register
def validate_flat_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = val.validate_tweets(inputs.flat_objects(spark, sf_dir), profile="flat")
    return checked.select("doc_id", _joined("errors", "|"))


@_register
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.validation_errors(_validated(spark, sf_dir), "doc_id")


@_register
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = val.split_valid(_validated(spark, sf_dir))
    return valid.select("doc_id", F.lit("bronze").alias("route")).unionByName(
        rejected.select("doc_id", F.lit("audit").alias("route"))
    )


@_register
def to_audit_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = val.split_valid(_validated(spark, sf_dir))
    return val.to_audit_event(rejected).select(
        F.col("key").cast("string").alias("key"),
        *_decoded("value", "type", "source"),
        F.get_json_object("value", "$.raw_tweet.id").alias("raw_id"),
        F.get_json_object("value", "$.raw_tweet.lang").alias("raw_lang"),
    )


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit messages of all three producers."""
    readable, unreadable = val.split_unreadable(with_post(inputs.nested_messages(spark, sf_dir)), "post")
    _, rejected = val.split_valid(val.validate_tweets(readable, "post"))
    lines = applogs.drop_blank_lines(inputs.log_lines(spark, sf_dir))
    return val.audit_union(
        val.to_audit_event(rejected),
        val.to_dead_letter(unreadable, TOPIC_BRONZE),
        applogs.to_log_event(applogs.parse_app_logs(lines)),
    )


@_register
def audit_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per key and event type after the union."""
    kinds = _audit(spark, sf_dir).select(F.col("key").cast("string").alias("key"), F.get_json_object("value", "$.type").alias("type"))
    return kinds.groupBy("key", "type").agg(F.count("*").alias("n"))


@_register
def route_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return val.route_audit(_audit(spark, sf_dir)).groupBy("category").agg(F.count("*").alias("n"))


@_register
def parse_app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines as events; the time of an unparsed line is the present, so not shown."""
    parsed = applogs.parse_app_logs(applogs.drop_blank_lines(inputs.log_lines(spark, sf_dir)))
    known = F.col("level") != "UNPARSED"
    return parsed.select(
        "event_id", "type", F.when(known, F.col("ts")).alias("ts"), "level", "logger", "message",
        F.when(known, F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).alias("event_time"),
    )


@_register
def drop_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applogs.drop_blank_lines(inputs.log_lines(spark, sf_dir)).select("event_id", F.col("value").alias("line"))


@_register
def audit_by_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applogs.audit_by_level(applogs.parse_app_logs(applogs.drop_blank_lines(inputs.log_lines(spark, sf_dir))))


# --- profiles, search, cost ------------------------------------------------------


@_register
def normalize_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.normalize_profiles(inputs.profile_messages(spark, sf_dir), keep=("version",))


@_register
def merge_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tweets = inputs.posts(spark, sf_dir).select("doc_id", "author_id")
    merged = profiles.merge_profiles(tweets, _profiles(spark, sf_dir), spread_by="doc_id")
    return merged.select(
        "doc_id", "author_id", "user_username", "user_followers_count", "user_verified", "user_description", "enriched"
    )


@_register
def merge_profiles_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each post with the profile its author had when it was written."""
    tweets = inputs.posts(spark, sf_dir).select("doc_id", "author_id", F.try_to_timestamp("created_at").alias("created"))
    merged = asof.merge_profiles_as_of(tweets, inputs.profile_versions(spark, sf_dir), "created", order=["doc_id"], tie=["version"])
    return merged.select("doc_id", "author_id", "user_username", "user_followers_count", "user_verified", "enriched")


@_register
def matched_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.matched_authors(inputs.posts(spark, sf_dir), _profiles(spark, sf_dir))


@_register
def unmatched_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.unmatched_authors(inputs.posts(spark, sf_dir), _profiles(spark, sf_dir))


@_register
def distinct_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.distinct_authors(inputs.posts(spark, sf_dir))


@_register
def count_distinct_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.count_distinct_authors(inputs.posts(spark, sf_dir))


@_register
def distinct_usernames(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = inputs.posts(spark, sf_dir).selectExpr(
        "doc_id", "CASE WHEN doc_id % 4 = 0 THEN '' ELSE author_id END AS author_username", "source AS username"
    )
    return profiles.distinct_usernames(named, "doc_id")


@_register
def profile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.profile_stats(inputs.posts(spark, sf_dir), _profiles(spark, sf_dir))


@_register
def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = search.SearchConfig(
        keywords="les OR décision var OR Analyse Vidéo", lang="fr", min_retweets=3,
        start_time="2024-01-03T00:00:00Z", end_time="2024-01-25T00:00:00Z",
    )
    tweets = P.parse_created_at(inputs.posts(spark, sf_dir))
    return search.search_filter(tweets, config).select("tweet_id", "lang", "retweet_count", _time("created_at"))


@_register
def search_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An explicit query replaces keywords and their filters; language still applies."""
    config = search.SearchConfig(
        query="the OR is", where=search.mentions("the", "is"), lang="en", min_retweets=30, max_results=999, ceiling=MAX_RESULTS_PER_COLLECT
    )
    found = search.search_filter(P.parse_created_at(inputs.posts(spark, sf_dir)), config)
    return search.cap_results(found, "source", ["doc_id"], config.max_results).select("source", "tweet_id")


@_register
def search_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword search, the query it stands for as a filter in Spark SQL over marked posts, and one built from Columns."""
    tweets = P.parse_created_at(inputs.posts(spark, sf_dir))
    keywords = search.SearchConfig(keywords='les OR "décision var" OR the', min_retweets=3)
    queries = {
        "keywords": keywords,
        "explicit": search.SearchConfig(query=keywords.query, where="named AND retweet_count >= 3 AND NOT startswith(text, 'RT @')"),
        "all": search.SearchConfig(
            query='(les OR (the -is)) -lang:de min_retweets:2 -"analyse vidéo"',
            where=(search.mentions("les") | (search.mentions("the") & ~search.mentions("is")))
            & (F.col("lang") != "de") & (F.col("retweet_count") >= 2) & ~search.mentions("analyse vidéo"),
        ),
    }
    marked = tweets.withColumn("named", search.mentions(*keywords.terms))
    parts = [
        search.search_filter(marked, q).select(F.lit(name).alias("query"), "tweet_id") for name, q in queries.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_register
def cap_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    order = ["l_orderkey", "l_linenumber", "l_partkey"]
    return search.cap_results(lines, "l_suppkey", order, 250)


@_register
def with_api_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    costed = costs.with_api_cost(inputs.collection_runs(spark, sf_dir), budget="1.000")
    money = [F.col(c).cast("double").alias(c) for c in ("api_cost", "remaining_budget")]
    return costed.select("run_id", "tweets_fetched", *money, "remaining_tweets", "remaining_collections")


@_register
def budget_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    costed = costs.with_api_cost(inputs.collection_runs(spark, sf_dir), budget="1.000")
    return costed.select("run_id", costs.budget_status("api_cost", "1.000").alias("status"))


@_register
def cumulative_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = costs.cumulative_cost(inputs.collection_runs(spark, sf_dir))
    return total.select(
        "account", "run_id", "cumulative_tweets", F.col("cumulative_cost").cast("double").alias("cumulative_cost"), "status"
    )


# --- reports ---------------------------------------------------------------------


@_register
def top_engaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = reports.top_engaged(_staging(spark, sf_dir))
    return top.select("tweet_id", "engagement", _joined("themes"), _joined("hashtags"), _time("created_at"))


@_register
def staging_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging keeps one row per readable message, so those are counted, without enriching them."""
    return reports.staging_total(P.drop_unparseable(P.parse_tweets(inputs.flat_messages(spark, sf_dir))))


@_register
def theme_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.theme_counts(_staging(spark, sf_dir))


@_register
def duplicate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.duplicate_ids(inputs.copies(spark, sf_dir))


@_register
def ordered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.ordered_counts(inputs.table(spark, sf_dir, "lineitem"), "l_suppkey")


@_register
def valid_invalid_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.valid_invalid_counts(_validated(spark, sf_dir))


@_register
def rejects_by_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rejects_by_reason(_validated(spark, sf_dir))


@_register
def sent_by_club(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = val.split_valid(_validated(spark, sf_dir))
    return reports.sent_by_club(valid, H.extract_hashtags("post"))


@_register
def delivery_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.delivery_failures(_audit(spark, sf_dir))


@_register
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = inputs.table(spark, sf_dir, "events").select((F.col("value") / 100).alias("seconds"))
    histogram = reports.latency_histogram(seconds, "seconds")
    return histogram.select("le", "n", "count", F.round("sum", 2).alias("sum"))


@_register
def authors_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different authors of each year, merged from one sketch per day, and whether they are within four standard errors."""
    rows = inputs.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("author_id"), F.col("o_orderdate").cast("date").alias("day"))
    days = sketches.author_sketches(rows, F.col("day")).withColumn("year", F.year("day"))
    found = sketches.authors_between(days, by=["year"])
    exact = rows.groupBy(F.year("day").alias("year")).agg(F.count_distinct("author_id").alias("exact"))
    near = F.abs(F.col("authors") - F.col("exact")) <= 4 * sketches.DISTINCT_ERROR * F.col("exact") + 1
    return found.join(exact, "year").select("year", "posts", "exact", near.alias("within"))


@_register
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latency quantiles per topic, merged from one sketch per hour, and whether each has the rank it should have."""
    events = inputs.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("topic"), (F.col("value") / 100).alias("seconds"))
    hours = sketches.latency_sketches(events, "seconds", "ts", ["topic"])
    found = stored(sketches.latency_quantiles(hours, ["topic"]).withColumnRenamed("seconds", "quantile"), "quantiles")
    # Three rows per topic.
    ranks = events.join(F.broadcast(found), "topic").groupBy("topic", "n", "share").agg(
        F.count_if(F.col("seconds") < F.col("quantile")).alias("below"), F.count_if(F.col("seconds") <= F.col("quantile")).alias("upto")
    )
    low, high = (F.col("share") + e * sketches.RANK_ERROR for e in (1, -1))
    within = (F.col("below") / F.col("n") <= low) & (F.col("upto") / F.col("n") >= high)
    return ranks.select("topic", F.col("n"), "share", within.alias("within"))


@_register
def heavy_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of more than a fiftieth of the posts: counters of three batches give the candidates, a second pass their counts."""
    posts = inputs.posts(spark, sf_dir)
    waves = scratch_path(spark, "waves")
    sink = sketches.KeySummarySink(scratch_path(spark, "keys"), "author_id", share=0.02)
    checkpoint = scratch_path(spark, "checkpoint")
    for n in range(3):
        posts.where(f"doc_id % 3 = {n}").select("author_id").write.parquet(f"{waves}/{n}")
        stream = spark.readStream.schema("author_id string").parquet(f"{waves}/*")
        job.start(stream, sink, checkpoint, _NOW).awaitTermination()
    return sketches.heavy_hitters(posts, "author_id", 0.02, sink.read(spark))


# --- windows, alerts, retention ----------------------------------------------------


@_register
def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = dedup.latest_by_key(inputs.copies(spark, sf_dir), order=("processed_at", "doc_id"))
    return latest.select("tweet_id", "doc_id", "retweet_count", _time("processed_at"))


def _alert_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [replace(r, enabled=True) for r in alerts.RULES]
    return alerts.alert_states(inputs.metric_samples(spark, sf_dir), rules, max_gap_seconds=120)


@_register
def alert_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_states(spark, sf_dir).select("alertname", "severity", "series", _time("ts"), "state")


@_register
def controllers_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.controllers_active(inputs.metric_samples(spark, sf_dir)).select(_time("ts"), "active", "breached")


@_register
def group_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = alerts.group_alerts(_alert_states(spark, sf_dir))
    return grouped.select("alertname", "severity", "repeat", _time("notified_at"), "samples", "receiver")


@_register
def apply_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))
    bronze = dedup.apply_retention(events, TOPIC_BRONZE).select("event_id", F.lit(TOPIC_BRONZE).alias("topic"))
    audit = dedup.apply_retention(events, TOPIC_AUDIT).select("event_id", F.lit(TOPIC_AUDIT).alias("topic"))
    return bronze.unionByName(audit)


# --- streams -----------------------------------------------------------------------


@_register
def run_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "staging")
    _replay(spark, sf_dir, tab.StagingTableSink(path))
    return _staging_view(tab.read_staging(spark, path))


@_register
def durable_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same checkpoint: the second finds nothing left to do."""
    source = _as_files(spark, inputs.flat_messages(spark, sf_dir).select("value"), "bronze")
    path = scratch_path(spark, "staging")
    config = StreamConfig(
        source_path=source, trigger_interval="availableNow", checkpoint_location=scratch_path(spark, "checkpoint")
    )
    for _ in range(2):
        job.run_stream(spark, config, tab.StagingTableSink(path)).awaitTermination()
    return reports.staging_total(tab.read_staging(spark, path))


def _in_batches(spark: SparkSession, rows: DataFrame) -> StreamConfig:
    """A job over the rows in at least three micro-batches."""
    return StreamConfig(
        source_path=_in_waves(spark, rows, [f"doc_id % 3 = {i}" for i in range(3)]),
        max_offsets_per_trigger=1,
        trigger_interval="availableNow",
        checkpoint_location=scratch_path(spark, "checkpoint"),
    )


@_register
def audit_three_producers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects and dead letters of two routing jobs, and log lines, in one audit folder."""
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    nested = inputs.nested_messages(spark, sf_dir)
    for half in (0, 1):
        job.run_routing(spark, _in_batches(spark, nested.where(f"doc_id % 2 = {half}")), target).awaitTermination()
    lines = inputs.log_lines(spark, sf_dir).withColumnRenamed("event_id", "doc_id")
    job.run_app_logs(spark, _in_batches(spark, lines), target).awaitTermination()
    return _by_category(spark, target)


def _collected(
    spark: SparkSession, sf_dir: str, pages: DataFrame, cap: int | None = MAX_RESULTS_PER_COLLECT
) -> tuple[msg.MessageTarget, str, DataFrame]:
    target, archive = msg.MessageTarget(folder=scratch_path(spark, "topics")), scratch_path(spark, "archive")
    failures = pages.where("run_id = 'empty'").selectExpr("'failed' AS run_id", "'API: 500' AS error")
    summary = collection.run_collection(
        pages, _profiles(spark, sf_dir), target, archive, "query",
        failures=failures, cap=cap, ingested_at=F.lit("2024-02-01").cast("timestamp"), variant_archive=cap is None,
    )
    return target, archive, summary


@_register
def collection_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The author's profile inside archived and published posts, and what went to audit."""
    target, archive, _ = _collected(spark, sf_dir, inputs.api_pages(spark, sf_dir))
    return _places(spark, target, archive)


@_register
def collection_run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for runs that reach every document, without a limit."""
    target, archive, _ = _collected(spark, sf_dir, inputs.api_pages_all(spark, sf_dir), cap=None)
    return _places(spark, target, archive, variant=True)


def _places(spark: SparkSession, target: msg.MessageTarget, archive: str, variant: bool = False) -> DataFrame:
    user = ("user_username", "user_followers_count", "enriched")
    if variant:
        bodies = read_variant_archive(spark, archive)
        fields = [text_of("body", c).alias(c) for c in ("id", *user)]
    else:
        bodies, fields = spark.read.text(archive), _decoded("value", "id", *user)
    kept = bodies.select(F.lit("archive").alias("place"), *fields)
    sent = target.read(spark, TOPIC_BRONZE).select(
        F.lit("bronze").alias("place"),
        F.get_json_object("value", "$.tweet_id").alias("id"),
        *(F.get_json_object("value", f"$.raw_payload.{c}").alias(c) for c in user),
    )
    audit = target.read(spark, TOPIC_AUDIT).select(
        F.lit("audit").alias("place"),
        F.get_json_object("value", "$.raw_tweet.id").alias("id"),
        *(F.get_json_object("value", f"$.raw_tweet.{c}").alias(c) for c in user),
    )
    return kept.unionByName(sent).unionByName(audit)


@_register
def collection_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, summary = _collected(spark, sf_dir, inputs.api_pages(spark, sf_dir))
    return summary.select(*_SUMMARY_COLUMNS, _joined("errors"))


@_register
def collection_summary_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, summary = _collected(spark, sf_dir, inputs.api_pages_all(spark, sf_dir), cap=None)
    return summary.select(*_SUMMARY_COLUMNS, _joined("errors"))


@_register
def stream_validate_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    job.run_routing(spark, _in_batches(spark, inputs.nested_messages(spark, sf_dir)), target).awaitTermination()
    return _by_category(spark, target)


def _by_category(spark: SparkSession, target: msg.MessageTarget) -> DataFrame:
    bronze = target.read(spark, TOPIC_BRONZE).groupBy(F.lit("bronze").alias("category")).agg(F.count("*").alias("n"))
    audit = val.route_audit(target.read(spark, TOPIC_AUDIT)).groupBy("category").agg(F.count("*").alias("n"))
    return bronze.unionByName(audit)


@_register
def stream_app_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    lines = inputs.log_lines(spark, sf_dir).withColumnRenamed("event_id", "doc_id")
    job.run_app_logs(spark, _in_batches(spark, lines), target).awaitTermination()
    shipped = val.route_audit(target.read(spark, TOPIC_AUDIT))
    return shipped.select("category", *_decoded("value", "level", "logger", "message"))


@_register
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that come again in a later batch, old, new and undated ones, come out once; a wave is a batch, however many files it has."""
    source, path, checkpoint = (scratch_path(spark, x) for x in ("waves", "dedup", "checkpoint"))
    messages = inputs.flat_messages(spark, sf_dir)
    for n, wave in enumerate(_WAVES):
        messages.where(wave).select("value").write.text(f"{source}/{n}")
        enriched = P.enrich_stream(read_tweets(spark, StreamConfig(source_path=f"{source}/*")))
        job.start(job.stream_dedup(enriched), tab.StagingTableSink(path), checkpoint, _NOW).awaitTermination()
    return _staging_view(tab.read_staging(spark, path))


@_register
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages into a table with one row per post; each wave is a query of its own, and the table is compacted between two."""
    source, checkpoint = scratch_path(spark, "waves"), scratch_path(spark, "checkpoint")
    table = KeyedTable(scratch_path(spark, "keyed"), "tweet_id", order=["processed_at"], run="upsert")
    messages = inputs.flat_messages(spark, sf_dir)
    for n, wave in enumerate(_WAVES):
        messages.where(wave).select("value").write.parquet(f"{source}/{n}")
        enriched = P.enrich_stream(spark.readStream.schema("value string").parquet(f"{source}/*"))
        job.start(enriched, table, checkpoint, _NOW).awaitTermination()
        if n == 2:
            table.compact(spark)
    return _staging_view(table.read(spark, enriched.schema))


def _alert_stream(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Samples in four waves of their time, a fifth of them one wave late, and a last one that lets the clock run out."""
    session = alerting.stateful_session(spark)
    samples = stored(
        inputs.metric_samples(spark, sf_dir).select(F.unix_micros("ts").alias("t"), "metric", "labels", "value"), "samples"
    )
    first, last = samples.agg(F.min("t"), F.max("t")).first()
    length = ((last or 0) - (first or 0)) // 3 + 1
    late = (F.pmod(F.xxhash64("t", "metric"), F.lit(5)) == 0).cast("int")
    waves = samples.withColumn("wave", F.expr(f"(t - {first or 0}L) DIV {length}L") + late)
    clock = spark.range(1).selectExpr(f"{last or 0}L + 100 * {length}L AS t", "'clock' AS metric", "map('', '') AS labels", "0D AS value")
    folder, out, checkpoint = (scratch_path(spark, x) for x in ("samples", "alerts", "checkpoint"))
    kind = "t long, metric string, labels map<string,string>, value double"
    for n in range(5):
        wave = clock if n == 4 else waves.where(f"wave = {n}").drop("wave")
        wave.write.parquet(f"{folder}/wave={n}")
        read = session.readStream.schema(kind).parquet(f"{folder}/*").withColumn("ts", F.timestamp_micros("t")).drop("t")
        stream = make(read, f"{length // 1_000_000 + 1} seconds")
        job.start(
            stream, lambda df, k: df.write.mode("overwrite").parquet(f"{out}/batch_id={k}"), checkpoint, _NOW
        ).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def _alert_state_stream(samples: DataFrame, delay: str) -> DataFrame:
    rules = [replace(r, enabled=True) for r in alerts.RULES]
    return alerting.stream_alert_states(samples, rules, max_gap_seconds=120, delay=delay)


@_register
def stream_alert_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all samples, evaluated in keyed state while they arrive."""
    found = _alert_stream(spark, sf_dir, _alert_state_stream)
    return found.where("NOT by_timer").select("alertname", "severity", "series", _time("ts"), "state")


@_register
def stream_group_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications with all their samples, from the same stream of states."""
    found = _alert_stream(spark, sf_dir, lambda s, delay: alerting.stream_group_alerts(_alert_state_stream(s, delay)))
    closed = found.where("event = 'closed'")
    return closed.select("alertname", "severity", "repeat", _time("notified_at"), "samples", "receiver")


@_register
def stream_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _in_batches(spark, inputs.nested_messages(spark, sf_dir))
    path = scratch_path(spark, "counters")
    job.start(
        read_tweets(spark, config), job.CounterSink(path), config.checkpoint_location, _NOW
    ).awaitTermination()
    return job.stream_metrics(spark.read.schema("counter string, label string, n long").parquet(path))
