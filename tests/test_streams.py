import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators import posts as P
from touchline.plans import registry
from touchline.session import scratch_path, scratch_root
from touchline.sinks import messages as msg
from touchline.sinks import tables as tab
from touchline.sources.files import read_raw_archive, read_variant_archive
from touchline.sources.stream import StreamConfig, config_from_env, read_tweets, source_options
from touchline.streaming import job
from touchline.vocabulary import ARCHIVE_RECORDS_PER_FILE, TOPIC_AUDIT, TOPIC_BRONZE

NOW = {"availableNow": True}


def bronze(i, **extra):
    return json.dumps({"tweet_id": str(i), "text": "la VAR", "like_count": i, "retweet_count": 1, "hashtags": [], **extra})


def write_file(spark, folder, values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(folder)


# --- configuration ----------------------------------------------------------------


def test_config_defaults():
    config = config_from_env({})
    assert (config.brokers, config.topic, config.starting_offsets) == ("localhost:9092", "tweets_raw", "latest")
    assert config.max_offsets_per_trigger is None and config.trigger() == {"processingTime": "30 seconds"}
    assert config.staging_table == "local-project.twitter_staging.tweets"


def test_config_overrides():
    env = {
        "KAFKA_BROKERS": "b1:1,b2:2", "TOPIC_NAME": "t", "STARTING_OFFSETS": "earliest",
        "MAX_OFFSETS_PER_TRIGGER": "500", "GCP_PROJECT_ID": "p",
        "TRIGGER_INTERVAL": "availableNow", "CHECKPOINT_LOCATION": "/shared/x",
    }
    config = config_from_env(env)
    assert config.staging_table == "p.twitter_staging.tweets"
    assert config.trigger() == NOW
    assert source_options(config) == {
        "kafka.bootstrap.servers": "b1:1,b2:2", "subscribe": "t", "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "500", "includeHeaders": "true",
    }
    assert config_from_env({"GCP_PROJECT_ID": "p", "BQ_TABLE": "o.d.t"}).staging_table == "o.d.t"


def test_empty_endpoint_is_none():
    assert config_from_env({}).api_endpoint is None
    assert config_from_env({"BQ_API_ENDPOINT": ""}).api_endpoint is None
    assert config_from_env({"BQ_API_ENDPOINT": "http://x:1"}).api_endpoint == "http://x:1"
    assert config_from_env({"LOG_FROM_START": "TRUE"}).log_from_start is True
    assert config_from_env({}).log_from_start is False


def test_checkpoint_lies_in_the_shared_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir") == scratch_root(spark)
    assert StreamConfig().checkpoint(spark).startswith(scratch_root(spark))
    assert StreamConfig(checkpoint_location="/x").checkpoint(spark) == "/x"


def test_session_is_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


# --- the enrichment job -------------------------------------------------------------


def test_stream_equals_batch_and_resumes(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "staging")
    config = StreamConfig(source_path=source, trigger_interval="availableNow", checkpoint_location=scratch_path(spark, "cp"))
    write_file(spark, source, [bronze(i) for i in range(5)] + ["{bad"])
    job.run_stream(spark, config, tab.StagingTableSink(path)).awaitTermination()
    assert tab.read_staging(spark, path).count() == 5
    write_file(spark, source, [bronze(i) for i in range(5, 8)])
    job.run_stream(spark, config, tab.StagingTableSink(path)).awaitTermination()
    streamed = tab.read_staging(spark, path).drop("processed_at")
    batch = P.to_staging(spark.read.text(source)).drop("processed_at")
    assert streamed.count() == 8
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_micro_batches_are_bounded(spark):
    source, sizes = scratch_path(spark, "in"), []
    for i in range(3):
        write_file(spark, source, [bronze(i)])
    stream = read_tweets(spark, StreamConfig(source_path=source, max_offsets_per_trigger=1))
    job.start(stream, lambda df, n: sizes.append(df.count()), scratch_path(spark, "cp"), NOW).awaitTermination()
    assert sizes == [1, 1, 1]


def staged(spark, *ids):
    return P.to_staging(spark.createDataFrame([(bronze(i),) for i in ids], "value string"))


def test_staging_sink_replaces_a_retried_batch(spark):
    path = scratch_path(spark, "staging")
    sink = tab.StagingTableSink(path, "a")
    sink(staged(spark, 1, 2), 0)
    sink(staged(spark, 1, 2), 0)
    sink(staged(spark, 3), 1)
    sink(staged(spark, 9).where("false"), 2)
    assert sorted(r.tweet_id for r in tab.read_staging(spark, path).collect()) == ["1", "2", "3"]
    tab.StagingTableSink(path, "b")(staged(spark, 4), 0)
    assert tab.read_staging(spark, path).count() == 4
    assert tab.read_staging(spark, path, since="9999-01-01").isEmpty()
    with pytest.raises(ValueError):
        tab.StagingTableSink(path)(staged(spark, 5), 0)


def test_compaction(spark):
    path, into = scratch_path(spark, "staging"), scratch_path(spark, "compact")
    for n in range(4):
        tab.StagingTableSink(path, "a")(staged(spark, n), n)
    for _ in range(2):
        tab.compact_staging(spark, path, into, before="9999-01-01")
    found = tab.read_staging(spark, into)
    assert sorted(r.tweet_id for r in found.collect()) == ["0", "1", "2", "3"] and len(found.inputFiles()) == 1


class FakeBatch:
    def __init__(self, calls):
        self.calls = calls

    def persist(self):
        self.calls.append("persist")

    def unpersist(self):
        self.calls.append("unpersist")


def test_fan_out_order():
    calls = []
    tab.DualSink(lambda d, n: calls.append(("first", n)), lambda d, n: calls.append(("second", n)))(FakeBatch(calls), 7)
    assert calls == ["persist", ("first", 7), ("second", 7), "unpersist"]


@pytest.mark.parametrize("failing, seen", [(0, []), (1, ["first"])])
def test_fan_out_failure_propagates_and_releases(failing, seen):
    calls, done = [], []

    def sink(position, name):
        def run(df, n):
            if position == failing:
                raise RuntimeError("down")
            done.append(name)

        return run

    with pytest.raises(RuntimeError):
        tab.DualSink(sink(0, "first"), sink(1, "second"))(FakeBatch(calls), 0)
    assert done == seen and calls == ["persist", "unpersist"]


# --- routing, logs, counters ----------------------------------------------------------


def api_post(i, **extra):
    return json.dumps({
        "id": str(i), "text": "t", "created_at": "2026-01-01T00:00:00Z", "lang": "fr", "author_id": f"a{i % 2}",
        "public_metrics": {"like_count": 1, "retweet_count": 2}, "entities": {"hashtags": [{"tag": "OM"}]}, **extra,
    })


BODIES = [
    api_post(1), api_post(2), api_post(3, lang="en"), "{bad", api_post(4, public_metrics=None), "[]", api_post(5, id=""),
]


def test_routing_stream(spark):
    source = scratch_path(spark, "in")
    write_file(spark, source, BODIES)
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    stream = read_tweets(spark, StreamConfig(source_path=source))
    sink = job.RoutingSink(target, run="r")
    job.start(stream, sink, scratch_path(spark, "cp"), NOW).awaitTermination()
    sink(spark.read.text(source), 0)  # the same batch once more
    sent = target.read(spark, TOPIC_BRONZE).collect()
    assert sorted(json.loads(r.value)["tweet_id"] for r in sent) == ["1", "2"]
    assert {bytes(r.key) for r in sent} == {b"a0", b"a1"}
    audit = target.read(spark, TOPIC_AUDIT).collect()
    assert sorted(r.value for r in audit if r.key is None) == ["[]", "{bad"]
    assert sorted(json.loads(r.value)["raw_tweet"]["id"] for r in audit if r.key is not None) == ["", "3", "4"]
    assert len(sent) + len(audit) == len(BODIES)


def test_counters(spark):
    path = scratch_path(spark, "counters")
    sink = job.CounterSink(path, run="r")
    batch = spark.createDataFrame([(b,) for b in BODIES], "value string")
    for n in (0, 0, 1):
        sink(batch, n)
    totals = {(r.counter, r.label): r.n for r in job.stream_metrics(spark.read.parquet(path)).collect()}
    assert totals == {
        ("sent", "OM"): 4,
        ("rejected", "Langue non autorisée : en (attendu : ['fr'])"): 2,
        ("rejected", "public_metrics doit être un objet"): 2,
        ("rejected", "Champ manquant : id"): 2,
    }


def test_observed_counters(spark):
    from touchline.operators.validation import validate_tweets

    source = scratch_path(spark, "in")
    write_file(spark, source, BODIES)
    stream = job.observe_counters(validate_tweets(read_tweets(spark, StreamConfig(source_path=source))))
    query = job.start(stream, lambda df, n: df.count(), scratch_path(spark, "cp"), NOW)
    query.awaitTermination()
    metrics = query.lastProgress.observedMetrics["posts"]
    assert (metrics.sent, metrics.rejected) == (3, 4)


def test_dedup_over_batches(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "out")
    old, new = "2020-01-01T00:00:00Z", "2030-01-01T00:00:00Z"
    waves = [
        [bronze(1), bronze(1), bronze(2, created_at=new)],
        [bronze(3, created_at=old), bronze(1)],
        [bronze(4, created_at=new), bronze(3, created_at=old), bronze(5, created_at="")],
        [bronze(6, created_at=old), bronze(2, created_at=new), bronze(5, created_at="")],
    ]
    for wave in waves:
        write_file(spark, source, wave)
    enriched = P.enrich_stream(read_tweets(spark, StreamConfig(source_path=source, max_offsets_per_trigger=1)))
    query = job.start(job.stream_dedup(enriched), tab.StagingTableSink(path), scratch_path(spark, "cp"), NOW)
    query.awaitTermination()
    assert sorted(r.tweet_id for r in tab.read_staging(spark, path).collect()) == ["1", "2", "3", "4", "5", "6"]
    late = [s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators]
    assert len(query.recentProgress) >= 4 and not any(late)


def test_dedup_query_runs_a_batch_per_wave(spark, tmp_path, monkeypatch):
    """Not one per file, whose number grows with the table."""
    rows = [(i, f"text {i}", "fr", "s", 10 + i) for i in range(48)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    documents.repartition(6).write.parquet(f"{tmp_path}/documents.parquet")
    paths = {}
    monkeypatch.setattr(registry, "scratch_path", lambda s, name: paths.setdefault(name, scratch_path(s, name)))
    found = registry.queries()["stream_dedup"](spark, str(tmp_path))
    assert sorted(int(r.tweet_id) for r in found.collect()) == [i for i in range(48) if i % 41]
    batches = spark.read.format("state-metadata").load(paths["checkpoint"]).agg(F.max("maxBatchId")).first()[0]
    assert batches < 2 * 5


# --- archive and messages -----------------------------------------------------------------


def test_raw_archive(spark):
    path = scratch_path(spark, "archive")
    df = spark.createDataFrame([("1", "2026-03-04 23:30:00"), ("2", "2026-03-05 00:10:00")], "tweet_id string, at string")
    moment = F.col("at").cast("timestamp")
    assert tab.write_raw_archive(df, path, moment) == 2
    assert tab.write_raw_archive(df.where("tweet_id = '1'"), path, moment) == 1
    back = read_raw_archive(spark, path, df.schema)
    assert back.where("day = '04' AND month = '03'").count() == 2
    scan = back.where("day = '04'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan
    assert {r.day: r.n for r in tab.archive_counts(back).collect()} == {"04": 2, "05": 1}


def test_raw_archive_errors(spark):
    df = spark.createDataFrame([("1",), ("x",)], "tweet_id string")
    seen = []
    assert tab.write_raw_archive(df, "nosuchscheme://x/y", on_error=seen.append) == 0 and len(seen) == 1
    with pytest.raises(Exception):
        tab.write_raw_archive(df, "nosuchscheme://x/y")
    broken = df.selectExpr("CAST(tweet_id AS INT) AS tweet_id")
    with pytest.raises(Exception):
        tab.write_raw_archive(broken, scratch_path(spark, "archive"), on_error=seen.append)
    assert len(seen) == 1


def test_variant_archive(spark):
    """Posts of every JSON kind as VARIANT; fields are read without text, and a failing archive can be passed over."""
    bodies = ['{"id":"1","n":{"k":[1,2]}}', '"text"', "[1]", "{bad", None]
    posts = spark.createDataFrame([(b,) for b in bodies], "value string").withColumn("post", F.try_parse_json("value"))
    path, moment = scratch_path(spark, "archive"), F.lit("2024-03-05 23:59:59").cast("timestamp")
    assert tab.write_variant_archive(posts, path, moment) == 5
    rows = read_variant_archive(spark, path).where("year = '2024' AND month = '03' AND day = '05'")
    found = rows.selectExpr("try_variant_get(body, '$.id', 'string') AS id", "try_variant_get(body, '$.n.k[1]', 'int') AS k", "to_json(body) AS j", "text")
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [("1", 2, bodies[0], None), (None, None, '"text"', None), (None, None, "[1]", None), (None, None, None, "{bad"), (None, None, None, None)], key=repr
    )
    seen = []
    assert tab.write_variant_archive(posts, "nosuchscheme://x/y", on_error=seen.append) == 0 and len(seen) == 1
    with pytest.raises(Exception):
        tab.write_variant_archive(posts, "nosuchscheme://x/y")


def test_archive_stream_uses_paris_days_and_small_files(spark):
    source, path = scratch_path(spark, "in"), scratch_path(spark, "archive")
    spark.range(250).selectExpr(
        "to_json(named_struct('id', id)) AS value", "TIMESTAMP '2026-06-30 22:30:00' AS timestamp"
    ).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("value string, timestamp timestamp").parquet(source)
    tab.archive_stream(stream, path, scratch_path(spark, "cp"), ARCHIVE_RECORDS_PER_FILE, NOW).awaitTermination()
    back = read_raw_archive(spark, path, T.StructType().add("id", "long"))
    assert [tuple(r) for r in back.groupBy("year", "month", "day").count().collect()] == [("2026", "07", "01", 250)]
    sizes = spark.read.text(path).groupBy(F.input_file_name()).count()
    assert sizes.agg(F.max("count")).first()[0] == 100


def test_message_folder_replaces_a_batch(spark):
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    df = spark.createDataFrame([("k", "v")], "key string, value string")
    target.write(df, "t", 3, "p", "r")
    target.write(df, "t", 3, "p", "r")
    assert [(bytes(r.key), r.value, r.headers) for r in target.read(spark, "t").collect()] == [(b"k", "v", None)]
    target.write(df, "t", 3, "q", "r")
    target.write(df, "t", 3, "p", "s")
    assert target.read(spark, "t").count() == 3


def test_silver_publisher(spark):
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    msg.SilverPublisher(target, run="r")(staged(spark, 5), 0)
    row = target.read(spark, "tweets_enriched").first()
    assert bytes(row.key) == b"5" and json.loads(row.value)["engagement"] == 6


def test_run_summary_file(spark):
    path = scratch_path(spark, "summary")
    tab.write_run_summary(spark.createDataFrame([("r", 3)], "run_id string, n long"), path, {"keywords": "OM"})
    assert spark.read.json(path).first().asDict() == {"run_id": "r", "n": 3, "arg_keywords": "OM"}


def test_jobs_route_ship_and_archive(spark):
    """The ready jobs, in several batches, into one folder."""
    source, logs = scratch_path(spark, "in"), scratch_path(spark, "logs")
    for i in range(3):
        write_file(spark, source, [api_post(i), "{bad"])
        write_file(spark, logs, [f"2026-04-03 07:05:0{i} [INFO] a: b"])
    target = msg.MessageTarget(folder=scratch_path(spark, "topics"))
    config = lambda path: StreamConfig(
        source_path=path, max_offsets_per_trigger=1, trigger_interval="availableNow", checkpoint_location=scratch_path(spark, "cp")
    )
    job.run_routing(spark, config(source), target).awaitTermination()
    job.run_app_logs(spark, config(logs), target).awaitTermination()
    assert (target.read(spark, TOPIC_BRONZE).count(), target.read(spark, TOPIC_AUDIT).count()) == (3, 6)
    archive = scratch_path(spark, "archive")
    job.run_archive(spark, config(source), archive).awaitTermination()
    assert read_raw_archive(spark, archive, T.StructType().add("id", "string")).count() == 6


def test_collection_reaches_every_document(spark):
    """Archive, and bronze with audit, hold each document once, far beyond the limit of a collection in one run."""
    sf_dir = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    places = {r.place: r["count"] for r in registry.queries()["collection_run_all"](spark, sf_dir).groupBy("place").count().collect()}
    assert places["archive"] == documents == places["bronze"] + places["audit"]
    runs = {r.run_id: r.tweets_fetched for r in registry.queries()["collection_summary_all"](spark, sf_dir).collect()}
    assert sum(runs.values()) == documents and runs["long"] > 250


def test_uncapped_pages_grow_with_the_documents(spark):
    """Nearly every document is on a page that is read, and a third of them in one run."""
    sf_dir = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    pages = registry.queries()["read_response_pages_many"](spark, sf_dir).selectExpr("run_id", "split(tweet_id, '-')[0] AS page")
    runs = {r.run_id: r["count"] for r in pages.distinct().groupBy("run_id").count().collect()}
    assert sum(runs.values()) > 0.9 * documents and runs["long"] > 0.3 * documents


def test_staging_table_lies_in_the_shared_folder(spark):
    assert job.staging_path(spark, StreamConfig()).startswith(scratch_root(spark))
