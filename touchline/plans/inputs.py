"""Posts, messages, profiles, logs, pages and samples derived from the given tables.

The given tables hold prose, customers and events rather than social posts, so
each function reshapes a whole table into one of the engine's input shapes.
Imperfections (missing keys, wrong types, copies, gaps) follow from row ids, which
lets plain SQL state the expected result. A third of all posts belong to a single
author, and a third of all copies to a single post.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import pin_utc

HASHTAG_SETS = """
    CASE doc_id % 6 WHEN 0 THEN 'Ligue1,PSG' WHEN 1 THEN 'om' WHEN 2 THEN 'variete'
    WHEN 3 THEN 'Hors-Jeu,LOSC' WHEN 4 THEN 'football' ELSE 'AnalyseVideo' END
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flat post per document, over its whole text."""
    return documents(spark, sf_dir).selectExpr(
        "doc_id",
        "CAST(doc_id AS STRING) AS tweet_id",
        """concat(text, CASE doc_id % 11 WHEN 0 THEN ' Décision VAR' WHEN 1 THEN ' les stats xG'
           WHEN 2 THEN ' analyse vidéo' WHEN 3 THEN ' il varie'
           WHEN 4 THEN ' ralenti puis penalty' ELSE '' END) AS text""",
        """CASE WHEN doc_id % 29 = 0 THEN '' ELSE concat('2024-01-',
           lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0'), 'T',
           lpad(CAST(doc_id % 24 AS STRING), 2, '0'), ':00:00Z') END AS created_at""",
        """CASE WHEN doc_id % 43 = 5 THEN '' WHEN doc_id % 3 = 0 THEN 'u0'
           ELSE concat('u', CAST(doc_id % 97 AS STRING)) END AS author_id""",
        "lang",
        "source",
        "CASE WHEN doc_id % 31 = 0 THEN NULL ELSE n_chars % 500 END AS like_count",
        "n_chars % 37 AS retweet_count",
        f"split({HASHTAG_SETS}, ',') AS hashtags",
    )


def _member(name: str, value: str) -> str:
    """SQL for a JSON member whose string value needs escaping."""
    json = f"to_json(named_struct('{name}', {value}))"
    return f"substring({json}, 2, length({json}) - 2)"


def flat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze messages; some unreadable, some with counters as strings."""
    return posts(spark, sf_dir).selectExpr(
        "doc_id",
        f"""CASE WHEN doc_id % 41 = 0 THEN '{{not a json}}' ELSE concat('{{', concat_ws(',',
            concat('"tweet_id":"', tweet_id, '"'),
            {_member('text', 'text')},
            concat('"created_at":"', created_at, '"'),
            concat('"author_id":"', author_id, '"'),
            concat('"lang":"', lang, '"'),
            CASE WHEN doc_id % 14 = 3 THEN concat('"like_count":"', like_count, '"')
                 ELSE concat('"like_count":', like_count) END,
            concat('"retweet_count":', retweet_count),
            concat('"hashtags":["', array_join(hashtags, '","'), '"]')), '}}') END AS value""",
    )


def nested_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as a search API returns them, each kind of defect on some of them."""
    return posts(spark, sf_dir).selectExpr(
        "doc_id",
        "source AS run_id",
        f"""CASE WHEN doc_id % 59 = 0 THEN '{{not a json}}' ELSE concat('{{', concat_ws(',',
            CASE WHEN doc_id % 19 = 0 THEN concat('"id":', tweet_id)
                 WHEN doc_id % 61 = 0 THEN '"id":""'
                 ELSE concat('"id":"', tweet_id, '"') END,
            CASE WHEN doc_id % 37 = 0 THEN '"text":null' ELSE {_member('text', 'text')} END,
            CASE WHEN doc_id % 43 <> 0 THEN concat('"created_at":"', created_at, '"') END,
            concat('"lang":"', lang, '"'),
            CASE WHEN doc_id % 13 <> 0 THEN concat('"author_id":"', author_id, '"') END,
            CASE WHEN doc_id % 47 = 0 THEN '"public_metrics":null'
                 WHEN doc_id % 53 = 0 THEN NULL
                 ELSE concat('"public_metrics":{{', concat_ws(',',
                     CASE WHEN doc_id % 17 = 0 THEN '"like_count":-1'
                          WHEN doc_id % 41 = 0 THEN '"like_count":null'
                          ELSE concat('"like_count":', like_count) END,
                     concat('"retweet_count":', retweet_count),
                     '"reply_count":2,"quote_count":0'), '}}') END,
            CASE WHEN doc_id % 29 = 0 THEN NULL
                 WHEN doc_id % 23 = 0 THEN '"entities":{{"hashtags":"none"}}'
                 ELSE concat('"entities":{{"hashtags":[{{"tag":""}},{{"tag":"',
                     array_join(hashtags, '"}},{{"tag":"'), '"}}]}}') END,
            CASE WHEN doc_id % 29 = 0 THEN concat('"hashtags":["', array_join(hashtags, '","'), '"]') END
            ), '}}') END AS value""",
    )


def flat_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat posts with defects, for the older flat validation profile."""
    return posts(spark, sf_dir).selectExpr(
        "doc_id",
        f"""concat('{{', concat_ws(',',
            CASE WHEN doc_id % 19 = 0 THEN concat('"tweet_id":', tweet_id)
                 ELSE concat('"tweet_id":"', tweet_id, '"') END,
            {_member('text', 'text')},
            CASE WHEN doc_id % 43 <> 0 THEN concat('"created_at":"', created_at, '"') END,
            concat('"lang":"', lang, '"'),
            CASE WHEN doc_id % 13 <> 0 THEN concat('"author_id":"', author_id, '"') END,
            concat('"like_count":', like_count),
            concat('"retweet_count":', retweet_count),
            CASE WHEN doc_id % 17 = 0 THEN '"reply_count":-2' END,
            CASE WHEN doc_id % 7 = 0 THEN '"quote_count":-0.5' END,
            CASE WHEN doc_id % 23 = 0 THEN '"hashtags":"none"'
                 ELSE concat('"hashtags":["', array_join(hashtags, '","'), '"]') END), '}}') AS value""",
    )


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts delivered one to three times; a third of the rows share one id."""
    return (
        posts(spark, sf_dir)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 3).cast("int"))))
        .selectExpr(
            "CASE WHEN doc_id % 3 = 1 THEN 'hot' ELSE tweet_id END AS tweet_id",
            "doc_id",
            "author_id",
            "retweet_count + copy AS retweet_count",
            "TIMESTAMP '2024-02-01 00:00:00' + make_dt_interval(0, copy) AS processed_at",
        )
    )


def profile_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One or two versions of a profile per customer, under varying spellings.

    Ids are the even numbers, so about half of the authors have a profile.
    """
    return (
        table(spark, sf_dir, "customer")
        .withColumn("version", F.explode(F.sequence(F.lit(0), (F.col("c_custkey") % 2).cast("int"))))
        .selectExpr(
            "version",
            """concat('{', concat_ws(',',
               CASE WHEN c_custkey % 50 = 49 THEN NULL
                    WHEN c_custkey % 4 = 1 THEN concat('"user_id":"","id":"u', c_custkey * 2, '"')
                    ELSE concat('"user_id":"u', c_custkey * 2, '"') END,
               CASE WHEN c_custkey % 4 = 2 THEN concat('"screen_name":"', c_name, '"')
                    ELSE concat('"username":"', c_name, '"') END,
               concat('"name":"', c_mktsegment, '"'),
               CASE WHEN c_custkey % 10 = 7 THEN '"followers_count":null'
                    ELSE concat('"followers_count":', CAST(floor(c_acctbal) AS BIGINT) + version) END,
               CASE WHEN c_custkey % 3 = 0 THEN concat('"following_count":"', c_nationkey, '"') END,
               CASE c_custkey % 5 WHEN 0 THEN '"verified":true' WHEN 1 THEN '"verified":0'
                    WHEN 2 THEN '"verified":"yes"' ELSE '"verified":false' END,
               CASE WHEN c_custkey % 4 = 3 THEN '"bio":"supporter"' ELSE '"description":"fan"' END,
               concat('"location":"', c_nationkey, '"')), '}') AS value""",
        )
    )


def profile_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles as they changed: one to four versions per customer, and forty of the busiest author."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat('u', (c_custkey - 1) * 2) AS user_id",
        "c_name",
        "c_custkey",
        "c_nationkey",
        "explode(sequence(0, IF(c_custkey = 1, 39, CAST(c_custkey % 4 AS INT)))) AS version",
    ).selectExpr(
        "user_id",
        "version",
        "concat(c_name, '-', version) AS username",
        "c_name AS name",
        "CAST(c_custkey * 10 + version AS BIGINT) AS followers_count",
        "0L AS following_count",
        "version % 2 = 1 AS verified",
        "'fan' AS description",
        "CAST(c_nationkey AS STRING) AS location",
        "false AS is_blue_verified",
        """TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(0, CAST(c_custkey % 11 AS INT)
            + version * IF(c_custkey = 1, 17, 144)) AS valid_from""",
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application log lines with stack-trace and blank lines in between."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """CASE WHEN event_id % 50 = 0 THEN '   '
                WHEN event_id % 20 = 1 THEN concat('    at line ', event_id)
                ELSE concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), ' [',
                     CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END,
                     '] ', event_type, '.handler: user ', user_id, ' value ',
                     CAST(value AS DECIMAL(12,2)), ': done') END AS value""",
    )


def append_lines(lines: DataFrame, folder: str, wave: int, files: int = 16) -> None:
    """Append ``value`` of the rows to log files of a mounted folder: ``app-<part>.log``, one per part of ``event_id``.

    A task first cuts its file to the size it had before the wave, so a repeated task leaves each line once.
    """
    os.makedirs(folder, exist_ok=True)
    sizes = {name: os.path.getsize(f"{folder}/{name}") for name in os.listdir(folder)}

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"app-{TaskContext.get().partitionId()}.log"
        with open(f"{folder}/{name}", "ab") as f:
            f.truncate(sizes.get(name, 0))
            n = sum(f.write("".join(f"{x}\n" for x in batch.column(0).to_pylist()).encode()) for batch in batches)
        yield pa.RecordBatch.from_pydict({"n": [n]})

    # The salt keeps the waves apart; the number of parts is that of the files.
    parts = lines.repartition(files, F.xxhash64("event_id", F.lit(wave)))
    parts.select("value").mapInArrow(append, "n long").agg(F.sum("n")).first()


def response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored search response per document: each line of the text is a post.

    Runs are the sources. Some pages end a run: no data, bad JSON, no next token.
    """
    return documents(spark, sf_dir).selectExpr(
        "source AS run_id",
        "doc_id AS page",
        r"""CASE WHEN doc_id % 71 = 70 THEN '{bad' ELSE to_json(named_struct(
            'data', CASE WHEN doc_id % 67 <> 66 THEN
                transform(split(text, '\n'), (t, i) -> named_struct(
                    'id', concat(doc_id, '-', i), 'text', t,
                    'author_id', concat('u', (doc_id + i) % 97))) END,
            'meta', named_struct('next_token',
                CASE WHEN doc_id % 50 <> 49 THEN concat('t', doc_id) END))) END AS body""",
    )


def response_pages_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``response_pages``, in many runs: by source and block of 50 ids, and one long run that no page ends early."""
    return documents(spark, sf_dir).selectExpr(
        "CASE WHEN doc_id % 3 = 0 THEN 'long' ELSE concat(source, '-', doc_id DIV 50) END AS run_id",
        "doc_id AS page",
        r"""CASE WHEN doc_id % 3 <> 0 AND doc_id % 71 = 70 THEN '{bad' ELSE to_json(named_struct(
            'data', CASE WHEN doc_id % 3 = 0 OR doc_id % 67 <> 66 THEN
                transform(split(text, '\n'), (t, i) -> named_struct(
                    'id', concat(doc_id, '-', i), 'text', t,
                    'author_id', concat('u', (doc_id + i) % 97))) END,
            'meta', named_struct('next_token',
                CASE WHEN doc_id % 3 = 0 OR doc_id % 50 <> 49 THEN concat('t', doc_id) END))) END AS body""",
    )


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored search response per document, holding its nested post; runs are the sources.

    One more run has a page without posts.
    """
    pages = nested_messages(spark, sf_dir).selectExpr(
        "run_id",
        "doc_id AS page",
        """concat('{"data":[', CASE WHEN doc_id % 59 = 0 THEN '{"lang":"fr"}' ELSE value END, '],"meta":{',
           CASE WHEN doc_id % 97 = 96 THEN '' ELSE '"next_token":"t"' END, '}}') AS body""",
    )
    return _with_empty_run(pages)


def _with_empty_run(pages: DataFrame) -> DataFrame:
    empty = pages.agg(F.count("*").alias("page")).selectExpr("'empty' AS run_id", "page", "'{\"meta\":{}}' AS body")
    return pages.unionByName(empty)


def api_pages_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``api_pages``, in runs that reach every document.

    A third of the pages is one long run; the others belong to a source and a block of 50 ids.
    """
    pages = nested_messages(spark, sf_dir).selectExpr(
        "CASE WHEN doc_id % 3 = 0 THEN 'long' ELSE concat(run_id, '-', doc_id DIV 50) END AS run_id",
        "doc_id AS page",
        """concat('{"data":[', CASE WHEN doc_id % 59 = 0 THEN '{"lang":"fr"}' ELSE value END, '],"meta":{',
           CASE WHEN doc_id % 3 <> 0 AND doc_id % 50 = 49 THEN '' ELSE '"next_token":"t"' END, '}}') AS body""",
    )
    return _with_empty_run(pages)


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker metrics on a 15-second grid, one value per series and scrape."""
    metric = """CASE event_type WHEN 'error' THEN 'up'
        WHEN 'view' THEN 'kafka_broker_under_replicated_partitions'
        WHEN 'click' THEN 'kafka_controller_active_count'
        WHEN 'purchase' THEN 'kafka_broker_messages_in_per_sec'
        ELSE 'kafka_consumergroup_lag' END"""
    value = """CASE metric WHEN 'up' THEN CASE WHEN v > 5 THEN 0D ELSE 1D END
        WHEN 'kafka_broker_under_replicated_partitions' THEN floor(v / 5) * 1D
        WHEN 'kafka_controller_active_count' THEN CASE WHEN v > 20 THEN 0D ELSE 1D END
        WHEN 'kafka_broker_messages_in_per_sec' THEN CASE WHEN v > 3 THEN 0.5D ELSE 2D END
        ELSE v * 200 END"""
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "timestamp_seconds(1704067200 + (event_id * 3 DIV 15) * 15) AS ts",
            f"{metric} AS metric",
            "CASE WHEN user_id % 3 = 2 THEN 0 ELSE user_id % 3 END AS instance",
            "value",
        )
        .groupBy("ts", "metric", "instance")
        .agg(F.max("value").alias("v"))
        .selectExpr(
            "ts",
            "metric",
            "map('job', concat('kafka-broker-', instance), 'topic', 'tweets_raw') AS labels",
            f"{value} AS value",
        )
    )


def collection_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One collection run per order; a third of them on one account and day."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS run_id",
        "CASE WHEN o_custkey % 3 = 0 THEN 'a0' ELSE concat('a', o_custkey % 101) END AS account",
        "CASE WHEN o_custkey % 3 = 0 THEN TIMESTAMP '1995-01-01 00:00:00' ELSE CAST(o_orderdate AS TIMESTAMP) END AS run_started",
        "CAST(floor(o_totalprice) AS BIGINT) % 251 AS tweets_fetched",
    )
