import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchline.operators import posts as P
from touchline.schemas import STAGING_COLUMNS, TWEET_SCHEMA

POST = {
    "tweet_id": "501",
    "text": "Un mot du coach",
    "created_at": "2026-05-02T18:30:00.000Z",
    "author_id": "a77",
    "lang": "fr",
    "like_count": 31,
    "retweet_count": 7,
    "hashtags": ["coach", "mots"],
}


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def staged(spark, *values, **options):
    return P.to_staging(frame(spark, *values), **options).collect()


def test_fields_are_parsed(spark):
    (row,) = staged(spark, json.dumps(POST))
    for name in ("tweet_id", "text", "author_id", "lang", "like_count", "retweet_count", "hashtags"):
        assert row[name] == POST[name]
    assert row.created_at == datetime(2026, 5, 2, 18, 30)
    assert row.engagement == 38 and row.themes == [] and row.processed_at is not None


def test_columns_in_order(spark):
    assert P.to_staging(frame(spark)).columns == STAGING_COLUMNS


@pytest.mark.parametrize("bad", ["{not a json}", "", "[1]", '{"tweet_id": ', "null"])
def test_unparseable_is_dropped(spark, bad):
    assert [r.tweet_id for r in staged(spark, bad, json.dumps(POST))] == ["501"]


def test_binary_value(spark):
    df = frame(spark, json.dumps(POST)).withColumn("value", F.col("value").cast("binary"))
    assert P.to_staging(df).count() == 1


def test_bad_field_nulls_only_itself(spark):
    rows = staged(
        spark,
        json.dumps({**POST, "like_count": "10"}),
        json.dumps({**POST, "like_count": 12.0}),
        json.dumps({**POST, "tweet_id": 20}),
        json.dumps({**POST, "tweet_id": ""}),
        json.dumps({**POST, "created_at": ""}),
        json.dumps({k: v for k, v in POST.items() if k not in ("like_count", "retweet_count")}),
    )
    assert [r.tweet_id for r in rows] == ["501", "501", "20", "", "501", "501"]
    assert [r.engagement for r in rows] == [7, 7, 38, 38, 38, 0]
    assert rows[4].created_at is None


def test_counters_coerced_on_request(spark):
    (row,) = staged(spark, json.dumps({**POST, "like_count": "10", "retweet_count": "3"}), coerce_counters=True)
    assert row.engagement == 13


@pytest.mark.parametrize(
    "likes, retweets, expected",
    [(12, 4, 16), (None, None, 0), (None, 5, 5), (2**63 - 1, 1, None)],
)
def test_engagement(spark, likes, retweets, expected):
    df = spark.createDataFrame([(likes, retweets)], "like_count long, retweet_count long")
    assert P.with_engagement(df).first().engagement == expected


def test_enrich_keeps_other_columns(spark):
    df = spark.createDataFrame(
        [("x", "la VAR", [], "10", "3")],
        "extra string, text string, hashtags array<string>, like_count string, retweet_count string",
    )
    row = P.enrich(df, coerce_counters=True).first()
    assert (row.extra, row.engagement, row.themes) == ("x", 13, ["var"])


def test_kafka_frame(spark):
    out = P.to_kafka_frame(P.to_staging(frame(spark, json.dumps(POST))))
    assert out.columns == ["key", "value"]
    row = out.first()
    payload = json.loads(row.value)
    assert row.key == "501" and payload["engagement"] == 38 and payload["themes"] == []
    assert payload["created_at"] == "2026-05-02T18:30:00.000Z" and "raw_payload" not in payload


def test_nulls_vanish_from_the_silver_value(spark):
    value = P.to_kafka_frame(P.to_staging(frame(spark, '{"tweet_id":"1"}'))).first().value
    assert set(json.loads(value)) == {"tweet_id", "engagement", "themes", "processed_at"}


def test_schema_is_nullable():
    assert all(f.nullable for f in TWEET_SCHEMA.fields)
    assert "raw_payload" not in TWEET_SCHEMA.fieldNames()


def test_json_is_parsed_once(spark):
    plan = P.to_staging(frame(spark, "x")).where("size(themes) > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
