"""Mergeable summaries against exact figures."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from touchline.operators import sketches as S
from touchline.session import scratch_path


def test_authors_over_any_range(spark):
    """Merged days count an author once; a new day adds one row and changes none."""
    draw = random.Random(2)
    rows = [(f"2024-01-{d:02}", f"u{draw.randrange(6000)}") for d in range(1, 11) for _ in range(2000)] + [("2024-01-03", ""), ("2024-01-03", None)]
    posts = spark.createDataFrame(rows, "day string, author_id string").withColumn("day", F.col("day").cast("date"))
    days = S.author_sketches(posts, F.col("day"))
    assert days.count() == 10
    earlier = S.author_sketches(posts.where("day < '2024-01-10'"), F.col("day"))
    new = S.author_sketches(posts.where("day = '2024-01-10'"), F.col("day"))
    assert new.count() == 1
    for sketches in (days, earlier.union(new)):
        for first, last in ((None, None), ("2024-01-02", "2024-01-04"), ("2024-01-10", None)):
            inside = [a for d, a in rows if (first or "") <= d <= (last or "9") ]
            exact, found = len({a for a in inside if a}), S.authors_between(sketches, first, last).first()
            assert found.posts == len(inside)
            assert abs(found.authors - exact) <= 4 * S.DISTINCT_ERROR * exact + 1


def test_quantiles_over_long_ranges(spark):
    draw = random.Random(3)
    rows = [(draw.choice("ab"), 3600 * draw.randrange(50), draw.expovariate(1)) for _ in range(20_000)]
    frame = spark.createDataFrame(rows, "topic string, t long, s double").withColumn("ts", F.timestamp_seconds("t"))
    hours = S.latency_sketches(frame.union(frame.where("t = 0").withColumn("s", F.lit(None))), "s", "ts", ["topic"])
    assert hours.count() == 100
    for r in S.latency_quantiles(hours, ["topic"]).collect():
        values = [s for topic, _, s in rows if topic == r.topic]
        rank = sum(s <= r.seconds for s in values) / len(values)
        assert r.n == len(values) and abs(rank - r.share) <= S.RANK_ERROR


@pytest.mark.parametrize("share", [0.3, 0.05, 0.01])
def test_frequent_keys_are_exact(spark, share):
    """Few counters over many rare keys and some frequent ones, whatever the cuts between tasks."""
    draw = random.Random(4)
    keys = [f"rare{draw.randrange(10_000)}" for _ in range(6000)] + ["a"] * 5000 + ["b"] * 700 + ["c"] * 130 + [None] * 3000
    draw.shuffle(keys)
    frame = spark.createDataFrame([(k,) for k in keys], "k string").repartition(7)
    exact = {k: n for k, n in Counter(k for k in keys if k).items() if n > share * sum(k is not None for k in keys)}
    summary = S.key_summary(frame, "k", share)
    assert summary.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] <= 2 / share + 2
    few = {r.key for r in S.key_candidates(summary, share).collect()}
    assert set(exact) <= few and len(few) <= 2 / share + 1
    assert {r.key: r.n for r in S.heavy_hitters(frame, "k", share).collect()} == exact


def test_frequent_keys_of_batches(spark):
    """A repeated batch replaces its own counters; all batches together list what is frequent overall."""
    path, batches = scratch_path(spark, "keys"), [["a"] * 60 + [f"x{i}" for i in range(90)], ["b"] * 80 + [f"y{i}" for i in range(70)]]
    sink = S.KeySummarySink(path, "k", 0.2, run="r")
    frames = [spark.createDataFrame([(k,) for k in b], "k string") for b in batches]
    for n, frame in enumerate([*frames, frames[1]]):
        sink(frame, min(n, 1))
    both = frames[0].union(frames[1])
    found = S.heavy_hitters(both, "k", 0.2, sink.read(spark))
    assert {r.key: r.n for r in found.collect()} == {"b": 80}
    assert {r.key: r.n for r in S.heavy_hitters(both, "k", 0.19).collect()} == {"a": 60, "b": 80}


def test_no_rows(spark):
    none = spark.createDataFrame([], "k string, s double, ts timestamp, day date, author_id string")
    assert S.heavy_hitters(none, "k", 0.1).count() == 0
    assert S.latency_quantiles(S.latency_sketches(none, "s", "ts", ["k"]), ["k"]).count() == 0
    assert S.authors_between(S.author_sketches(none, F.col("day")), by=["day"]).count() == 0
