"""Alert states and notifications on streams, against the batch operators over the same samples."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from touchline.operators import alerts
from touchline.session import scratch_path
from touchline.streaming import alerting, job

NOW = {"availableNow": True}
SAMPLE = "ts timestamp, metric string, labels map<string,string>, value double"
RULES = [replace(r, enabled=True) for r in alerts.RULES]
END = 4_102_444_800  # a last sample far ahead lets the watermark pass all others


@pytest.fixture(scope="module")
def stateful(spark):
    return alerting.stateful_session(spark, 3)


class Feed:
    """Waves of samples as files; each wave is one run of the query over the same checkpoint."""

    def __init__(self, stateful, make):
        self.spark, self.make = stateful, make
        self.folder, self.out = scratch_path(stateful, "samples"), scratch_path(stateful, "alerts")
        self.checkpoint = scratch_path(stateful, "checkpoint")

    def send(self, rows):
        """Rows (second, metric, labels, value); returns all that has come out so far."""
        frame = self.spark.createDataFrame([(float(t), m, lab, v) for t, m, lab, v in rows], "t double, metric string, labels map<string,string>, value double")
        frame.select(F.timestamp_micros((F.col("t") * 1_000_000).cast("long")).alias("ts"), "metric", "labels", "value").coalesce(1).write.mode("append").json(self.folder)
        stream = self.make(self.spark.readStream.schema(SAMPLE).json(self.folder))
        sink = lambda df, n: df.write.mode("overwrite").parquet(f"{self.out}/batch_id={n}")
        job.start(stream, sink, self.checkpoint, NOW).awaitTermination()
        return self.result(stream.schema)

    def result(self, schema):
        return self.spark.read.schema(schema).parquet(self.out)

    def finish(self):
        return self.send([(END, "clock", {}, 0.0)])


def up(job_name):
    return {"job": f"kafka-broker-{job_name}", "topic": "tweets_raw"}


def scrapes(seed, series=4, steps=120):
    """Samples of all metrics on a 15-second grid with gaps, each breached in stretches."""
    draw, rows = random.Random(seed), []
    for metric, good, bad in (
        ("up", 1.0, 0.0), ("kafka_broker_under_replicated_partitions", 0.0, 2.0),
        ("kafka_controller_active_count", 0.0, 1.0), ("kafka_consumergroup_lag", 5.0, 5000.0),
        ("kafka_broker_messages_in_per_sec", 9.0, 0.0),
    ):
        for s in range(series):
            down = False
            for i in range(steps):
                down = not down if draw.random() < 0.04 else down
                if draw.random() < 0.9:
                    rows.append((1_700_000_000 + 15 * i, metric, up(s), bad if down else good))
    return rows


def key(row):
    return tuple(str(x) for x in row)


def in_waves(rows, n, seed):
    """Waves in the order of time, except that a fifth of the samples come one wave late."""
    draw = random.Random(seed)
    first, last = min(r[0] for r in rows), max(r[0] for r in rows) + 1
    waves = [[] for _ in range(n + 1)]
    for r in rows:
        waves[(r[0] - first) * n // (last - first) + (draw.random() < 0.2)].append(r)
    return waves


def test_states_and_notifications_equal_the_batch_in_ten_batches(spark, stateful):
    rows = scrapes(3)
    states = Feed(stateful, lambda s: alerting.stream_alert_states(s, RULES, max_gap_seconds=40, delay="1 hour"))
    notes = Feed(stateful, lambda s: alerting.stream_group_alerts(
        alerting.stream_alert_states(s, RULES, max_gap_seconds=40, delay="10 minutes"), repeat_seconds=300))
    for wave in in_waves(rows, 2, 4):
        states.send(wave)
    for wave in in_waves(rows, 9, 4):
        notes.send(wave)
    found, closed = states.finish(), notes.finish()

    samples = spark.createDataFrame([(float(t), m, lab, v) for t, m, lab, v in rows], "t double, metric string, labels map<string,string>, value double")
    samples = samples.select(F.timestamp_seconds("t").alias("ts"), "metric", "labels", "value")
    batch = alerts.alert_states(samples, RULES, max_gap_seconds=40)
    columns = ["alertname", "severity", "series", "ts", "value", "state"]
    by_sample = [key(r) for r in found.where("NOT by_timer").select(*columns).collect()]
    expected = [key(r) for r in batch.select(*columns).collect()]
    assert sorted(by_sample) == sorted(expected) and any("firing" in r for r in expected)

    timed = found.where("by_timer").collect()
    assert timed and all(r.state == "firing" and r.value is None for r in timed)
    on_grid = {(r.alertname, r.series, r.ts) for r in found.where("NOT by_timer").collect()}
    assert not any((r.alertname, r.series, r.ts) in on_grid for r in timed)

    columns = ["alertname", "severity", "repeat", "notified_at", "samples", "receiver"]
    grouped = alerts.group_alerts(batch, repeat_seconds=300)
    got = [key(r) for r in closed.where("event = 'closed'").select(*columns).collect()]
    open_at_end = [key(r) for r in closed.where("event = 'opened'").select("alertname", "severity", "repeat", "notified_at").collect()]
    assert sorted(got) == sorted(key(r) for r in grouped.select(*columns).collect()) and any(r[2] > "0" for r in got)
    assert sorted(open_at_end) == sorted(r[:4] for r in got)


def test_fires_by_timer_without_a_further_sample(stateful):
    """One breached sample within the gap of its deadline; only the clock moves on, by another series."""
    rule = replace(RULES[0], for_seconds=20)
    feed = Feed(stateful, lambda s: alerting.stream_alert_states(s, [rule], max_gap_seconds=30, delay="0 seconds"))
    start = 1_700_000_000
    assert feed.send([(start, "up", up(0), 0.0)]).where("by_timer").count() == 0
    feed.send([(start + 10, "clock", {}, 1.0)])
    assert feed.result(alerting.STATES).where("state = 'firing'").count() == 0
    fired = feed.send([(start + 25, "clock", {}, 1.0)]).where("state = 'firing'").collect()
    assert [(r.ts.timestamp(), r.by_timer) for r in fired] == [(start + 20, True)]
    # It is not told twice, and the next sample of the same breach fires by itself.
    rows = feed.send([(start + 28, "up", up(0), 0.0), (start + 40, "clock", {}, 1.0)])
    assert rows.where("state = 'firing'").count() == 2
    assert rows.where("state = 'firing' AND NOT by_timer").first().ts.timestamp() == start + 28


def test_silence_is_a_break(stateful):
    """The deadline lies beyond the gap, so nothing fires; the next breached sample begins anew."""
    rule = replace(RULES[0], for_seconds=60)
    feed = Feed(stateful, lambda s: alerting.stream_alert_states(s, [rule], max_gap_seconds=30, delay="0 seconds"))
    start = 1_700_000_000
    feed.send([(start, "up", up(0), 0.0)])
    feed.send([(start + 100, "clock", {}, 1.0)])
    rows = feed.send([(start + 101, "up", up(0), 0.0), (start + 130, "clock", {}, 1.0)])
    assert [r.state for r in rows.orderBy("ts").collect()] == ["pending", "pending"]


def test_state_is_forgotten(stateful):
    """After a silence longer than the gap the store holds no key."""
    feed = Feed(stateful, lambda s: alerting.stream_alert_states(s, [RULES[0]], max_gap_seconds=30, delay="0 seconds"))
    feed.send([(1_700_000_000 + 15 * i, "up", up(i % 3), 1.0) for i in range(30)])
    feed.finish()
    state = stateful.read.format("statestore").option("stateVarName", "last").load(feed.checkpoint)
    assert state.count() == 0


def test_long_series_lies_in_many_keys(spark, stateful):
    """A series over four days is kept by stretches of a day, packed; breaches and deadlines across their ends are those of the batch."""
    rule = replace(RULES[0], for_seconds=60)
    feed = Feed(stateful, lambda s: alerting.stream_alert_states(s, [rule], max_gap_seconds=40, delay="10 days"))
    rows = []
    for day in range(19_676, 19_680):
        midnight = day * 86_400
        rows += [(midnight + 15 * i, "up", up(0), float(not -9 <= i < 9)) for i in range(-20, 20)]
        # Silent over midnight, with a deadline ten seconds after it: until after the deadline, until it, beyond a gap.
        for series, back in ((1, 20), (2, 10), (3, 31)):
            rows += [(midnight + s, "up", up(series), 0.0) for s in (-50, -30, -10, back)]
    feed.send(rows)
    waiting = stateful.read.format("statestore").option("stateVarName", "waiting").load(feed.checkpoint)
    per_key = waiting.groupBy("key").count().collect()
    assert len(per_key) == 4 * 5 and all(r["count"] == 1 for r in per_key)
    found = feed.finish()
    samples = spark.createDataFrame([(float(t), m, lab, v) for t, m, lab, v in rows], "t double, metric string, labels map<string,string>, value double")
    samples = samples.select(F.timestamp_seconds("t").alias("ts"), "metric", "labels", "value")
    columns = ["alertname", "severity", "series", "ts", "value", "state"]
    batch = alerts.alert_states(samples, [rule], max_gap_seconds=40).select(*columns).collect()
    assert sorted(map(key, found.where("NOT by_timer").select(*columns).collect())) == sorted(map(key, batch))
    timed = found.where("by_timer").selectExpr("regexp_extract(series, 'broker-(.)', 1)", "unix_seconds(ts) % 86400").collect()
    assert sorted(map(tuple, timed)) == [("1", 10)] * 4 + [("3", 10)] * 4


def test_no_enabled_rule(stateful):
    with pytest.raises(ValueError, match="no enabled rule"):
        alerting.stream_alert_states(stateful.readStream.format("rate").load(), [replace(RULES[0], enabled=False)])
