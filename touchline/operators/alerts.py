"""Threshold-for-duration alerts over metric samples, and their notifications."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCRAPE_SECONDS = 15


@dataclass(frozen=True)
class AlertRule:
    name: str
    metric: str
    compare: str
    threshold: float
    for_seconds: int
    severity: str
    label: str | None = None
    label_pattern: str | None = None
    sum_series: bool = False
    enabled: bool = True

    def breached(self, value: Column) -> Column:
        tests = {
            "==": value == self.threshold,
            "!=": value != self.threshold,
            ">": value > self.threshold,
            "<": value < self.threshold,
        }
        return tests[self.compare]

    def applies(self) -> Column:
        test = F.col("metric") == self.metric
        if self.label:
            label = F.try_element_at("labels", F.lit(self.label))
            test = test & F.coalesce(label.rlike(f"^(?:{self.label_pattern})$"), F.lit(False))
        return test


# The monitoring rules. The lag rule is off by default because no
# exporter supplies its metric.
RULES: tuple[AlertRule, ...] = (
    AlertRule("kafkaBrokerDown", "up", "==", 0, 60, "critical", "job", "kafka-broker-.*"),
    AlertRule(
        "kafkaUnderReplicatedPartitions", "kafka_broker_under_replicated_partitions", ">", 0, 120, "warning"
    ),
    AlertRule(
        "kafkaControllerNotActive", "kafka_controller_active_count", "!=", 1, 60, "critical", sum_series=True
    ),
    AlertRule(
        "kafkaHighConsumerLag", "kafka_consumergroup_lag", ">", 1000, 300, "warning",
        "topic", "tweets_raw", enabled=False,
    ),
    AlertRule("kafkaLowIncomingMessages", "kafka_broker_messages_in_per_sec", "<", 1, 600, "warning"),
)
# Notification routing.
REPEAT_SECONDS = 3600
RECEIVER_DEFAULT = "slack-alerts"
RECEIVER_CRITICAL = "slack-critical"


def controllers_active(samples: DataFrame, metric: str = "kafka_controller_active_count") -> DataFrame:
    """Sum over all brokers per scrape, and whether it differs from one."""
    total = samples.where(F.col("metric") == metric).groupBy("ts").agg(F.sum("value").alias("active"))
    return total.withColumn("breached", F.col("active") != 1)


def _series(labels: str) -> Column:
    pairs = F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.array_join(F.array_sort(pairs), ",")


def evaluated(samples: DataFrame, rules: Sequence[AlertRule]) -> DataFrame:
    """One row per sample and rule that looks at it: does it breach the threshold?"""

    def outcome(rule: AlertRule) -> Column:
        return F.when(
            rule.applies(),
            F.struct(
                F.lit(rule.name).alias("alertname"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.for_seconds).cast("long").alias("for_seconds"),
                rule.breached(F.col("value")).alias("breached"),
            ),
        )

    return samples.select(
        "ts",
        _series("labels").alias("series"),
        "value",
        F.inline(F.array_compact(F.array(*[outcome(r) for r in rules]))),
    )


def alert_states(
    samples: DataFrame,
    rules: Sequence[AlertRule] = RULES,
    max_gap_seconds: int = 2 * SCRAPE_SECONDS,
) -> DataFrame:
    """``inactive``, ``pending`` or ``firing`` for every sample and rule.

    A rule fires once its condition has held without a break for its duration; a
    gap above ``max_gap_seconds`` is a break. Only the last stretch of
    ``longest duration + gap`` can matter for a sample, so series are cut into
    time chunks and each chunk gets that much of the one before as context. A long
    series therefore never sits in one task, and there is a single shuffle.
    """
    rules = [r for r in rules if r.enabled]
    if not rules:
        raise ValueError("no enabled rule")
    plain = [r for r in rules if not r.sum_series]
    parts = [evaluated(samples, plain)] if plain else []
    for rule in (r for r in rules if r.sum_series):
        total = samples.where(rule.applies()).groupBy("ts", "metric").agg(F.sum("value").alias("value"))
        labelled = total.withColumn("labels", F.expr("CAST(map() AS MAP<STRING,STRING>)"))
        parts.append(evaluated(labelled, [rule]))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)

    context = max(r.for_seconds for r in rules) + max_gap_seconds
    chunk = max(3600, 4 * context)
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)
    chunked = (
        rows.withColumn("_t", seconds)
        .withColumn("_home", F.floor(F.col("_t") / chunk))
        .withColumn("_next", F.floor((F.col("_t") + context) / chunk))
        .withColumn("_chunk", F.explode(F.array_distinct(F.array("_home", "_next"))))
    )
    window = Window.partitionBy("alertname", "series", "_chunk").orderBy("_t")
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    previous = F.lag("breached").over(window)
    gap = F.col("_t") - F.lag("_t").over(window)
    starts = F.col("breached") & (previous.isNull() | ~previous | (gap > max_gap_seconds))
    held = F.col("_t") - F.col("_since")
    return (
        chunked.withColumn("_start", F.when(starts, F.col("_t")))
        .withColumn("_since", F.last("_start", ignorenulls=True).over(so_far))
        .where(F.col("_chunk") == F.col("_home"))
        .select(
            "alertname",
            "severity",
            "series",
            "ts",
            "value",
            F.when(~F.col("breached"), F.lit("inactive"))
            .when(held >= F.col("for_seconds"), F.lit("firing"))
            .otherwise(F.lit("pending"))
            .alias("state"),
        )
    )


def group_alerts(states: DataFrame, repeat_seconds: int = REPEAT_SECONDS, chunk_seconds: int = 86_400) -> DataFrame:
    """Notifications: one per firing episode of an alert and repeat interval in it.

    Alerts are grouped by name and severity. An episode begins when one of the group's
    series fires after none did, and ends when none does; repeats count from its beginning.
    Samples are first summed per time stamp. These rows are cut into time chunks; what a chunk needs
    of those before it, the last state and the last beginning, comes from a window over one row per chunk.
    Critical alerts go to their own receiver.
    """
    group = ["alertname", "severity"]
    fires = F.col("state") == "firing"
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1_000_000.0)
    per_ts = (
        states.groupBy(*group, "ts")
        .agg(F.bool_or(fires).alias("fires"), F.count_if(fires).alias("samples"))
        .withColumn("_chunk", F.floor(seconds / chunk_seconds))
    )
    inside = Window.partitionBy(*group, "_chunk").orderBy("ts")
    chunks = Window.partitionBy(*group).orderBy("_chunk")
    ended = per_ts.groupBy(*group, "_chunk").agg(F.max_by("fires", "ts").alias("_last"))
    ended = ended.select(*group, "_chunk", F.lag("_last").over(chunks).alias("_carried"))
    before = F.coalesce(F.lag("fires").over(inside), F.col("_carried"), F.lit(False))
    begun = per_ts.join(ended, [*group, "_chunk"]).withColumn("_start", F.when(F.col("fires") & ~before, F.col("ts")))
    starts = begun.groupBy(*group, "_chunk").agg(F.max("_start").alias("_latest"))
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(*group, "_chunk", F.max("_latest").over(earlier).alias("_before"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    since = F.coalesce(F.max("_start").over(so_far), F.col("_before"))
    repeat = F.floor((F.unix_micros("ts") - F.unix_micros("_since")) / F.lit(repeat_seconds * 1_000_000))
    receiver = F.when(F.col("severity") == "critical", F.lit(RECEIVER_CRITICAL)).otherwise(F.lit(RECEIVER_DEFAULT))
    return (
        begun.join(starts, [*group, "_chunk"])
        .withColumn("_since", since)
        .where("fires")
        .groupBy(*group, "_since", repeat.alias("repeat"))
        .agg(F.min("ts").alias("notified_at"), F.sum("samples").alias("samples"))
        .withColumn("receiver", receiver)
        .drop("_since")
    )
