"""Keyed messages to a topic, or to a table of the same shape."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions.hashtags import partition_key
from touchline.operators.flatten import flatten_tweets
from touchline.operators.posts import to_kafka_frame
from touchline.schemas import HEADERS_TYPE, MESSAGE_SCHEMA
from touchline.sinks.slots import slot
from touchline.vocabulary import TOPIC_AUDIT, TOPIC_BRONZE, TOPIC_SILVER

logger = logging.getLogger(__name__)

# Producer delivery settings.
PRODUCER_OPTIONS = {
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.delivery.timeout.ms": "120000",
    "kafka.linger.ms": "20",
    "kafka.compression.type": "zstd",
}


@dataclass(frozen=True)
class MessageTarget:
    """Where messages go: brokers, or a folder holding one table per topic."""

    brokers: str | None = None
    folder: str | None = None
    options: dict[str, str] = field(default_factory=lambda: dict(PRODUCER_OPTIONS))

    def topic_path(self, topic: str) -> str:
        return f"{self.folder}/{topic}"

    def write(
        self, messages: DataFrame, topic: str, batch_id: int, producer: str, run: str | None = None
    ) -> None:
        """Write ``key, value[, headers]``.

        In a folder each producer, run and batch has a place of its own, which a retried
        batch replaces; so producers share a topic, and a new checkpoint adds to it. A
        topic of brokers is at-least-once; readers deduplicate.
        """
        if self.brokers:
            writer = messages.write.format("kafka").options(**self.options)
            writer.option("kafka.bootstrap.servers", self.brokers).option("topic", topic).save()
            return
        if "headers" not in messages.columns:
            messages = messages.withColumn("headers", F.lit(None).cast(HEADERS_TYPE))
        if "key" not in messages.columns:
            messages = messages.withColumn("key", F.lit(None).cast("binary"))
        shaped = messages.select(
            F.col("key").cast("binary"), F.col("value").cast("string"), F.col("headers")
        )
        place = slot(messages, batch_id, run, producer)
        # A message holds its post twice, flat and as payload, which this codec sees.
        shaped.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.topic_path(topic)}/{place}")

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        """The messages of a topic kept in a folder."""
        messages = spark.read.schema(MESSAGE_SCHEMA).parquet(self.topic_path(topic))
        return messages.select(*MESSAGE_SCHEMA.fieldNames())


class SilverPublisher:
    """``foreachBatch`` sink: enriched rows to the silver topic, keyed by post id."""

    def __init__(self, target: MessageTarget, topic: str = TOPIC_SILVER, run: str | None = None) -> None:
        self._target = target
        self._topic = topic
        self._run = run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        self._target.write(to_kafka_frame(batch_df), self._topic, batch_id, "enrichment", self._run)
        logger.info("batch %s published to %s", batch_id, self._topic)


def flattened(valid: DataFrame, body: str = "value", raw: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid nested posts as flat messages keyed by author, and those that cannot be flattened.

    The latter (an empty id, for one) carry the reason in ``errors``, ready for the audit.
    """
    flat = flatten_tweets(valid, body, author="_author", raw=raw)
    failed = F.col("flatten_error").isNotNull()
    messages = flat.where(~failed).select(partition_key("_author").alias("key"), F.col("flat").alias("value"))
    rejected = flat.where(failed).withColumn("errors", F.array("flatten_error"))
    return messages, rejected.drop("flat", "flatten_error", "_author")


def publish_bronze(
    messages: DataFrame,
    target: MessageTarget,
    batch_id: int,
    run: str | None = None,
    producer: str = "collector",
    together: bool = False,
) -> None:
    """Flat messages to the bronze topic.

    In a folder, an author's posts are brought together by ``rebalance``, which
    splits an author too large for one partition; not so where they lie ``together`` already.
    """
    if not target.brokers and not together:
        messages = messages.hint("rebalance", "key")
    target.write(messages, TOPIC_BRONZE, batch_id, producer, run)


def publish_audit(
    events: DataFrame, target: MessageTarget, batch_id: int, producer: str, run: str | None = None
) -> None:
    """Audit messages with their type header to the audit topic, which several producers share."""
    target.write(events, TOPIC_AUDIT, batch_id, producer, run)
