"""Streaming scan of the bronze topic and its configuration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from touchline.session import scratch_root
from touchline.vocabulary import TOPIC_BRONZE

_TEXT = StructType([StructField("value", StringType(), True)])


@dataclass(frozen=True)
class StreamConfig:
    """Settings of a streaming job. ``source_path`` turns the topic into a folder of
    NDJSON files, for tests and replays without a broker."""

    brokers: str = "localhost:9092"
    topic: str = TOPIC_BRONZE
    starting_offsets: str = "latest"
    #: Offsets of a micro-batch, or files where the source is a folder; None: all there are.
    max_offsets_per_trigger: int | None = None
    checkpoint_location: str | None = None
    trigger_interval: str = "30 seconds"
    project: str = "local-project"
    staging_table: str = "local-project.twitter_staging.tweets"
    source_path: str | None = None
    #: A log file to follow, and whether what it holds at the first start counts.
    log_file: str = "/app/logs/ingestion.log"
    log_from_start: bool = False
    #: Address of the warehouse, if not its own; empty counts as not given.
    api_endpoint: str | None = None

    def checkpoint(self, spark: SparkSession) -> str:
        """Checkpoints default to the folder the cluster shares, never to a local one."""
        return self.checkpoint_location or f"{scratch_root(spark)}/checkpoints/{self.topic}"

    def trigger(self) -> dict[str, str | bool]:
        if self.trigger_interval == "availableNow":
            return {"availableNow": True}
        return {"processingTime": self.trigger_interval}


# Environment variable -> setting.
_ENV = {
    "KAFKA_BROKERS": "brokers",
    "TOPIC_NAME": "topic",
    "STARTING_OFFSETS": "starting_offsets",
    "MAX_OFFSETS_PER_TRIGGER": "max_offsets_per_trigger",
    "CHECKPOINT_LOCATION": "checkpoint_location",
    "TRIGGER_INTERVAL": "trigger_interval",
    "GCP_PROJECT_ID": "project",
    "BQ_TABLE": "staging_table",
    "SOURCE_PATH": "source_path",
    "LOG_FILE": "log_file",
    "LOG_FROM_START": "log_from_start",
    "BQ_API_ENDPOINT": "api_endpoint",
}


def config_from_env(env: Mapping[str, str]) -> StreamConfig:
    """Settings from the environment."""
    given: dict[str, object] = {name: env[var] for var, name in _ENV.items() if var in env}
    if "max_offsets_per_trigger" in given:
        given["max_offsets_per_trigger"] = int(env["MAX_OFFSETS_PER_TRIGGER"])
    if "log_from_start" in given:
        given["log_from_start"] = env["LOG_FROM_START"].lower() == "true"
    if not given.get("api_endpoint"):
        given.pop("api_endpoint", None)
    config = StreamConfig(**given)
    if "staging_table" not in given:
        config = replace(config, staging_table=f"{config.project}.twitter_staging.tweets")
    return config


def source_options(config: StreamConfig) -> dict[str, str]:
    """Kafka reader options."""
    options = {
        "kafka.bootstrap.servers": config.brokers,
        "subscribe": config.topic,
        "startingOffsets": config.starting_offsets,
        "includeHeaders": "true",
    }
    if config.max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    return options


def read_tweets(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """The topic as a streaming DataFrame with its payload in ``value``.

    From a folder the limit of a micro-batch counts files, oldest first; a start at ``latest`` is
    not possible there, all files are read.
    """
    if config.source_path is None:
        return spark.readStream.format("kafka").options(**source_options(config)).load()
    reader = spark.readStream.schema(_TEXT).format("text")
    if config.max_offsets_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", config.max_offsets_per_trigger)
    return reader.load(config.source_path)
