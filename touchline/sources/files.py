"""Batch and file-stream sources: archive, logs, profiles, response pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType, VariantType

from touchline.operators.profiles import normalize_profiles
from touchline.schemas import PAGE_SCHEMA

# Declared as text so that a partition value such as 03 is not read as 3.
_DATE_PARTITIONS = [StructField(n, StringType(), True) for n in ("year", "month", "day")]


def read_raw_archive(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Date-partitioned NDJSON; filters on ``year``, ``month``, ``day`` prune folders."""
    full = StructType([*schema.fields, *_DATE_PARTITIONS])
    return spark.read.schema(full).json(path).select(*full.fieldNames())


def read_variant_archive(spark: SparkSession, path: str) -> DataFrame:
    """``body`` (VARIANT), ``text`` of what is not JSON, and the date parts, whose filters prune folders."""
    full = StructType([StructField("body", VariantType(), True), StructField("text", StringType(), True), *_DATE_PARTITIONS])
    return spark.read.schema(full).parquet(path)


def read_app_logs(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Log files of a folder as a stream of lines in ``value``.

    Rotated or completed files are picked up as they appear.
    """
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_profiles(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Profile objects, one JSON per line, as typed rows."""
    return normalize_profiles(spark.read.text(path), keep=keep)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored search responses ``(run_id, page, body)``."""
    return spark.read.schema(PAGE_SCHEMA).json(path)
