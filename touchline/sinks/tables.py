"""Staging table sink, fan-out, raw archive and run summaries."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.schemas import STAGING_COLUMNS, STAGING_SCHEMA
from touchline.session import stored
from touchline.sinks.slots import slot
from touchline.vocabulary import ARCHIVE_ROTATION, ARCHIVE_TIME_ZONE

logger = logging.getLogger(__name__)

BatchSink = Callable[[DataFrame, int], None]


class StagingTableSink:
    """``foreachBatch`` sink writing from the executors, one folder per run and batch.

    A batch replaces its own folder, so a retry after a failure leaves each row
    once; another checkpoint is another run and adds to the table. Inside, rows lie by
    the date of their processing. Write errors propagate and fail the batch.
    """

    def __init__(self, path: str, run: str | None = None) -> None:
        self._path = path
        self._run = run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        dated = batch_df.withColumn("date", F.to_date("processed_at"))
        folder = f"{self._path}/{slot(batch_df, batch_id, self._run)}"
        dated.write.mode("overwrite").partitionBy("date").parquet(folder)
        logger.info("batch %s written to %s", batch_id, folder)


def read_staging(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The staging columns; with ``since`` only dates from then on are looked at."""
    rows = spark.read.schema(STAGING_SCHEMA).parquet(path)
    if since is not None:
        rows = rows.where(F.col("date") >= F.lit(since).cast("date"))
    return rows.select(*STAGING_COLUMNS)


def compact_staging(spark: SparkSession, path: str, into: str, before: str) -> None:
    """Copy all rows processed before a date into few files per date below ``into``.

    A repeated call replaces the same dates. ``into`` reads like the table itself; the
    folders of the copied batches can then be dropped by the caller.
    """
    rows = spark.read.schema(STAGING_SCHEMA).parquet(path)
    old = rows.where(F.col("date") < F.lit(before).cast("date")).select(*STAGING_COLUMNS, "date")
    (
        old.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(into)
    )


class DualSink:
    """Two sinks under one checkpoint, the replayable one first.

    The batch is computed once. If the first sink fails the second is not called;
    either failure propagates, and the cached batch is always released.
    """

    def __init__(self, first: BatchSink, second: BatchSink) -> None:
        self._sinks = (first, second)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        batch_df.persist()
        try:
            for sink in self._sinks:
                sink(batch_df, batch_id)
        finally:
            batch_df.unpersist()


def date_partitions(moment: Column, zone: str = "UTC") -> dict[str, Column]:
    """``year``, ``month``, ``day`` text columns of a UTC time stamp in ``zone``."""
    local = moment if zone == "UTC" else F.from_utc_timestamp(moment, zone)
    return {
        "year": F.date_format(local, "yyyy"),
        "month": F.date_format(local, "MM"),
        "day": F.date_format(local, "dd"),
    }


def log_failure(error: Exception) -> None:
    """For ``write_raw_archive``: a failed archive must not stop a collection."""
    logger.error("raw archive write failed", exc_info=error)


def write_raw_archive(
    posts: DataFrame,
    path: str,
    ingested_at: Column | None = None,
    on_error: Callable[[Exception], None] | None = None,
    body: str | None = None,
    computed: bool = False,
) -> int:
    """Append posts, before validation, as NDJSON below ``year=/month=/day=``.

    ``body`` names a column that holds a post's JSON already; else a post is its columns.

    Returns the number of rows written, counted by the write itself. Errors propagate.
    With ``on_error`` the input is first written to the shared folder, so that errors of the query
    itself still propagate; what fails after that is the storage, goes to ``on_error``, and gives 0. A caller whose
    posts are a stored table already says so by ``computed``.
    """
    moment = ingested_at if ingested_at is not None else F.current_timestamp()
    written = Observation()
    kept = posts if on_error is None or computed else stored(posts, "archived")
    brought = (
        kept.withColumns(date_partitions(moment))
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .hint("rebalance", "year", "month", "day")
    )
    try:
        if body is not None:
            brought = brought.select(body, "year", "month", "day")
        writer = brought.write.mode("append").partitionBy("year", "month", "day")
        writer.json(path) if body is None else writer.text(path)
        return written.get["rows"]
    except Exception as error:
        if on_error is None:
            raise
        on_error(error)
        return 0


def write_variant_archive(
    posts: DataFrame,
    path: str,
    ingested_at: Column | None = None,
    on_error: Callable[[Exception], None] | None = None,
    body: str = "post",
) -> int:
    """Append posts as VARIANT in Parquet below ``year=/month=/day=``; returns the number of rows written.

    Readers take single fields without parsing text. ``posts`` is a stored table whose column ``body`` is the parsed post; rows
    that are not JSON have their text in ``value``. Files follow the tasks that write them: a collection has one
    ``ingested_at``, so its posts go to one folder without a shuffle.
    """
    moment = ingested_at if ingested_at is not None else F.current_timestamp()
    written = Observation()
    parts = date_partitions(moment)
    rows = posts.select(F.col(body).alias("body"), F.when(F.col(body).isNull(), F.col("value")).alias("text"), *(c.alias(n) for n, c in parts.items()))
    try:
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("append").option("compression", "zstd").partitionBy(*parts).parquet(path)
        return written.get["rows"]
    except Exception as error:
        if on_error is None:
            raise
        on_error(error)
        return 0


def archive_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    records_per_file: int = 1_000_000,
    trigger: dict[str, str | bool] | None = None,
) -> StreamingQuery:
    """Archive JSON messages by record day in the archive's time zone.

    ``messages`` has ``value`` and ``timestamp``. Each micro-batch replaces its own folder
    below the run's, so a retry adds nothing, and no list of files grows on the
    driver. The published file size of 100 records is available as ``ARCHIVE_RECORDS_PER_FILE``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.hint("rebalance", "year", "month", "day")
            .write.mode("overwrite")
            .partitionBy("year", "month", "day")
            .option("maxRecordsPerFile", records_per_file)
            .text(f"{path}/{slot(batch, batch_id)}")
        )

    lines = messages.withColumns(date_partitions(F.col("timestamp"), ARCHIVE_TIME_ZONE)).select(
        F.col("value").cast("string").alias("value"), "year", "month", "day"
    )
    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": ARCHIVE_ROTATION}))
        .outputMode("append")
        .start()
    )


def archive_counts(archive: DataFrame) -> DataFrame:
    """Archived rows per day."""
    return archive.groupBy("year", "month", "day").agg(F.count("*").alias("n"))


def write_run_summary(summary: DataFrame, path: str, arguments: dict[str, str] | None = None) -> None:
    """Run summaries as JSON, with the arguments the run was started with."""
    for name, value in (arguments or {}).items():
        summary = summary.withColumn(f"arg_{name}", F.lit(value))
    summary.write.mode("overwrite").json(path)
