"""Summaries that can be merged: distinct authors by day, latency quantiles by hour, and frequent keys.

A summary row is made once, from the rows of its day, hour or batch. Longer ranges are merged from summary rows alone, so a
new day adds one row and no old post is read again. Distinct counts and quantiles have a stated error; frequent keys are
found without error, as a second pass counts the few candidates exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import stored
from touchline.sinks.slots import slot

#: Registers of a distinct-count sketch (as a power of two), and its relative standard error.
LG_REGISTERS = 12
DISTINCT_ERROR = 1.04 / math.sqrt(1 << LG_REGISTERS)
#: Size of a quantile sketch, and the rank error it keeps in 99 of 100 cases.
QUANTILE_K = 200
RANK_ERROR = 0.0165

SUMMARY = "key string, n bigint, lost bigint, total bigint"


# --- distinct authors --------------------------------------------------------------


def author_sketches(posts: DataFrame, day: Column, by: Sequence[str] = (), author: str = "author_id") -> DataFrame:
    """(day, by.., posts, authors): one row per day, with a sketch of its different non-empty authors."""
    named = F.nullif(F.col(author).cast("string"), F.lit(""))
    return posts.groupBy(day.alias("day"), *by).agg(
        F.count("*").alias("posts"), F.hll_sketch_agg(named, LG_REGISTERS).alias("authors")
    )


def authors_between(sketches: DataFrame, first: str | None = None, last: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(by.., posts, authors) of the days from ``first`` to ``last``: posts exactly, authors within ``DISTINCT_ERROR``."""
    rows = sketches
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last).cast("date"))
    merged = rows.groupBy(*by).agg(F.sum("posts").alias("posts"), F.hll_union_agg("authors").alias("authors"))
    return merged.withColumn("authors", F.hll_sketch_estimate("authors"))


# --- latency quantiles -------------------------------------------------------------


def latency_sketches(df: DataFrame, seconds: str, ts: str, by: Sequence[str]) -> DataFrame:
    """(hour, by.., n, latencies): one row per hour and group, with a sketch of the latencies."""
    rows = df.where(F.col(seconds).isNotNull())
    return rows.groupBy(F.date_trunc("hour", ts).alias("hour"), *by).agg(
        F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(seconds).cast("double"), QUANTILE_K).alias("latencies")
    )


def latency_quantiles(sketches: DataFrame, by: Sequence[str], shares: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    """(by.., n, share, seconds): the latency below which a share of the rows lies, within ``RANK_ERROR`` of the share."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("latencies").alias("_merged"))
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("share"), F.kll_sketch_get_quantile_double("_merged", F.lit(s)).alias("seconds"))
            for s in shares
        ]
    )
    return merged.select(*by, "n", F.inline(rows))


# --- frequent keys -----------------------------------------------------------------


def _counters(share: float):
    """Counts of a task's keys in at most ``2 / share`` counters, and how much each may have lost."""
    size = math.ceil(2 / share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, lost, total = np.zeros(0, dtype=object), np.zeros(0, dtype=np.int64), 0, 0
        for batch in batches:
            found = batch.column(0).drop_null().value_counts()
            more, times = found.field("values").to_numpy(zero_copy_only=False), found.field("counts").to_numpy()
            total += int(times.sum())
            keys, at = np.unique(np.concatenate([keys, more.astype(object)]), return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, at, np.concatenate([n, times]))
            n = sums
            if len(n) > size:  # all counters give up as much as the first that must go
                cut = int(np.partition(n, len(n) - size - 1)[len(n) - size - 1])
                keys, n, lost = keys[n > cut], n[n > cut] - cut, lost + cut
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([*keys, None], pa.string()),
                pa.array([*n.tolist(), 0], pa.int64()),
                pa.array([0] * len(n) + [lost], pa.int64()),
                pa.array([0] * len(n) + [total], pa.int64()),
            ],
            names=["key", "n", "lost", "total"],
        )

    return count


def key_summary(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, n, lost, total): bounded counters of each task; the row without key has what was lost and seen."""
    return df.select(F.col(key).cast("string")).mapInArrow(_counters(share), SUMMARY)


def key_candidates(summary: DataFrame, share: float) -> DataFrame:
    """(key, total) of all keys that may have more than ``share`` of the rows seen, and no more than ``2 / share + 1`` keys.

    A task of ``t`` rows loses at most ``t * share / 2`` of a key, and so do all tasks together of the sum.
    """
    seen = summary.where("key IS NULL").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("lost"), F.lit(0))).first()
    total, lost = int(seen[0]), int(seen[1])
    counted = summary.where("key IS NOT NULL").groupBy("key").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") + lost > F.lit(share) * total).select("key", F.lit(total).cast("bigint").alias("total"))


def heavy_hitters(df: DataFrame, key: str, share: float, summary: DataFrame | None = None) -> DataFrame:
    """(key, n): exactly the keys with more than ``share`` of the rows that have one, and their counts.

    ``summary`` may come from earlier batches of the same rows. The candidates are few by construction and are broadcast.
    """
    held = stored(summary if summary is not None else key_summary(df, key, share), "key-summary")
    few = key_candidates(held, share)
    met = df.select(F.col(key).cast("string").alias("key")).join(F.broadcast(few), "key")
    counted = met.groupBy("key", "total").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > F.lit(share) * F.col("total")).select("key", "n")


class KeySummarySink:
    """``foreachBatch`` sink: the bounded counters of each batch, in a folder that a repeated batch replaces."""

    def __init__(self, path: str, key: str, share: float, run: str | None = None) -> None:
        self._path, self._key, self._share, self._run = path, key, share, run

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        rows = key_summary(batch_df, self._key, self._share)
        rows.write.mode("overwrite").parquet(f"{self._path}/{slot(batch_df, batch_id, self._run)}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(SUMMARY).parquet(self._path).select("key", "n", "lost", "total")
