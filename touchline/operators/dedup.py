"""Keeping one version of each post, and dropping what has aged out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.vocabulary import RETENTION_DAYS


def latest_by_key(
    df: DataFrame, key: str = "tweet_id", order: Sequence[str | Column] = ("processed_at",)
) -> DataFrame:
    """The newest row of each key; later columns of ``order`` break ties.

    Spark applies the rank-1 limit before the shuffle as well as after it, so a
    key with very many copies sends one row per task. Rows without a key are copies of
    nothing, and all stay.
    """
    newest_first = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    window = Window.partitionBy(key).orderBy(*newest_first)
    keyed = df.where(F.col(key).isNotNull()).withColumn("_rank", F.row_number().over(window))
    return keyed.where("_rank = 1").drop("_rank").unionByName(df.where(F.col(key).isNull()))


def apply_retention(
    df: DataFrame, topic: str, ts: str = "timestamp", now: Column | None = None
) -> DataFrame:
    """Rows inside the topic's retention period.

    ``now`` defaults to the newest time stamp in the data, as a scalar subquery.
    """
    newest = now if now is not None else df.select(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.make_dt_interval(F.lit(RETENTION_DAYS[topic])))


def drop_expired_partitions(
    spark: SparkSession, table: str, topic: str, today: date
) -> list[str]:
    """Drop day partitions of a catalog table that are past the topic's retention.

    Works on the partition list alone (one entry per day); no data is read.
    """
    oldest = today - timedelta(days=RETENTION_DAYS[topic])
    dropped = []
    for (spec,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = dict(p.split("=", 1) for p in spec.split("/"))
        if date(int(parts["year"]), int(parts["month"]), int(parts["day"])) < oldest:
            values = ", ".join(f"{k}='{v}'" for k, v in parts.items())
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({values})")
            dropped.append(spec)
    return dropped
