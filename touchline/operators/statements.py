"""The staging table in SQL: a view of it, and the four published questions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from touchline.sinks.tables import read_staging

TOP_ENGAGED = """
    SELECT tweet_id, engagement, themes, hashtags, created_at FROM {table}
    WHERE size(themes) > 0 ORDER BY engagement DESC, tweet_id LIMIT 50"""
TOTAL = "SELECT count(*) AS total FROM {table}"
THEMES = """
    SELECT theme, count(*) AS n FROM {table} LATERAL VIEW explode(themes) t AS theme
    GROUP BY theme ORDER BY n DESC, theme"""
DUPLICATES = """
    SELECT tweet_id, count(*) AS n FROM {table}
    GROUP BY tweet_id HAVING count(*) > 1 ORDER BY n DESC, tweet_id LIMIT 50"""


def register_staging(spark: SparkSession, path: str, view: str = "tweets") -> str:
    """Make the staging table known to ``spark.sql`` under a name."""
    read_staging(spark, path).createOrReplaceTempView(view)
    return view
