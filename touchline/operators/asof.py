"""As-of joins: each row of one side with the latest earlier row of the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.schemas import PROFILE_LOOKUP_COLUMNS
from touchline.session import stored


def as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    values: Sequence[str],
    order: Sequence[str] = (),
    tie: Sequence[str] = (),
    output: str = "as_of",
) -> DataFrame:
    """``left`` with ``output``: the ``values`` of the latest row of ``right`` with the same keys and ``right_ts <= left_ts``.

    Both sides become one sequence per key, in the order of time. Its rows are range-partitioned by key and time, so a busy
    key is cut wherever its rows are many; ``order`` names columns of ``left`` that allow cuts at one time stamp. Inside a
    part the last value is carried from row to row; what a part needs from the earlier ones comes from a window over one
    row per key and part. No row meets more than one other, however many versions a key has. The parts are written once, so that
    both readings see the same cuts.

    Of several rows of ``right`` at one time the one with the highest ``tie`` counts. Rows of ``right`` without key or
    time match nothing; rows of ``left`` without them stay, with null.
    """
    keys, tie = list(keys), list(tie)
    names = [f"_k{i}" for i in range(len(keys))]
    spread = [f"_o{i}" for i in range(len(order))]
    rows = left.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(left_ts).alias("_t"),
        F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_row"),
        *[F.col(c).alias(n) for c, n in zip(order, spread, strict=True)],
    )
    known = right.dropna(subset=[*keys, right_ts]).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(right_ts).alias("_t"),
        F.lit(0).alias("_side"),
        F.struct(F.col(right_ts).alias("_t"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)]).alias("_rank"),
        F.struct(*[F.col(c) for c in values]).alias("_value"),
    )
    by = [*names, "_t", "_side", *spread]
    together = rows.unionByName(known, allowMissingColumns=True)
    placed = stored(together.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "as-of")

    last = placed.where("_side = 0").groupBy(*names, "_part").agg(F.max_by("_value", "_rank").alias("_last"))
    # Parts without a version need the carried one as well.
    parts = placed.groupBy(*names, "_part").agg(F.count("*").alias("_rows")).drop("_rows")
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"l.{c}")) for c in (*names, "_part")]
    filled = parts.alias("p").join(last.alias("l"), same, "left").select("p.*", "_last")
    before = Window.partitionBy(*names).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = filled.select(
        *[F.col(c).alias(f"_c{c}") for c in (*names, "_part")],
        F.last("_last", ignorenulls=True).over(before).alias("_carried"),
    )
    inside = (
        Window.partitionBy(*names, "_part")
        .orderBy("_t", "_side", "_rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.withColumn("_inside", F.last("_value", ignorenulls=True).over(inside))
        .where("_side = 1")
        .join(carried, [F.col(c).eqNullSafe(F.col(f"_c{c}")) for c in (*names, "_part")])
        .select("_row.*", F.coalesce("_inside", "_carried").alias(output))
    )


def merge_profiles_as_of(
    tweets: DataFrame,
    versions: DataFrame,
    ts: str = "created_at",
    valid_from: str = "valid_from",
    author: str = "author_id",
    order: Sequence[str] = ("tweet_id",),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Posts with the author's profile as it was at the time of the post: ``user_*`` columns and ``enriched``.

    ``versions`` has any number of rows per ``user_id``, each valid from its time until the next one.
    """
    keyed = tweets.withColumn("_author", F.nullif(F.col(author), F.lit("")))
    named = versions.withColumn("_author", F.nullif(F.col("user_id"), F.lit("")))
    met = as_of(keyed, named, ["_author"], ts, valid_from, PROFILE_LOOKUP_COLUMNS, order, tie, "_profile")
    return met.select(
        *tweets.columns,
        *[F.col("_profile")[c].alias(f"user_{c}") for c in PROFILE_LOOKUP_COLUMNS],
        F.when(F.col("_profile").isNotNull(), F.lit(True)).alias("enriched"),
    )
