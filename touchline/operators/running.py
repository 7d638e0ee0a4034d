"""Running totals over long series without one task per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import stored


def running_total(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], value: str, output: str
) -> DataFrame:
    """Sum of ``value`` up to and including each row, per key, in time order.

    A plain window would put a whole key into one task. Here the rows are range-partitioned
    by key and order, so a busy key is cut wherever its rows are many, even at one time
    stamp. Rows are summed inside their part, and the total of all earlier parts comes
    from a window over one row per key and part. The parts are written once, so that both
    readings see the same cuts, also after the loss of an executor.
    """
    keys = list(keys)
    by = [*keys, ts, *order]
    placed = stored(df.repartitionByRange(*by).withColumn("_part", F.spark_partition_id()), "running")
    per_part = placed.groupBy(*keys, "_part").agg(F.sum(value).alias("_part_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_part.select(
        *[F.col(c).alias(f"_c_{c}") for c in (*keys, "_part")],
        F.coalesce(F.sum("_part_sum").over(before), F.lit(0)).alias("_carry"),
    )
    # Null-safe, so that rows without a key keep their place.
    same_part = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in (*keys, "_part")]
    inside = (
        Window.partitionBy(*keys, "_part")
        .orderBy(ts, *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(carried, same_part)
        .withColumn(output, F.col("_carry") + F.sum(value).over(inside))
        .drop("_carry", "_part", *[f"_c_{c}" for c in (*keys, "_part")])
    )
