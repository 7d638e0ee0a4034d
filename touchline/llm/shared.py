"""Tables in the shared folder, row keys, and bit maps of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: later steps start there.

    A lost executor then costs a reread and not a recomputation, and the plan stays short.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column | str = "text") -> Column:
    """Tells apart rows that share a ``doc_id``; null and empty texts are alike."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def bit_maps(hashed: DataFrame, bits: int) -> list[np.ndarray]:
    """Two maps of ``2 ** bits`` bits: of each hash (column ``h``), and of those that are ``also`` true.

    Spark sets the bits; at most ``2 ** bits / 64`` words reach the driver, whatever
    the number of rows. Only rows whose bit is clear are known to be absent.
    """
    at = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    rows = (
        hashed.select(F.shiftright(at, 6).alias("word"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"), "also")
        .groupBy("word")
        .agg(
            F.expr("bit_or(shiftleft(1L, bit))").alias("every"),
            F.expr("bit_or(IF(also, shiftleft(1L, bit), 0L))").alias("also"),
        )
        .toArrow()
    )
    out = [np.zeros(1 << (bits - 6), dtype=np.uint64) for _ in range(2)]
    if rows.num_rows:
        for words, name in zip(out, ("every", "also"), strict=True):
            words[rows["word"].to_numpy()] = rows[name].to_numpy().view(np.uint64)
    return out


def bit_map(hashed: DataFrame, bits: int) -> np.ndarray:
    """The map of all hashes alone."""
    return bit_maps(hashed.select("h", F.lit(False).alias("also")), bits)[0]


def in_map(bit_words: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash (uint64) is set."""
    at = hashed & np.uint64(len(bit_words) * 64 - 1)
    return (bit_words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


#: Nodes with one edge in so many, or more, are handled apart; there are at most twice as many of them.
HEAVY = 1000


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of an edge table (a, b); returns (node, root).

    Alternates two steps until nothing changes: each node hands its larger
    neighbours to its smallest one, then its smaller ones. Both are a minimum per node and a join of the edges with
    these minima. The minima of nodes with very many edges are few by construction and are broadcast, so
    the edges of such a node are never gathered in one place.
    """

    def smallest(e: DataFrame) -> DataFrame:
        found = e.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
        return found.select("a", F.least("a", "m").alias("m"), "degree")

    def tidy(e: DataFrame) -> DataFrame:
        return e.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()

    def handed(e: DataFrame, least: DataFrame, heavy: int) -> DataFrame:
        """Each edge (a, b) as (b, m), ``m`` being the smallest neighbour of ``a``."""
        few = F.broadcast(least.where(F.col("degree") >= heavy).select("a", "m"))
        met = e.join(few, "a", "left")
        others = met.where("m IS NULL").drop("m").join(least.where(F.col("degree") < heavy).select("a", "m"), "a")
        return met.where("m IS NOT NULL").select("b", "m").union(others.select("b", "m")).toDF("a", "b")

    def state_of(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stored(tidy(edges), "edges")
    state = state_of(now)
    while True:
        # Neither table below has more than twice as many rows.
        heavy = max(2, state[0] // HEAVY)
        both = now.union(now.select("b", "a"))
        large = stored(tidy(handed(both.where("b > a"), smallest(both), heavy)), "edges")
        low = smallest(large)
        small = handed(large, low, heavy).union(low.select("a", F.col("m").alias("b")))
        now = stored(tidy(small), "edges")
        before, state = state, state_of(now)
        if state == before:
            break
    return now.selectExpr("a AS node", "b AS root").union(now.selectExpr("b", "b").distinct())
