"""Exact near-duplicate pairs of embeddings by dual traversal of cover trees.

Only vectors of one label and length are compared. Equal vectors are one class from the
start. Classes of a label go to the nearest of a bounded number of pivots; a large cell is
dealt into blocks. Two cells whose balls are further apart than the threshold allows are
never paired. For each remaining pair of blocks a task builds a cover tree over both: a node
is a centre with the radius that covers its members, its children cover them with half the
radius, down to nodes that halving hardly divides. Both trees are walked together, pairs of nodes whose
balls are too far apart are dropped, and what is left is compared exactly. A task hands
on, for each class, how many vectors it links with, and a spanning forest of the links:
never the pairs themselves.

Cosine is computed in double precision; it becomes a distance by |a - b|^2 = 2 - 2 cos on the unit sphere.

Nulls and edges: vectors that are null, empty, zero, or hold null or non-finite components,
rows without label and rows without ``vec_id`` link with nothing; a row without ``vec_id`` has a
null component and is not kept; repeated rows count as vectors of their own (copies link); an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.ngram_join import forest
from touchline.llm.shared import components, stored

#: Classes in a block, about; and the most pivots that go to the tasks.
BLOCK = 2048
MAX_PIVOTS = 1024
LEAF = 48
_SAFE = 1e-9


@dataclass
class Node:
    """A ball around ``centre`` that covers ``members``; leaves have no children."""

    centre: int
    radius: float
    members: np.ndarray
    children: list[Node] = field(default_factory=list)


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (x @ y)))


def cover_tree(x: np.ndarray, members: np.ndarray, centre: int) -> Node:
    """Nested covers with halving radii of some rows of ``x``, which are unit vectors."""
    near = _distance(x[members], x[centre])
    node = Node(centre, float(near.max()), members)
    if len(members) <= LEAF or node.radius <= _SAFE:
        return node
    centres, owner = [centre], np.zeros(len(members), dtype=np.int64)
    while near.max() > node.radius / 2:
        if len(centres) > max(8, len(members) // 8):
            return node  # half the radius takes nearly as many balls as there are members
        centres.append(int(members[near.argmax()]))
        other = _distance(x[members], x[centres[-1]])
        closer = other < near
        owner[closer] = len(centres) - 1
        near = np.where(closer, other, near)
    node.children = [cover_tree(x, members[owner == i], c) for i, c in enumerate(centres)]
    return node


def linked_pairs(x: np.ndarray, raw: np.ndarray, one: Node, two: Node, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows with a cosine of ``least`` or more, one from each tree, in batches; for equal trees both orders and no row with itself."""
    reach = math.sqrt(2 - 2 * least) + _SAFE
    norms = np.sqrt(np.einsum("ij,ij->i", raw, raw))
    stack = [(one, two)]
    while stack:
        a, b = stack.pop()
        if a.children or b.children:
            # The larger ball is opened, so both trees go down level by level.
            open_a = a.children and (not b.children or a.radius >= b.radius)
            parts = a.children if open_a else b.children
            other = b if open_a else a
            far = _distance(x[[p.centre for p in parts]], x[other.centre])
            for p, d in zip(parts, far.tolist(), strict=True):
                if d <= p.radius + other.radius + reach:
                    stack.append((p, other) if open_a else (other, p))
            continue
        cosine = x[a.members] @ x[b.members].T
        i, j = np.nonzero(cosine >= least - _SAFE)
        close = np.abs(cosine[i, j] - least) <= _SAFE
        i, j = a.members[i], b.members[j]
        if close.any():
            p, q = i[close], j[close]
            exact = np.einsum("ij,ij->i", raw[p], raw[q]) / (norms[p] * norms[q])
            good = np.ones(len(i), dtype=bool)
            good[np.flatnonzero(close)[exact < least]] = False
            i, j = i[good], j[good]
        if one is two:
            i, j = i[i != j], j[i != j]
        yield i, j


def scaled(raw: np.ndarray) -> np.ndarray:
    """Vectors whose squares would leave the range of doubles, times a power of two; all others as they are.

    A cosine does not depend on length, and a power of two changes no digit.
    """
    largest = np.abs(raw).max(axis=1, initial=0)
    odd = (largest > 1e100) | ((largest < 1e-100) & (largest > 0))
    if odd.any():
        raw = raw.copy()
        raw[odd] = np.ldexp(raw[odd], -np.frexp(largest[odd])[1][:, None])
    return raw


def _compared(least: float) -> Callable:
    """Turns the classes of a pair of blocks into counts of links and forest edges."""

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("h").to_numpy()
        copies = table.column("copies").to_numpy()
        side = table.column("side").to_numpy()
        raw = scaled(np.array(table.column("embedding").to_pylist(), dtype=np.float64))
        x = raw / np.sqrt(np.einsum("ij,ij->i", raw, raw))[:, None]
        links = np.zeros((len(keys), len(keys)), dtype=bool)
        sides = [np.flatnonzero(side == s) for s in (0, 1)]
        if len(sides[1]):
            trees = [cover_tree(x, s, int(s[0])) for s in sides] if len(sides[0]) else []
        else:
            tree = cover_tree(x, sides[0], int(sides[0][0]))
            trees = [tree, tree]
        for i, j in linked_pairs(x, raw, *trees, least) if trees else ():
            links[i, j] = links[j, i] = True
        root = forest(links)
        counts = links @ copies
        told = counts > 0
        return pa.table({"h": keys[told], "links": counts[told], "root": keys[root[told]]})

    return run


def _cells(pivots: dict[tuple[int, int], tuple[list[int], np.ndarray]]) -> Callable:
    """Nearest pivot of each class, and the distance to it; classes of labels without pivot share one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            size = batch.column("size").to_numpy(zero_copy_only=False)
            cell, radius = np.full(batch.num_rows, -1, dtype=np.int32), np.full(batch.num_rows, 2.0)
            vectors = batch.column("embedding")
            for key, (names, points) in pivots.items():
                rows = np.flatnonzero((label == key[0]) & (size == key[1]))
                for part in np.array_split(rows, max(1, len(rows) // 4096)):
                    if not len(part):
                        continue
                    x = scaled(np.array(vectors.take(pa.array(part)).to_pylist(), dtype=np.float64))
                    x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                    far = _distance(x, points.T)
                    best = far.argmin(axis=1)
                    cell[part], radius[part] = np.array(names)[best], far[np.arange(len(part)), best]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(radius)], names=[*batch.schema.names, "cell", "far"]
            )

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93, block: int = BLOCK, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label)."""
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    usable = f"vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0 AND {finite} AND exists(embedding, x -> x <> 0)"
    rows = vectors.select(
        "vec_id", "label", "embedding", F.expr(f"coalesce({usable}, false)").alias("takes_part")
    ).withColumn("h", F.when(F.col("takes_part"), F.xxhash64("label", F.hash("embedding"), "embedding")))
    classes = stored(
        rows.where("takes_part")
        .groupBy("h")
        .agg(
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
            F.count("*").alias("copies"),
            F.min("vec_id").alias("smallest"),
        )
        .withColumn("size", F.size("embedding")),
        "classes",
    )
    n_pivots = min(max_pivots, classes.count() // block)
    pivots: dict[tuple[int, int], tuple[list[int], np.ndarray]] = {}
    for i, r in enumerate(classes.orderBy(F.xxhash64("h"), "h").limit(n_pivots).collect()):
        names, points = pivots.setdefault((r["label"], r["size"]), ([], []))
        names.append(i)
        points.append(np.array(r["embedding"], dtype=np.float64))
    scaled_points = {k: (n, scaled(np.array(p))) for k, (n, p) in pivots.items()}
    centres = {k: (n, p / np.linalg.norm(p, axis=1)[:, None]) for k, (n, p) in scaled_points.items()}
    celled = stored(
        classes.select("h", "label", "size", "copies", "embedding").mapInArrow(
            _cells(centres),
            f"h bigint, label {classes.schema['label'].dataType.simpleString()}, size int, copies bigint,"
            f" embedding {classes.schema['embedding'].dataType.simpleString()}, cell int, far double",
        ),
        "cells",
    )
    cells = celled.groupBy("label", "size", "cell").agg(
        F.max("far").alias("radius"), F.expr(f"CAST(ceil(count(*) / {block}) AS INT)").alias("blocks")
    )
    # Pairs of cells that are too far apart for a link; there are at most ``max_pivots`` pivots.
    apart = _far_cells(centres, cells, least)
    other = cells.select("label", "size", F.col("cell").alias("cell_2"), F.col("blocks").alias("blocks_2"))
    pairs = cells.join(other, ["label", "size"]).join(apart, ["cell", "cell_2"], "left_anti")
    own = celled.join(pairs, ["label", "size", "cell"]).withColumn("block", F.expr("CAST(pmod(xxhash64(h), blocks) AS INT)"))
    dealt = own.withColumn("block_2", F.explode(F.sequence(F.lit(0), F.col("blocks_2") - 1)))
    here, there = F.struct("cell", "block"), F.struct(F.col("cell_2").alias("cell"), F.col("block_2").alias("block"))
    counted = stored(
        dealt.select(
            F.xxhash64("label", "size", F.least(here, there), F.greatest(here, there)).alias("unit"),
            "h",
            "copies",
            "embedding",
            F.when(here > there, 1).otherwise(0).alias("side"),
        )
        .groupBy("unit")
        .applyInArrow(_compared(least), "h bigint, links bigint, root bigint"),
        "links",
    )
    links = counted.groupBy("h").agg(F.sum("links").alias("links"))
    roots = components(counted.select(F.col("h").alias("a"), F.col("root").alias("b")))
    known = (
        classes.select("h", "copies", "smallest")
        .join(links, "h", "left")
        .join(roots, F.col("h") == F.col("node"), "left")
        .select(
            "h",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "h").alias("root"),
            "smallest",
        )
    )
    smallest = known.groupBy("root").agg(F.min("smallest").alias("component_id"))
    known = known.drop("smallest").join(smallest, "root").drop("root")
    out = rows.select("vec_id", "h").join(known, "h", "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").cast("bigint").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def _far_cells(centres: dict, cells: DataFrame, least: float) -> DataFrame:
    """(cell, cell_2) whose balls no link can join; only labels with several pivots have such pairs."""
    radius = {r["cell"]: r["radius"] for r in cells.where("cell >= 0").select("cell", "radius").collect()}
    reach, out = math.sqrt(2 - 2 * least) + _SAFE, []
    for names, points in centres.values():
        far = _distance(points, points.T)
        out += [
            (a, b)
            for i, a in enumerate(names)
            for j, b in enumerate(names)
            if a in radius and b in radius and far[i, j] > radius[a] + radius[b] + reach
        ]
    return cells.sparkSession.createDataFrame(out, "cell int, cell_2 int")
