"""Benchmark decontamination by winnowing.

A word is a run of letters and digits after A-Z are lowered (any other character
beyond ASCII counts as a letter). Every text keeps the smallest ``gram``-word hash of
each window of ``window`` consecutive words, so two texts that share ``window`` words in a
row have kept the same hash inside that run. Documents and benchmark meet on the kept
hashes; each meeting is then extended word by word, to the left and to the right, and
counts when the run reaches ``window`` words. A benchmark item that is shorter than a
window is looked for as a whole.

Only document hashes whose bit is set in a map of the benchmark's hashes go into the join,
each with the few words around it, so nothing but likely hits is shuffled and the
texts are read once.

Nulls and edges: a null or empty text has no words and no hits; a null ``doc_id`` is a row
like any other; repeated rows give repeated results; a benchmark item without words never
occurs; one with a null ``item_id`` makes hits but is not among the items; an empty
benchmark hits nothing; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import arrays
from touchline.llm.shared import bit_map, in_map, stored, text_key

WINDOW = 10
GRAM = 5
#: Bits of the map of benchmark hashes: 2 MB, whatever the size of the benchmark.
MAP_BITS = 24

_CANDIDATES = "array<struct<h: bigint, pos: int, before: int, words: array<string>>>"
_PLACES = pa.list_(
    pa.struct([("h", pa.int64()), ("pos", pa.int32()), ("before", pa.int32()), ("words", pa.list_(pa.string()))])
)


def _kept(hashed: np.ndarray, bounds: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the gram at each word, and whether winnowing keeps it. Ties are all kept."""
    n, width = len(hashed), window - gram + 1
    made = arrays.grams(hashed, gram)
    keep = np.zeros(len(made), dtype=bool)
    if n < window:
        return made, keep
    least = arrays.sliding(np.minimum, made, width)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    whole = np.arange(n - window + 1) + window <= ends[: n - window + 1]
    least = np.where(whole, least, np.uint64(0))
    pad = np.zeros(width - 1, dtype=np.uint64)
    highest = arrays.sliding(np.maximum, np.concatenate([pad, least, pad]), width)
    return made, (highest == made) & (highest > 0)


def _whole_grams(hashed: np.ndarray, bounds: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``m`` words, and whether it stays inside its text."""
    made = arrays.grams(hashed, m)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    return made ^ np.uint64(m), np.arange(len(made)) + m <= ends[: len(made)]


def _reader(window: int, gram: int, lengths: tuple[int, ...], known) -> Callable:
    """Turns (.., text) rows into (.., n_words, places). ``known`` picks hashes worth keeping."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            counts, places = [], []
            for chunk in arrays.chunks(texts):
                data = chunk.lowered()
                found = arrays.words(data, chunk.bounds, arrays.ALNUM)
                hashed, sizes = arrays.hashes(data, found), np.diff(found.bounds)
                counts.append(sizes)
                made, keep = _kept(hashed, found.bounds, window, gram)
                at = np.flatnonzero(keep)
                hits = [(at, made[at], gram, window - gram)]
                for m in lengths:
                    made, whole = _whole_grams(hashed, found.bounds, m)
                    if known is None:  # the benchmark itself: a short item is one window
                        whole[:] = False
                        whole[found.bounds[:-1][sizes == m]] = True
                    at = np.flatnonzero(whole)
                    hits.append((at, made[at], m, 0))
                here: list[list] = [[] for _ in range(chunk.n)]
                for at, made, size, margin in hits:
                    if known is not None:
                        seen = in_map(known.value, made)
                        at, made = at[seen], made[seen]
                    owner = np.searchsorted(found.bounds, at, side="right") - 1
                    for i, h, d in zip(at.tolist(), made.view(np.int64).tolist(), owner.tolist(), strict=True):
                        low, high = int(found.bounds[d]), int(found.bounds[d + 1])
                        a, b = max(low, i - margin), min(high, i + size + margin)
                        around = [bytes(data[found.starts[x] : found.ends[x]]).decode() for x in range(a, b)]
                        here[d].append({"h": h, "pos": i - low, "before": i - a, "words": around})
                places.extend(here)
            sizes = np.concatenate(counts) if counts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sizes.astype(np.int64)), pa.array(places, _PLACES)],
                names=[*batch.schema.names[:-1], "n_words", "places"],
            )

    return read


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, map_bits: int = MAP_BITS
) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, item_ids) for every row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of a benchmark window; ``item_ids`` is
    the sorted array of the items, as strings, of which a window occurs.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    short = tuple(range(1, window))
    planned = stored(
        items.mapInArrow(
            _reader(window, gram, short, None), f"item_id string, n_words bigint, places {_CANDIDATES}"
        ),
        "benchmark",
    )
    theirs = planned.select("item_id", "n_words", F.inline("places"))
    lengths = sorted(r[0] for r in theirs.where(F.col("n_words") < window).select("n_words").distinct().collect())
    known = spark.sparkContext.broadcast(bit_map(theirs.select("h"), map_bits))
    ours = stored(
        docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(
            _reader(window, gram, tuple(lengths), known),
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_key bigint, n_words bigint, places {_CANDIDATES}",
        ),
        "fingerprints",
    )
    met = (
        ours.select("doc_id", "text_key", F.inline("places"))
        .distinct()
        .join(
            theirs.select(
                "h",
                "item_id",
                F.least("n_words", F.lit(window)).alias("needed"),
                F.col("before").alias("b_before"),
                F.col("words").alias("b_words"),
            ),
            "h",
        )
    )
    # Words that agree from the meeting point on to the right, and before it to the left.
    agree = "array_position(zip_with({0}, {1}, (x, y) -> x <=> y), false)"
    left = agree.format("reverse(slice(words, 1, before))", "reverse(slice(b_words, 1, b_before))")
    right = agree.format(
        "slice(words, before + 1, size(words))", "slice(b_words, b_before + 1, size(b_words))"
    )
    runs = (
        met.withColumn("l", F.expr(left))
        .withColumn("r", F.expr(right))
        .selectExpr(
            "doc_id",
            "text_key",
            "item_id",
            "needed",
            "CAST(pos - IF(l = 0, before, l - 1) AS BIGINT) AS s",
            "CAST(pos + IF(r = 0, size(words) - before, r - 1) AS BIGINT) AS e",
        )
        .where("e - s >= needed")
    )
    hits = runs.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("s", "e"))).alias("runs"),
        F.sort_array(F.collect_set("item_id")).alias("item_ids"),
    )
    covered = """aggregate(runs, named_struct('e', 0L, 'n', 0L), (t, x) -> named_struct(
        'e', greatest(t.e, x.e), 'n', t.n + greatest(0L, x.e - greatest(t.e, x.s))), t -> t.n)"""
    hits = hits.selectExpr("doc_id AS h_id", "text_key AS h_key", f"{covered} AS n_hit", "item_ids")
    return ours.select("doc_id", "text_key", "n_words").join(
        hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_key") == F.col("h_key")), "left"
    ).select(
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark window."""
    hit = (
        contamination(docs, benchmark, window, gram)
        .where("n_hit > 0")
        .select(F.col("doc_id").alias("h_id"), F.col("text_key").alias("h_key"))
        .distinct()
    )
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["h_id"]) & (text_key(docs["text"]) == hit["h_key"]), "left_anti")
