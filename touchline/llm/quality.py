"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a few figures (shares of characters, repeated words and lines, lengths).
Each figure is cut into bins, and the model is a lookup table per figure plus one per
chosen pair of figures. Boosting goes round the figures: each turn fits a tree with a few
leaves to the current gradients over the bins of *one* figure and adds it, scaled down,
to that figure's table. Pairs come after the single figures, picked by how much a
cut of both reduces the loss that is left, and are boosted the same way with trees that
cut both figures once. A score is the sum of one entry of each table.

The figures of all documents are computed in one pass over the texts and stored; fitting
reads at most ``max_rows`` labelled rows (those with the smallest hash of their id, so
the same ones each time), scoring reads the stored figures.

Nulls and edges: a null or empty text is scored by its figures, which are then zero; a row
without ``doc_id`` is scored and never learnt from; labels that are null, or other than 0
and 1, are left out; a repeated row is scored (and if labelled, counted) as often as it
is given; without labels every score is one half, with one class only its share. Nothing is
learnt without labels, so ``accepted`` then keeps every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm import arrays
from touchline.llm.shared import stored, text_key

#: Bound of the sample that the model is fitted to.
MAX_ROWS = 20_000
ACCEPT = 0.7

FIGURES = (
    "log_bytes",
    "log_words",
    "upper",
    "digits",
    "non_ascii",
    "stops",
    "exclamations",
    "bars",
    "symbols",
    "spaces",
    "line_words",
    "word_bytes",
    "repeated_next",
    "distinct_words",
    "distinct_pairs",
    "top_word",
    "odd_words",
    "long_words",
    "distinct_lines",
)


def _set(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters.encode())] = True
    return table


_UPPER = _set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _set("abcdefghijklmnopqrstuvwxyz")
_LETTER[0x80:] = True
_DIGIT = _set("0123456789")
_SYMBOL = _set("#$%&*+/<=>@[\\]^_`{|}~")
_SPACE = ~arrays.NOT_SPACE
_LINE = np.ones(256, dtype=bool)
_LINE[0x0A] = False


def _distinct(owner: np.ndarray, hashed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes of each text, and the count of its most frequent one."""
    if not len(hashed):
        return np.zeros(n), np.zeros(n)
    order = np.argsort(arrays.mix(hashed ^ (owner.astype(np.uint64) << np.uint64(40))), kind="stable")
    o, h = owner[order], hashed[order]
    starts = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (h[1:] != h[:-1])]))
    top = np.zeros(n)
    np.maximum.at(top, o[starts], np.diff(np.append(starts, len(h))))
    return np.bincount(o[starts], minlength=n).astype(float), top


def figures(chunk: arrays.Chunk) -> np.ndarray:
    """One row of figures for each text of a chunk."""
    data, n = chunk.data, chunk.n
    size = np.diff(chunk.bounds).astype(float)

    def count(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return np.diff(sums[chunk.bounds]).astype(float)

    low = chunk.lowered()
    found = arrays.words(low, chunk.bounds, arrays.NOT_SPACE)
    hashed, words = arrays.hashes(low, found), np.diff(found.bounds)
    owner = np.repeat(np.arange(n), words)
    lengths = (found.ends - found.starts).astype(float)
    lines = arrays.words(low, chunk.bounds, _LINE)
    line_owner = np.repeat(np.arange(n), np.diff(lines.bounds))
    n_lines = np.bincount(line_owner, minlength=n).astype(float)
    per = lambda weights: np.bincount(owner, weights=weights, minlength=n)
    again = np.zeros(len(hashed))
    again[1:] = (hashed[1:] == hashed[:-1]) & (owner[1:] == owner[:-1])
    odd = _SYMBOL[low[found.ends - 1]] | (low[found.ends - 1] == 0x21) if len(found) else np.zeros(0)
    pairs = arrays.grams(hashed, 2)
    inside = owner[1:] == owner[:-1]
    distinct, top = _distinct(owner, hashed, n)
    distinct_pairs, _ = _distinct(owner[1:][inside], pairs[inside], n)
    distinct_lines, _ = _distinct(line_owner, arrays.hashes(low, lines), n)
    letters = np.maximum(count(_LETTER), 1)
    bytes_, w = np.maximum(size, 1), np.maximum(words.astype(float), 1)
    high = np.zeros(256, dtype=bool)
    high[0x80:] = True
    return np.column_stack(
        [
            np.log1p(size),
            np.log1p(words),
            count(_UPPER) / letters,
            count(_DIGIT) / bytes_,
            count(high) / bytes_,
            count(_set(".")) / w,
            count(_set("!")) / w,
            count(_set("|")) / w,
            count(_SYMBOL) / bytes_,
            count(_SPACE) / bytes_,
            w / np.maximum(n_lines, 1),
            per(lengths) / w,
            per(again) / w,
            distinct / w,
            distinct_pairs / np.maximum(words - 1.0, 1),
            top / w,
            per(odd) / w,
            per(lengths > 25) / w,
            distinct_lines / np.maximum(n_lines, 1),
        ]
    )


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        last = batch.num_columns - 1
        for chunk in arrays.chunks(batch.column(last)):
            part = batch.slice(chunk.first, chunk.n)
            made = pa.FixedSizeListArray.from_arrays(pa.array(figures(chunk).ravel()), len(FIGURES))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], made.cast(pa.list_(pa.float64()))], names=[*part.schema.names[:-1], "figures"]
            )


@dataclass
class Model:
    """Bin edges and lookup tables; ``pairs`` holds (i, j, table)."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.tables:
            bins = self.bins(x)
            for column, table in zip(bins, self.tables, strict=True):
                total += table[column]
            for i, j, table in self.pairs:
                total += table[bins[i], bins[j]]
        return 1 / (1 + np.exp(-total))

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)]


_SHRINK, _LAMBDA = 0.1, 1.0


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + _LAMBDA)


def _step(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """A tree over the bins of one figure: the update of each bin."""
    cuts = [0, len(g)]
    sums_g, sums_h = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    while len(cuts) <= leaves:
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            left = _gain(sums_g[m] - sums_g[a], sums_h[m] - sums_h[a])
            right = _gain(sums_g[b] - sums_g[m], sums_h[b] - sums_h[m])
            gain = left + right - _gain(sums_g[b] - sums_g[a], sums_h[b] - sums_h[a])
            if gain.max() > best:
                best, at = gain.max(), int(m[gain.argmax()])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (sums_g[b] - sums_g[a]) / (sums_h[b] - sums_h[a] + _LAMBDA)
    return out


def _cut_both(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree that cuts both figures of a pair once: its gain and the update of each cell."""
    cg = np.zeros((g.shape[0] + 1, g.shape[1] + 1))
    ch = cg.copy()
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    quadrants = lambda c: (
        c[1:-1, 1:-1],
        c[1:-1, -1:] - c[1:-1, 1:-1],
        c[-1:, 1:-1] - c[1:-1, 1:-1],
        c[-1:, -1:] - c[1:-1, -1:] - c[-1:, 1:-1] + c[1:-1, 1:-1],
    )
    sums = list(zip(quadrants(cg), quadrants(ch), strict=True))
    gain = sum(_gain(a, b) for a, b in sums)
    if not gain.size:
        return 0.0, np.zeros(g.shape)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    value = [a[i, j] / (b[i, j] + _LAMBDA) for a, b in sums]
    out = np.empty(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gain.max() - _gain(g.sum(), h.sum())), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, bins: int = 32, leaves: int = 3, n_pairs: int = 5) -> Model:
    """Fit the tables to rows of figures and labels of 0 and 1."""
    if not len(y):
        return Model()
    share = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(base=float(np.log(share / (1 - share))))
    if y.min() == y.max():
        return model
    model.edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(x.shape[1])]
    at = model.bins(x)
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for column, table in zip(at, model.tables, strict=True):
            g, h = (np.bincount(column, v, len(table)) for v in slopes())
            step = _SHRINK * _step(g, h, leaves)
            table += step
            total += step[column]

    def cells(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        shape = len(model.tables[i]), len(model.tables[j])
        return tuple(np.bincount(at[i] * shape[1] + at[j], v, shape[0] * shape[1]).reshape(shape) for v in slopes())

    gains = [(_cut_both(*cells(i, j))[0], i, j) for i in range(len(at)) for j in range(i)]
    for _, i, j in sorted(gains, reverse=True)[:n_pairs]:
        model.pairs.append((i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))))
    for _ in range(rounds):
        for i, j, table in model.pairs:
            step = _SHRINK * _cut_both(*cells(i, j))[1]
            table += step
            total += step[at[i], at[j]]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text_key, held_out, score, predicted) for every row of ``docs``."""
    return _scored(docs, labels, max_rows)[0]


def _scored(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[DataFrame, int]:
    """The rows of ``scored``, and the number of labelled rows learnt from."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = stored(
        docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(
            _figures, f"doc_id {id_type}, text_key bigint, figures array<double>"
        ),
        "figures",
    )
    sample = (
        made.where(~held_out(F.col("doc_id")))
        .join(labels.where("quality IN (0, 1)").select("doc_id", "quality"), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text_key", "quality")
        .limit(max_rows)
        .select("figures", "quality")
        .toArrow()
    )
    x = sample.column("figures").combine_chunks().flatten().to_numpy().reshape(-1, len(FIGURES))
    model = made.sparkSession.sparkContext.broadcast(fit(x, sample.column("quality").to_numpy().astype(float)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("figures").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FIGURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(model.value.score(rows))], names=[*batch.schema.names[:-1], "score"]
            )

    rows = made.mapInArrow(score, f"doc_id {id_type}, text_key bigint, score double").select(
        "doc_id",
        "text_key",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
    return rows, sample.num_rows


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier accepts; all rows if no label could be learnt from."""
    rows, examples = _scored(docs, labels)
    if not examples:
        return docs
    rejected = (
        rows.where("predicted = 0")
        .select(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"))
        .distinct()
    )
    same = docs["doc_id"].eqNullSafe(rejected["r_id"]) & (text_key(docs["text"]) == rejected["r_key"])
    return docs.join(rejected, same, "left_anti")
