"""Quality rules of documents, and verdicts on the hosts that publish them.

Each text is measured once (words, symbols, repeated lines and windows of words). Rules over
these figures say which documents fail; failures are added up by host. A host with few documents
says little, so its rates are shrunk: for each rule the rates of all hosts give an empirical
beta prior (method of moments for the beta-binomial, weighted by documents), and a host's rate is
the mean of its posterior. A host is rejected if the shrunk rate of any rule is above ``HOST_RATE``,
and its verdict is joined back to its documents.

Hosts with at least one document in ``HEAVY`` are at most ``HEAVY`` rows, whatever the corpus, and
are broadcast; so the rows that are shuffled to meet their host belong to hosts of less than that share.

Nulls and edges: a null or empty text has no words and so fails; a document without host is judged by its own
text alone; a row without ``doc_id`` is treated like any other; repeated rows count as often and give
repeated results; equal rates of all hosts, or a single host, leave the overall rate as every host's
rate; an empty table gives an empty one; further columns are ignored (``kept`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm import arrays
from touchline.llm.shared import stored, text_key

#: Rules by name, as SQL over the figures. The first two fail a document by themselves.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "2 * n_dup_lines > n_lines",
}
BASE_RULES = ("short", "repeats")
#: Shrunk rate of failures above which a host is rejected.
HOST_RATE = 0.5
#: Hosts with a larger share than one in so many are broadcast: no more than so many rows.
HEAVY = 1000
#: A prior is worth between one document and a million.
_RHO = (1e-6, 0.5)

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_IN_LINE = np.ones(256, dtype=bool)
_IN_LINE[0x0A] = False


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many marks lie between the bounds of each text."""
    sums = np.zeros(len(marks) + 1, dtype=np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _groups(owner: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal hashes of one text are neighbours, and where a new one begins."""
    order = np.lexsort((hashed, owner))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (owner[order][1:] != owner[order][:-1]) | (hashed[order][1:] != hashed[order][:-1])
    return order, fresh


def _repeated_words(hashed: np.ndarray, bounds: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text, the words that lie in windows found twice or more in it."""
    inside = np.zeros(len(hashed), dtype=bool)
    made = arrays.grams(hashed, size)
    at = np.arange(len(made))
    owner = np.searchsorted(bounds, at, side="right") - 1
    whole = at + size <= bounds[owner + 1] if len(at) else np.zeros(0, dtype=bool)
    at, owner = at[whole], owner[whole]
    order, fresh = _groups(owner, made[at])
    group = np.cumsum(fresh) - 1
    often = at[order[np.bincount(group, minlength=1)[group] > 1]] if len(order) else at
    for j in range(size):
        inside[often + j] = True
    return _per_text(inside, bounds)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(.., text) to (.., figures)."""
    for batch in batches:
        parts: list[list[np.ndarray]] = [[] for _ in FIGURES]
        for chunk in arrays.chunks(batch.column(batch.num_columns - 1)):
            data, bounds = chunk.data, chunk.bounds
            visible = arrays.NOT_SPACE[data]
            found = arrays.words(data, bounds, arrays.NOT_SPACE)
            lines = arrays.words(data, bounds, _IN_LINE)
            sums = np.concatenate([[0], np.cumsum(visible)])
            wordy = sums[lines.ends] > sums[lines.starts]
            owner = np.searchsorted(bounds, lines.starts, side="right")[wordy] - 1
            _, fresh = _groups(owner, arrays.hashes(data, lines)[wordy])
            n_lines = np.bincount(owner, minlength=chunk.n)
            figures = (
                np.diff(found.bounds),
                _per_text(visible & ((data & 0xC0) != 0x80), bounds),
                _per_text(_SYMBOL[data], bounds),
                n_lines - np.bincount(np.sort(owner)[fresh], minlength=chunk.n),
                n_lines,
                _repeated_words(arrays.hashes(data, found), found.bounds),
            )
            for part, values in zip(parts, figures, strict=True):
                part.append(values)
        columns = [pa.array(np.concatenate(p).astype(np.int64) if p else [], pa.int64()) for p in parts]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *columns], names=[*batch.schema.names[:-1], *FIGURES]
        )


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, text_key, figures, base_failed) of every row, stored."""
    rows = docs.select("doc_id", F.col(host).alias("host"), text_key().alias("text_key"), "text")
    kinds = [f"{c} {rows.schema[c].dataType.simpleString()}" for c in rows.columns[:-1]]
    made = rows.mapInArrow(_measure, ", ".join([*kinds, *(f"{f} bigint" for f in FIGURES)]))
    base = reduce(Column.__or__, (F.expr(RULES[r]) for r in BASE_RULES))
    return stored(made.withColumn("base_failed", base), "figures")


def hosts(figures: DataFrame, limit: float = HOST_RATE) -> DataFrame:
    """(host, n, n_<rule>.., <rule>_rate.., rejected): one row per host, with shrunk rates."""
    counted = stored(
        figures.where("host IS NOT NULL")
        .groupBy("host")
        .agg(F.count("*").alias("n"), *(F.count_if(F.expr(test)).alias(f"n_{r}") for r, test in RULES.items())),
        "hosts",
    )
    sums = counted.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("docs"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        *(F.sum(f"n_{r}").alias(f"f_{r}") for r in RULES),
        *(F.sum(F.expr(f"CAST(n_{r} AS DOUBLE) * n_{r} / n")).alias(f"s_{r}") for r in RULES),
    ).first()
    rates = {r: _rate(r, sums.asDict()) for r in RULES}
    return counted.withColumns({f"{r}_rate": rate for r, rate in rates.items()}).withColumn(
        "rejected", reduce(Column.__or__, (F.col(f"{r}_rate") > limit for r in RULES))
    )


def _rate(rule: str, sums: dict) -> Column:
    """Posterior mean of a host's rate under the prior that all hosts give."""
    docs = sums["docs"] or 0
    share = sums[f"f_{rule}"] / docs if docs else 0.0
    if share in (0.0, 1.0):
        return F.lit(float(share))
    free = sums["hosts"] - 1
    spread = (sums[f"s_{rule}"] - docs * share * share) / (share * (1 - share))
    room = docs - sums["squares"] / docs - free
    rho = min(max((spread - free) / room if room > 0 else 0.0, _RHO[0]), _RHO[1])
    strength = 1 / rho - 1
    return (F.col(f"n_{rule}") + F.lit(share * strength)) / (F.col("n") + F.lit(strength))


def judged(docs: DataFrame, host: str = "source", limit: float = HOST_RATE) -> DataFrame:
    """(doc_id, host, text_key, figures, base_failed, host_rejected, kept) for every row of ``docs``."""
    figures = measured(docs, host)
    verdicts = stored(hosts(figures, limit), "host-verdicts")
    total = verdicts.agg(F.sum("n")).first()[0] or 0
    slim = verdicts.select(F.col("host").alias("h_host"), F.col("rejected").alias("host_rejected"), "n")
    heavy = slim.where(F.col("n") * HEAVY >= total).drop("n")
    light = slim.where(F.col("n") * HEAVY < total).drop("n")
    met = figures.join(F.broadcast(heavy), F.col("host") == F.col("h_host"), "left")
    settled = met.where("h_host IS NOT NULL OR host IS NULL")
    others = met.where("h_host IS NULL AND host IS NOT NULL").drop("h_host", "host_rejected")
    rows = settled.unionByName(others.join(light, F.col("host") == F.col("h_host")))
    rejected = F.coalesce("host_rejected", F.lit(False))
    return rows.select(
        *figures.columns, rejected.alias("host_rejected"), (~F.col("base_failed") & ~rejected).alias("kept")
    )


def kept(docs: DataFrame, host: str = "source", limit: float = HOST_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, that pass their own rules and come from no rejected host."""
    failed = (
        judged(docs, host, limit)
        .where("NOT kept")
        .select(F.col("doc_id").alias("f_id"), F.col("host").alias("f_host"), F.col("text_key").alias("f_key"))
        .distinct()
    )
    same = (
        docs["doc_id"].eqNullSafe(failed["f_id"])
        & docs[host].eqNullSafe(failed["f_host"])
        & (text_key(docs["text"]) == failed["f_key"])
    )
    return docs.join(failed, same, "left_anti")
