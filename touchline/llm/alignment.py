"""Alignment of two tokenizers' tokens of the same texts by pointer jumping.

Both tokenizers cut the bytes of a text, each in its own way. Every token points to its farthest-right overlapping
token of the other kind (or to itself, if none ends further right; of two that end together the first
kind's wins). Doubling the successors of all tokens of a chunk of texts at once leads each one to the terminal token of
its component, which labels the group of tokens between two common cuts.

Where both tokenizers always cut at a single space between visible characters (the first one by its pattern, the second
one because none of its pieces goes on beyond a space), texts are cut there beforehand, and each distinct stretch of a task's
texts is tokenized and aligned once. Otherwise a stretch is a whole text.

Overlapping pairs (links) are the stretches between neighbouring cuts of either kind. How many documents of the corpus
hold a pair linked is counted in Spark, after each task has added up its own documents. To bring the counts back, the most
frequent pairs (at most ``FREQUENT``, chosen by a histogram of the counts) and each first-kind id's highest
count (at most one row per id of the vocabulary) are broadcast; links of other pairs are joined with their counts. Which
pairs are broadcast changes the work, never the result.

Nulls and edges: texts that are null or empty, or whose tokens do not give back the text, have no tokens; a null
``doc_id`` is a row like any other; repeated rows count as often and give repeated results; an empty table gives an
empty one; further columns are ignored. Memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import arrays
from touchline.llm.shared import stored

#: Pairs whose counts are broadcast (16 bytes each), and steps per doubling in the histogram that picks them.
FREQUENT = 1_000_000
_STEPS = 16
#: Distinct stretches of text that a task remembers.
_STRETCHES = 1 << 19
#: Distinct pairs that a task adds up before it hands them on.
_HELD = 1 << 21

COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _byte_level() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 is itself, other bytes follow from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """The bytes of all tokens end to end; token ``i`` is ``data[starts[i]:starts[i] + sizes[i]]``."""

    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        return cls(np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of tokens."""
        return _gathered(self.data, self.starts[ids], self.sizes[ids])


class ByteTokens:
    """A byte-level tokenizer from a file of the ``tokenizers`` library."""

    def __init__(self, file: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(file)
        self._tokenizer.encode_special_tokens = True
        n, byte = self._tokenizer.get_vocab_size(), _byte_level()
        names = [self._tokenizer.id_to_token(i) or "" for i in range(n)]
        self.vocabulary = Vocabulary.of([bytes(byte[c] for c in t) if all(c in byte for c in t) else b"" for t in names])
        before = json.loads(self._tokenizer.to_str())["pre_tokenizer"] or {}
        self.cuts_at_spaces = before.get("type") == "ByteLevel" and bool(before.get("use_regex"))

    def encode(self, stretches: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(stretches, add_special_tokens=False)]


class PieceTokens:
    """A model of the ``sentencepiece`` library, which adds the first space of a stretch itself."""

    def __init__(self, file: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=file)
        pieces = [self._model.id_to_piece(i) for i in range(self._model.get_piece_size())]
        self.vocabulary = Vocabulary.of(
            [
                bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode()
                for i, p in enumerate(pieces)
            ]
        )
        self.cuts_at_spaces = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, stretches: list[str]) -> list[list[int]]:
        return self._model.encode([s[1:] for s in stretches], num_threads=1)


@dataclass
class Tokens:
    """Tokens of texts laid end to end: ids, and the byte each one ends at."""

    ids: np.ndarray
    ends: np.ndarray


def _flat(encoded: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in encoded], dtype=np.int64)
    ids = np.fromiter((i for x in encoded for i in x), dtype=np.int64, count=int(sizes.sum()))
    return ids, np.concatenate([[0], np.cumsum(sizes)])


def _spells(tokens, encoded: list[list[int]], texts: list[bytes]) -> list[bool]:
    """Whether the tokens of each text give its bytes."""
    ids, bounds = _flat(encoded)
    spelled = tokens.vocabulary.spelled(ids)
    ends = np.concatenate([[0], np.cumsum(tokens.vocabulary.sizes[ids])])[bounds]
    raw = spelled.tobytes()
    return [raw[a:b] == t for a, b, t in zip(ends[:-1].tolist(), ends[1:].tolist(), texts, strict=True)]


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of either kind the terminal token (number among the first kind) of its component.

    Both kinds cover the same bytes. Tokens are numbered first kind first; successors are doubled until none moves.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)  # the second kind's token that holds the last byte
    over_b = np.searchsorted(a_ends, b_ends)
    to = np.concatenate([np.where(b_ends[over_a] > a_ends, over_a + n, np.arange(n)), over_b])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to[:n], to[n:]
        to = further


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """End byte of each overlap of a token of ``a`` with one of ``b``, and the places of both tokens."""
    ends = np.union1d(a.ends, b.ends)
    return ends, np.searchsorted(a.ends, ends), np.searchsorted(b.ends, ends)


def _decimal(ids: np.ndarray, marks: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Decimal ids, each followed by its mark, and where each one ends."""
    width = max(1, len(str(int(ids.max(initial=0)))))
    powers = 10 ** np.arange(width - 1, -1, -1)
    digits = np.empty((len(ids), width + 1), dtype=np.uint8)
    digits[:, :-1] = ids[:, None] // powers % 10 + ord("0")
    digits[:, -1] = marks
    shown = np.ones(digits.shape, dtype=bool)
    shown[:, : width - 1] = ids[:, None] >= powers[:-1]
    return digits[shown].tobytes(), np.cumsum(shown.sum(axis=1))


@dataclass
class Aligned:
    """Alignment of some texts: counts and digest per text, and its distinct linked pairs with their numbers."""

    counts: np.ndarray
    digests: list[str]
    pairs: np.ndarray
    times: np.ndarray
    bounds: np.ndarray


def _between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of whole numbers between bounds."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``data[start:start + size]`` end to end."""
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    return data[np.arange(n) + np.repeat(starts - (ends - sizes), sizes)]


_CUT = re.compile(r"(?<=\S)(?= \S)")


class Aligner:
    """Aligns texts; each distinct stretch is done once while it is remembered, at most about ``_STRETCHES`` of them."""

    def __init__(self, a_kind: ByteTokens, b_kind: PieceTokens) -> None:
        self._a, self._b = a_kind, b_kind
        self._cut = a_kind.cuts_at_spaces and b_kind.cuts_at_spaces
        self._forget()

    def _forget(self) -> None:
        none = np.zeros(0, dtype=np.int64)
        self._known: dict[str, int] = {}
        self._counts = np.zeros((len(COUNTS), 0), dtype=np.int64)
        self._good = np.zeros(0, dtype=bool)
        self._written: list[bytes] = []
        self._links, self._link_starts, self._link_sizes = none, none, none

    def align(self, texts: list[str]) -> Aligned:
        """Align whole texts; pairs are ``a * (size of the second vocabulary) + b``."""
        if len(self._known) > _STRETCHES or len(self._links) > 8 * _STRETCHES:
            self._forget()
        cut = [(_CUT.split(" " + t) if self._cut else [" " + t]) if t else [] for t in texts]
        stretches = [s for text in cut for s in text]
        self._learn([s for s in dict.fromkeys(stretches) if s not in self._known])
        at = np.fromiter(map(self._known.__getitem__, stretches), dtype=np.int64, count=len(stretches))
        sizes = np.array([len(x) for x in cut], dtype=np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        sizes[_between(~self._good[at], bounds) > 0] = 0  # tokens that do not spell one stretch do not spell the text
        at = at[np.repeat(sizes > 0, np.diff(bounds))]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        counts = np.stack([_between(c[at], bounds) for c in self._counts])
        places = at.tolist()
        digests = [
            hashlib.sha256(b";".join([self._written[i] for i in places[x:y]])).hexdigest() if y > x else ""
            for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
        ]
        links = _gathered(self._links, self._link_starts[at], self._link_sizes[at])
        span = len(self._a.vocabulary.sizes) * len(self._b.vocabulary.sizes)
        both = np.sort(np.repeat(np.arange(len(texts)), counts[-1]) * span + links)
        fresh = np.flatnonzero(np.diff(both, prepend=-1))
        owner, pairs = np.divmod(both[fresh], span)
        times = np.diff(np.append(fresh, len(both)))
        return Aligned(counts, digests, pairs, times, np.searchsorted(owner, np.arange(len(texts) + 1)))

    def _learn(self, stretches: list[str]) -> None:
        """Tokenize and align stretches, all of them at once."""
        if not stretches:
            return
        raw = [s.encode() for s in stretches]
        found = self._a.encode(stretches), self._b.encode(stretches)
        good = np.logical_and(*(_spells(k, e, raw) for k, e in zip((self._a, self._b), found, strict=True)))
        n = len(stretches)
        (a_ids, a_bounds), (b_ids, b_bounds) = (
            _flat([x if g else [] for x, g in zip(e, good, strict=True)]) for e in found
        )
        a = Tokens(a_ids, np.cumsum(self._a.vocabulary.sizes[a_ids]))
        b = Tokens(b_ids, np.cumsum(self._b.vocabulary.sizes[b_ids]))
        ends = np.cumsum([len(r) if g else 0 for r, g in zip(raw, good, strict=True)]).astype(np.int64)
        counts, written = np.zeros((len(COUNTS), n), dtype=np.int64), [b""] * n
        links = np.zeros(0, dtype=np.int64)
        if len(a_ids):
            a_last, b_last = terminals(a.ends, b.ends)
            cuts = np.flatnonzero(a_last == np.arange(len(a_last)))  # terminal tokens, one per group
            groups = np.searchsorted(cuts, a_last), np.searchsorted(cuts, b_last)
            written = _groups_written(a_ids, b_ids, *groups, a_bounds + b_bounds)
            over, a_place, b_place = overlaps(a, b)
            links = a_ids[a_place] * len(self._b.vocabulary.sizes) + b_ids[b_place]
            for row, values in enumerate(
                (np.diff(a_bounds), np.diff(b_bounds), np.bincount(np.searchsorted(ends, a.ends[cuts]), minlength=n), np.bincount(np.searchsorted(ends, over), minlength=n))
            ):
                counts[row] = values
        self._known.update(zip(stretches, range(len(self._written), len(self._written) + n), strict=True))
        starts = len(self._links) + np.cumsum(counts[-1]) - counts[-1]
        self._links = np.concatenate([self._links, links])
        self._link_starts = np.concatenate([self._link_starts, starts])
        self._link_sizes = np.concatenate([self._link_sizes, counts[-1]])
        self._counts = np.concatenate([self._counts, counts], axis=1)
        self._good = np.concatenate([self._good, good])
        self._written += written


def _groups_written(a_ids, b_ids, a_group, b_group, bounds) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` of each stretch; ``bounds`` count the tokens of both kinds."""
    a_at = np.arange(len(a_ids)) + np.searchsorted(b_group, a_group)
    b_at = np.arange(len(b_ids)) + np.searchsorted(a_group, b_group, side="right")
    n = len(a_ids) + len(b_ids)
    ids, marks = np.empty(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    marks[a_at[np.append(a_group[1:] != a_group[:-1], True)]] = ord("|")
    marks[b_at[np.append(b_group[1:] != b_group[:-1], True)]] = ord(";")
    raw, ends = _decimal(ids, marks)
    at = np.concatenate([[0], ends])[bounds].tolist()
    return [raw[x : max(x, y - 1)] for x, y in zip(at[:-1], at[1:], strict=True)]


def _align(a_file: str, b_file: str):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(ByteTokens(a_file), PieceTokens(b_file))
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for chunk in arrays.chunks(column):
                found = aligner.align(column.slice(chunk.first, chunk.n).fill_null("").to_pylist())
                offsets = pa.array(found.bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(chunk.first, chunk.n) for c in batch.columns[:-1]),
                        *(pa.array(c) for c in found.counts),
                        pa.array(found.digests, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(found.pairs)),
                        pa.ListArray.from_arrays(offsets, pa.array(found.times)),
                    ],
                    names=[*batch.schema.names[:-1], *COUNTS, "groups_sha256", "pairs", "times"],
                )

    return align


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pairs) to (pair, n): the documents of a task that hold each pair."""

    def out(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    pairs, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    for batch in batches:
        more = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        more, times = np.unique(more, return_counts=True)
        pairs, at = np.unique(np.concatenate([pairs, more]), return_inverse=True)
        n = np.bincount(at, np.concatenate([n, times]), len(pairs)).astype(np.int64)
        if len(pairs) > _HELD:
            yield out(pairs, n)
            pairs, n = pairs[:0], n[:0]
    yield out(pairs, n)


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, n): how many rows of ``linked`` hold each pair."""
    made = linked.select("pairs").mapInArrow(_added_up, "pair bigint, n bigint")
    return stored(made.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")


def _least_count(counts: DataFrame, most: int) -> int:
    """The least count such that at most ``most`` pairs have it or more."""
    step = F.floor(F.log2("n") * _STEPS)
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("pairs"), F.min("n").alias("least"))
    held, least = 0, 1 << 62
    for row in sizes.orderBy(F.desc("step")).collect():  # at most 64 * _STEPS rows
        held += row.pairs
        if held > most:
            return least
        least = row.least
    return 0


def alignments(docs: DataFrame, a_file: str, b_file: str, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``."""
    spark = docs.sparkSession
    b_size = len(PieceTokens(b_file).vocabulary.sizes)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shape = ", ".join([f"doc_id {id_type}", *(f"{c} bigint" for c in COUNTS), "groups_sha256 string", "pairs array<bigint>, times array<bigint>"])
    linked = stored(
        docs.select("doc_id", "text").mapInArrow(_align(a_file, b_file), shape).withColumn("row", F.monotonically_increasing_id()),
        "linked",
    )
    counts = pair_counts(linked)
    a_id = F.expr(f"pair DIV {b_size}L")
    best = stored(counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("highest")), "highest")
    least = _least_count(counts, frequent)
    common = counts.where(F.col("n") >= least).join(F.broadcast(best), a_id == F.col("a"))
    table = common.select("pair", "n", (F.col("n") == F.col("highest")).alias("top")).orderBy("pair").toArrow()
    known = spark.sparkContext.broadcast(
        (
            table["pair"].to_numpy(),
            table["n"].to_numpy(),
            table["top"].to_numpy().astype(bool),
        )
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, top = known.value
        for batch in batches:
            lists, times = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            flat, often = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (lists, times))
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            at = np.searchsorted(pairs, flat)
            seen = at < len(pairs)
            at[~seen] = 0
            if len(pairs):
                seen &= pairs[at] == flat
                sums = [_between(often * seen * weight[at], ends) for weight in (top, n)]
            else:
                sums = [np.zeros(batch.num_rows, dtype=np.int64)] * 2
            bounds = np.concatenate([[0], np.cumsum(_between(~seen, ends))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-2],
                    *(pa.array(s) for s in sums),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat[~seen])),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(often[~seen])),
                ],
                names=[*batch.schema.names[:-2], "best", "total", "pairs", "times"],
            )

    kept = ["row", "doc_id", *COUNTS, "groups_sha256"]
    kinds = ", ".join(f"{c} {linked.schema[c].dataType.simpleString()}" for c in kept)
    partly = stored(
        linked.select(*kept, "pairs", "times").mapInArrow(
            look_up, f"{kinds}, best bigint, total bigint, pairs array<bigint>, times array<bigint>"
        ),
        "counted",
    )
    rare = (
        partly.select("row", F.inline(F.arrays_zip("pairs", "times")).alias("pair", "times"))
        .join(counts.where(F.col("n") < least), "pair")
        .join(F.broadcast(best), a_id == F.col("a"))
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") == F.col("highest"), F.col("times"))).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_total"),
        )
    )
    return partly.join(rare, "row", "left").select(
        "doc_id",
        *COUNTS,
        (F.col("best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("more_total", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
