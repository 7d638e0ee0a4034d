"""Language of texts, and of the spans of mixed texts.

A word is a run of letters. Its script, read from character ranges, narrows the languages
to those that were seen to use that script. Among these a word scores by the log
likelihood of its byte trigrams, word ends included. The Viterbi path over the words of a
text pays a penalty for each switch of language, so single odd words stay with their
neighbours and real spans of another language come out as spans. The language of
a text is that of most of its words.

The trigram counts come from at most about ``max_docs`` labelled documents, chosen by a
hash of their id, and are added up by Spark; a table of fixed size goes to the tasks.

Nulls and edges: a null text, or one without a letter, is ``und`` with score 0; rows without
language or id are never learnt from; a row without id is predicted; with nothing
learnt all texts are ``und``; of languages with equally many words the first by name wins;
repeated rows and further columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm import arrays

#: Bound of the sample that is learnt from (about; the hash picks a share of the rows).
MAX_DOCS = 30_000
SWITCH = 8.0
_BUCKETS = 1 << 16
#: A language uses a script if so large a share of its words is written in it.
_USES = 0.01
_UNLIKELY = -30.0

# Lead bytes of UTF-8 by script.
_SCRIPT_RANGES = (
    ("latin", 0xC3, 0xCA),
    ("greek", 0xCD, 0xCF),
    ("cyrillic", 0xD0, 0xD3),
    ("armenian", 0xD4, 0xD6),
    ("hebrew", 0xD7, 0xD7),
    ("arabic", 0xD8, 0xDC),
    ("indic", 0xE0, 0xE0),
    ("asian", 0xE1, 0xE1),
    ("kana", 0xE3, 0xE3),
    ("han", 0xE4, 0xE9),
    ("hangul", 0xEA, 0xED),
)
_SCRIPT = np.zeros(256, dtype=np.uint8)
_SCRIPT[0x41:0x5B] = _SCRIPT[0x61:0x7B] = 1
for _i, (_, _low, _high) in enumerate(_SCRIPT_RANGES):
    _SCRIPT[_low : _high + 1] = _i + 1
_N_SCRIPTS = len(_SCRIPT_RANGES) + 1
_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[0x41:0x5B] = _LETTERS[0x61:0x7B] = _LETTERS[0x80:] = True


def _features(chunk: arrays.Chunk) -> tuple[arrays.Words, np.ndarray, np.ndarray]:
    """Words, trigram bucket of each of their bytes (in a row), and script of each word."""
    data = chunk.lowered()
    accented = np.zeros(len(data), dtype=bool)
    accented[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    data = np.where(accented, data + np.uint8(0x20), data)
    found = arrays.words(data, chunk.bounds, _LETTERS)
    padded = np.where(_LETTERS[data], data, np.uint8(0x20)).astype(np.uint32)
    before, after = np.roll(padded, 1), np.roll(padded, -1)
    before[found.starts], after[found.ends - 1] = 0x20, 0x20
    code = (before << np.uint32(16)) | (padded << np.uint32(8)) | after
    buckets = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    inside = _LETTERS[data]
    firsts = np.concatenate([[0], np.cumsum(found.ends - found.starts)[:-1]]) if len(found) else np.zeros(0, int)
    scripts = _SCRIPT[data[inside]]
    scripts = np.maximum.reduceat(scripts, firsts) if len(found) else scripts[:0]
    return found, buckets[inside], scripts


@dataclass
class Model:
    """Log likelihood of each trigram bucket, and of each script, by language."""

    languages: list[str]
    grams: np.ndarray
    uses: np.ndarray

    def words(self, chunk: arrays.Chunk) -> tuple[arrays.Words, np.ndarray]:
        """Words of a chunk and their score for each language; 0 for the likeliest."""
        found, buckets, scripts = _features(chunk)
        if not len(found):
            return found, np.zeros((0, len(self.languages)), dtype=np.float32)
        firsts = np.concatenate([[0], np.cumsum(found.ends - found.starts)[:-1]])
        scores = np.add.reduceat(self.grams[buckets], firsts, axis=0) + self.uses[scripts]
        return found, scores - scores.max(axis=1, keepdims=True)


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float) -> np.ndarray:
    """Best language of each word; ``bounds`` cut the words into texts. All texts go step by step together."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    rank = np.empty(len(sizes), dtype=np.int64)
    rank[order] = np.arange(len(sizes))
    steps = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes[order], -np.arange(steps), side="left")
    offsets = np.concatenate([[0], np.cumsum(active)])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = offsets[np.arange(len(scores)) - bounds[:-1][owner]] + rank[owner]
    by_step = np.empty_like(scores)
    by_step[place] = scores
    stay = np.ones(scores.shape, dtype=bool)
    best = np.zeros(len(scores), dtype=np.uint16)
    last = np.zeros((len(sizes), scores.shape[1]), dtype=scores.dtype)
    value = by_step[: offsets[1]] if steps else last[:0]
    for t in range(1, steps):
        a, b = offsets[t], offsets[t + 1]
        last[b - a : len(value)] = value[b - a :]
        value = value[: b - a]
        best[a:b] = value.argmax(axis=1)
        other = value.max(axis=1, keepdims=True) - switch
        np.greater_equal(value, other, out=stay[a:b])
        value = np.maximum(value, other) + by_step[a:b]
    last[: len(value)] = value
    state = last.argmax(axis=1)
    out = np.empty(len(scores), dtype=np.uint16)
    for t in range(steps - 1, -1, -1):
        a, b = offsets[t], offsets[t + 1]
        if t + 1 < steps:
            c, d = offsets[t + 1], offsets[t + 2]
            now = state[: d - c]
            kept = stay[c:d][np.arange(d - c), now]
            state[: d - c] = np.where(kept, now, best[c:d])
        out[a:b] = state[: b - a]
    return out[place]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, kind, at, n): trigram buckets (kind 0) and scripts of words (kind 1) of a task's rows."""
    grams: dict[str, np.ndarray] = {}
    scripts: dict[str, np.ndarray] = {}
    for batch in batches:
        for chunk in arrays.chunks(batch.column("text")):
            found, buckets, used = _features(chunk)
            names = np.array(batch.column("lang").slice(chunk.first, chunk.n).to_pylist(), dtype=object)
            by_word = np.repeat(names, np.diff(found.bounds))
            by_byte = np.repeat(by_word, found.ends - found.starts)
            for name in set(names.tolist()):
                grams[name] = grams.get(name, 0) + np.bincount(buckets[by_byte == name], minlength=_BUCKETS)
                scripts[name] = scripts.get(name, 0) + np.bincount(used[by_word == name], minlength=_N_SCRIPTS)
    for kind, found in ((0, grams), (1, scripts)):
        for name, counts in found.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array([kind] * len(at), pa.int32()), pa.array(at), pa.array(counts[at])],
                names=["lang", "kind", "at", "n"],
            )


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def learn(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model:
    """Trigram and script statistics of the labelled rows that are not held out.

    Each language has an equal part of ``max_docs``; one with fewer documents gives all of them, so that a rare language
    is not lost beside frequent ones.
    """
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # One row per language, as many as the model has columns.
    sizes = usable.groupBy("lang").agg(F.count("*").alias("size"))
    each = max_docs / max(1, sizes.count())
    scale = 1 << 30
    picked = usable.join(F.broadcast(sizes), "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < F.least(F.lit(1.0), F.lit(each) / F.col("size")) * scale
    )
    sums = (
        picked.where("text IS NOT NULL")
        .select("lang", "text")
        .mapInArrow(_counts, "lang string, kind int, at bigint, n bigint")
        .groupBy("lang", "kind", "at")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    name, kind, at, n = (np.array(sums.column(c).to_pylist()) for c in ("lang", "kind", "at", "n"))
    languages = sorted(set(name.tolist()))
    grams = np.zeros((_BUCKETS, len(languages)))
    scripts = np.zeros((_N_SCRIPTS, len(languages)))
    for i, language in enumerate(languages):
        for table, which in ((grams, 0), (scripts, 1)):
            rows = (name == language) & (kind == which)
            table[at[rows], i] = n[rows]
    grams = np.log((grams + 0.1) / (grams.sum(axis=0) + 0.1 * _BUCKETS))
    used = scripts / np.maximum(scripts.sum(axis=0), 1) >= _USES
    used |= ~used.any(axis=1, keepdims=True)  # of a script that nobody uses, nothing is known
    return Model(languages, grams.astype(np.float32), np.where(used, 0, _UNLIKELY).astype(np.float32))


def _has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "ignore"))


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))


def _spans(chunk: arrays.Chunk, found: arrays.Words, path: np.ndarray, languages: list[str]) -> list[list[dict]]:
    """Runs of words of one language, as code points of their text, end exclusive."""
    points = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])
    out: list[list[dict]] = []
    for i in range(chunk.n):
        a, b = int(found.bounds[i]), int(found.bounds[i + 1])
        cuts = [a, *(np.flatnonzero(np.diff(path[a:b].astype(int))) + a + 1).tolist(), b] if b > a else []
        zero = points[chunk.bounds[i]]
        out.append(
            [
                {
                    "start": int(points[found.starts[x]] - zero),
                    "end": int(points[found.ends[y - 1]] - zero),
                    "lang": languages[path[x]],
                }
                for x, y in zip(cuts, cuts[1:], strict=False)
            ]
        )
    return out


def predicted(docs: DataFrame, model: Model, switch: float = SWITCH, spans: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, with ``spans`` also the array (start, end, lang).

    ``score`` is the share of words that the predicted language holds.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    group = max(1 << 20, (1 << 26) // max(4, len(model.languages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shared.value
        n_lang = len(learnt.languages)
        for batch in batches:
            for big in arrays.chunks(batch.column(1), group):
                parts, sizes, scores, cut = [], [], [], big.bounds
                ids = batch.column(0).slice(big.first, big.n)
                low = 0
                while low < big.n:
                    high = max(low + 1, int(np.searchsorted(cut, cut[low] + arrays.CHUNK_BYTES, side="right")) - 1)
                    part = arrays.Chunk(low, big.data[cut[low] : cut[high]], cut[low : high + 1] - cut[low])
                    found, made = learnt.words(part) if n_lang else (None, None)
                    parts.append((part, found))
                    if n_lang:
                        sizes.append(np.diff(found.bounds))
                        scores.append(made)
                    low = high
                if not n_lang:
                    names, share = ["und"] * big.n, np.zeros(big.n)
                    path = np.zeros(0, dtype=np.uint16)
                else:
                    size = np.concatenate(sizes)
                    bounds = np.concatenate([[0], np.cumsum(size)])
                    path = viterbi(np.concatenate(scores), bounds, switch)
                    owner = np.repeat(np.arange(big.n), size)
                    votes = np.bincount(owner * n_lang + path, minlength=big.n * n_lang).reshape(big.n, n_lang)
                    share = votes.max(axis=1) / np.maximum(size, 1)
                    names = np.array(learnt.languages, dtype=object)[votes.argmax(axis=1)]
                    ascii_letter = np.concatenate(
                        [np.bincount(np.repeat(np.arange(p.n), np.diff(p.bounds)), _SCRIPT[p.data] == 1, p.n) for p, _ in parts]
                    )
                    for i in np.flatnonzero(ascii_letter == 0).tolist():
                        if not _has_letter(big.data[cut[i] : cut[i + 1]].tobytes()):
                            names[i], share[i] = "und", 0.0
                columns = [ids, pa.array(list(names), pa.string()), pa.array(share)]
                if spans:
                    out, at = [], 0
                    for part, found in parts:
                        n = len(found) if found is not None else 0
                        out += _spans(part, found, path[at : at + n], learnt.languages) if found is not None else [[]] * part.n
                        at += n
                    columns.append(pa.array([[] if x == "und" else s for x, s in zip(names, out, strict=True)], _SPANS))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "spans"][: len(columns)])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    if spans:
        schema += ", spans array<struct<start: bigint, end: bigint, lang: string>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
