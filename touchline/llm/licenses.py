"""Licence scan with a positional index of rare words.

A template is a known licence text or notice with the phrases that it must not lack. Of
each template the words with the highest inverse document frequency are indexed with their positions; the
frequencies of the templates' words are counted over all documents. In a text, the few words found in that index each
say where the template would start; a template is a candidate where enough different rare words agree on
the start, allowing for a few words put in or left out from one to the next, and ``DRIFT`` in all. A candidate counts once all
its mandatory phrases stand, word by word, in the place it covers. A template that is
itself one phrase needs all its rare words to agree exactly.

Words are runs of letters and digits, A-Z lowered; anything beyond ASCII is a letter.

Nulls and edges: a null text is empty; texts without words match nothing; several places of
one template all count; repeated rows, null ids and further columns do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm import arrays

#: Rare words of a template that are indexed.
RARE = 8
#: Share of the rare words that must agree on a start.
AGREE = 0.6
#: Words by which the starts may differ, for texts longer than a phrase.
SLACK = 6
#: Words by which the last start of a place may lie after the first.
DRIFT = 12


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    #: Mandatory phrases; none means the whole text is one phrase.
    phrases: tuple[str, ...] = ()


# Names and published wordings of licences, in lower case.
PHRASES = (
    Template("mit", "mit license"),
    Template("apache", "apache license"),
    Template("gpl", "general public license"),
)
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files to deal in the software without restriction",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    Template(
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at"
        " http www apache org licenses license 2 0",
        ("except in compliance with the license", "apache org licenses license 2 0"),
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation",
        ("redistribute it and or modify it", "gnu general public license"),
    ),
    Template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser"
        " general public license",
        ("gnu lesser general public license",),
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        ("redistribution and use in source and binary forms", "following conditions are met"),
    ),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "creative commons attribution 4 0 international", ("creative commons attribution",)),
    Template("proprietary", "all rights reserved", ()),
)


def word_hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    bounds = np.array([0, len(data)])
    chunk = arrays.Chunk(0, data, bounds)
    return arrays.hashes(chunk.lowered(), arrays.words(chunk.lowered(), bounds, arrays.ALNUM))


class Index:
    """Rare words of all templates with their positions, ready to be looked up by hash."""

    def __init__(self, templates: tuple[Template, ...], base: int, found: dict[int, int] | None = None, docs: int = 0) -> None:
        """The first ``base`` templates are base phrases; ``found`` says how many of ``docs`` documents have a word."""
        self.templates, self.base, found = templates, base, found or {}
        self.hashed = [word_hashes(t.text) for t in templates]
        self.phrases = [[word_hashes(p) for p in t.phrases] or [self.hashed[i]] for i, t in enumerate(templates)]
        entries, self.rare = [], []
        for i, words in enumerate(self.hashed):
            idf = {h: math.log((docs + 1) / (found.get(h, 0) + 1)) for h in words.tolist()}
            whole = not templates[i].phrases
            chosen = sorted(range(len(words)), key=lambda q: (-idf[int(words[q])], q))[: None if whole else RARE]
            self.rare.append(len(chosen))
            entries += [(int(words[q]), i, q) for q in chosen]
        entries.sort()
        self.keys = np.array([e[0] for e in entries], dtype=np.uint64)
        self.which = np.array([e[1] for e in entries], dtype=np.int64)
        self.at = np.array([e[2] for e in entries], dtype=np.int64)

    def places(self, hashed: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(text, template, first word, end, share of rare words) of all verified matches in a chunk."""
        low = np.searchsorted(self.keys, hashed)
        hit = np.flatnonzero(self.keys[np.minimum(low, len(self.keys) - 1)] == hashed)
        if not len(hit):
            return []
        counts = np.searchsorted(self.keys, hashed[hit], side="right") - low[hit]
        entry = np.repeat(low[hit], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        word = np.repeat(hit, counts)
        owner = np.searchsorted(bounds, word, side="right") - 1
        which, start = self.which[entry], word - self.at[entry]
        order = np.lexsort((start, which, owner))
        owner, which, start, at = owner[order], which[order], start[order], self.at[entry][order]
        phrase = np.array([not t.phrases for t in self.templates])
        gap = np.where(phrase[which], 0, SLACK)
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (which[1:] != which[:-1]) | (start[1:] - start[:-1] > gap[1:])
        cuts = _bounded(np.append(np.flatnonzero(fresh), len(order)), start)
        need = np.array([n if p else math.ceil(AGREE * n) for n, p in zip(self.rare, phrase, strict=True)])
        out = []
        for c in np.flatnonzero(np.diff(cuts) >= need[which[cuts[:-1]]]).tolist():
            a, b = int(cuts[c]), int(cuts[c + 1])
            t, d = int(which[a]), int(owner[a])
            share = len(set(at[a:b].tolist())) / self.rare[t]
            if share < (1 if phrase[t] else AGREE):
                continue
            slack = 0 if phrase[t] else SLACK
            first = max(int(start[a]) - slack, int(bounds[d]))
            end = min(int(start[b - 1]) + len(self.hashed[t]) + slack, int(bounds[d + 1]))
            if all(_holds(hashed[first:end], p) for p in self.phrases[t]):
                first = max(int(start[a]), int(bounds[d]))
                out.append((d, t, first - int(bounds[d]), end - int(bounds[d]), share))
        return out


def _bounded(cuts: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Groups of starts, cut again where one lies more than ``DRIFT`` after the first of its group."""
    more = []
    for c in np.flatnonzero(start[cuts[1:] - 1] - start[cuts[:-1]] > DRIFT).tolist():
        first = int(cuts[c])
        while (at := int(np.searchsorted(start[first : cuts[c + 1]], start[first] + DRIFT, side="right")) + first) < cuts[c + 1]:
            more.append(at)
            first = at
    return np.sort(np.append(cuts, more)).astype(np.int64) if more else cuts


def frequencies(docs: DataFrame, words: np.ndarray) -> tuple[dict[int, int], int]:
    """How many documents have each of some words (by hash), and the number of documents."""
    wanted = docs.sparkSession.sparkContext.broadcast(np.unique(words))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = wanted.value
        total, n = np.zeros(len(keys), dtype=np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for chunk in arrays.chunks(batch.column(0)):
                data = chunk.lowered()
                found = arrays.words(data, chunk.bounds, arrays.ALNUM)
                hashed = arrays.hashes(data, found)
                at = np.minimum(np.searchsorted(keys, hashed), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == hashed)
                owner = np.searchsorted(found.bounds, hit, side="right") - 1
                total += np.bincount(np.unique(owner * len(keys) + at[hit]) % len(keys), minlength=len(keys))
        names = np.append(keys.view(np.int64), 0)
        yield pa.RecordBatch.from_pydict({"h": names, "all": np.arange(len(names)) == len(keys), "n": np.append(total, n)})

    rows = (
        docs.select("text").mapInArrow(count, "h bigint, all boolean, n bigint").groupBy("h", "all").agg(F.sum("n").alias("n"))
    ).collect()  # one row per word of the templates
    return {r.h % (1 << 64): r.n for r in rows if not r["all"]}, sum(r.n for r in rows if r["all"])


def _holds(words: np.ndarray, phrase: np.ndarray) -> bool:
    n = len(words) - len(phrase) + 1
    if n <= 0:
        return False
    same = np.ones(n, dtype=bool)
    for j, h in enumerate(phrase):
        same &= words[j : j + n] == h
    return bool(same.any())


_PLACES = pa.list_(
    pa.struct(
        [("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64()), ("share", pa.float64())]
    )
)


def scanned(docs: DataFrame, base: tuple[Template, ...] = PHRASES, more: tuple[Template, ...] = NOTICES) -> DataFrame:
    """(doc_id, n_words, places) for every row; places are ranges of words with their label.

    ``share`` is the share of a template's rare words that were found where they belong.
    """
    words = np.concatenate([word_hashes(t.text) for t in base + more])
    index = docs.sparkSession.sparkContext.broadcast(Index(base + more, len(base), *frequencies(docs, words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1)):
                data = chunk.lowered()
                found = arrays.words(data, chunk.bounds, arrays.ALNUM)
                rows: list[list[dict]] = [[] for _ in range(chunk.n)]
                for d, t, start, end, share in known.places(arrays.hashes(data, found), found.bounds):
                    label = known.templates[t].label
                    rows[d].append({"label": label, "base": t < known.base, "start": start, "end": end, "share": share})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(chunk.first, chunk.n),
                        pa.array(np.diff(found.bounds), pa.int64()),
                        pa.array(rows, _PLACES),
                    ],
                    names=["doc_id", "n_words", "places"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words bigint, places array<struct<label: string,"
        " base: boolean, start: bigint, end: bigint, share: double>>",
    )
