"""The operators' results spelled out with plain loops, for small tables."""

from __future__ import annotations

import hashlib
import re

import numpy as np

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def sha(parts: list[str]) -> str:
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def contamination(docs, items, window=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row."""
    windows: dict[tuple, set] = {}
    for item_id, text in items:
        words = ALNUM.findall(lower(text))
        n = min(window, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    for doc_id, text in docs:
        words, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (w := tuple(words[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        named = sorted(str(x) for x in found if x is not None)
        yield doc_id, len(words), len(hit), len(named), sha(named), bool(hit)


def shingles(text, k):
    words = NOT_SPACE.findall(lower(text))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def near_duplicates(docs, k, num, den):
    """(doc_id, n_shingles, component_id) per row."""
    sets = [shingles(t, k) if i is not None else shingles(t, k) for i, t in docs]
    group = list(range(len(docs)))

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if docs[a][0] is None or docs[b][0] is None or not sets[a] or not sets[b]:
                continue
            if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                group[top(a)] = top(b)
    smallest: dict[int, int] = {}
    for x, (i, _) in enumerate(docs):
        if i is not None:
            smallest[top(x)] = min(i, smallest.get(top(x), i))
    return [(i, len(sets[x]), None if i is None else smallest[top(x)]) for x, (i, _) in enumerate(docs)]


def licences(text):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    words, starts, labels = ALNUM.findall(lower(text)), [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(m) -> str:
    return re.sub("[^0-9]", "", m.group())


PERSONAL = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 13 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(_digits(m)) <= 15),
)
SECRET = (
    (
        "assign",
        re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        lambda m: len(m.group(2)) >= 6,
    ),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 24),
)


def spans(text, kinds, by_start=False):
    """Counts by kind, and the digest of the base spans."""
    found = [
        (m.start(), rank, f"{kind}:{m.start()}:{m.end()}")
        for rank, (kind, pattern, holds) in enumerate(kinds)
        for m in pattern.finditer(text or "")
        if holds(m)
    ]
    found.sort(key=lambda x: (x[0], x[1]) if by_start else (x[1], x[0]))
    counts = tuple(sum(x[1] == rank for x in found) for rank in range(len(kinds)))
    return (*counts, sha([x[2] for x in found]))


def embeddings(rows, least):
    """(vec_id, n_links, component_id, kept) per row."""
    usable = [
        r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
        for r in rows
    ]
    links = [set() for _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if usable[a] and usable[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[a].add(b)
                    links[b].add(a)
    for a, r in enumerate(rows):
        seen, stack = {a}, [a]
        while stack:
            for b in links[stack.pop()] - seen:
                seen.add(b)
                stack.append(b)
        smallest = min((rows[b][0] for b in seen), default=None) if r[0] is not None else None
        yield r[0], len(links[a]), smallest, smallest is not None and smallest == r[0]


def rule_figures(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    words = NOT_SPACE.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)} if len(words) < 5000 else None
    if covered is None:  # long texts: count once
        n: dict[tuple, int] = {}
        for w in windows:
            n[w] = n.get(w, 0) + 1
        covered = {p for i, w in enumerate(windows) if n[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if NOT_SPACE.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def alignments(docs, a_tokens, b_tokens):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256); tokenizers give lists of (id, bytes)."""
    made = []
    for doc_id, text in docs:
        a, b = (f(text) if text else [] for f in (a_tokens, b_tokens))
        whole = b" " + (text or "").encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []
        spans = []
        for tokens in (a, b):
            at, kind = 0, []
            for i, raw in tokens:
                kind.append((i, at, at + len(raw)))
                at += len(raw)
            spans.append(kind)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, last = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in kind if last <= s and e <= cut) for kind in spans))
            last = cut
        linked = [(x, y) for x, s, e in spans[0] for y, t, f in spans[1] if s < f and t < e]
        made.append((doc_id, len(a), len(b), groups, linked))
    counts: dict[tuple, int] = {}
    for *_, linked in made:
        for pair in set(linked):
            counts[pair] = counts.get(pair, 0) + 1
    highest: dict[int, int] = {}
    for (x, _), n in counts.items():
        highest[x] = max(n, highest.get(x, 0))
    for doc_id, n_a, n_b, groups, linked in made:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(counts[p] == highest[p[0]] for p in linked)
        yield doc_id, n_a, n_b, len(groups), len(linked), n_best, sum(counts[p] for p in linked), digest


def edited(a, b):
    """Whether one insertion, deletion or replacement turns ``a`` into ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelling_words(docs):
    """{word: n} of the corpus, with the occurrences that lose a code point."""
    import zlib

    counts: dict[str, int] = {}
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def spelling_groups(words, ratio=2):
    """(word, n, n_near, form, form_n, root) per word."""
    forms, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in words if edited(v, w)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        yield w, n, len(near[w]), forms[w], words.get(forms[w]), root


def licence_labels(docs, phrases, notices, rare=8, agree=0.6, slack=6, drift=12):
    """(doc_id, labels, score) per row, with document frequencies over all rows."""
    import math

    texts = [ALNUM.findall(lower(t)) for _, t in docs]
    templates = [(t.label, t.text.split(), [p.split() for p in t.phrases]) for t in (*phrases, *notices)]
    wanted = {w for _, words, _ in templates for w in words}
    found = {w: sum(w in set(x) for x in texts) for w in wanted}
    for (doc_id, _), words in zip(docs, texts, strict=True):
        labels, score = set(), 0.0
        for label, wording, mandatory in templates:
            chosen = sorted(range(len(wording)), key=lambda q: (-math.log((len(docs) + 1) / (found[wording[q]] + 1)), q))
            chosen = chosen[:rare] if mandatory else chosen
            starts = sorted(((i - q, q) for i, w in enumerate(words) for q in chosen if wording[q] == w), key=lambda x: x[0])
            groups: list[list] = []
            for s, q in starts:
                if groups and s - groups[-1][-1][0] <= (slack if mandatory else 0) and s - groups[-1][0][0] <= drift:
                    groups[-1].append((s, q))
                else:
                    groups.append([(s, q)])
            for group in groups:
                share = len({q for _, q in group}) / len(chosen)
                if share < (agree if mandatory else 1):
                    continue
                margin = slack if mandatory else 0
                part = words[max(0, group[0][0] - margin) : group[-1][0] + len(wording) + margin]
                whole = " " + " ".join(part) + " "
                if all(" " + " ".join(p) + " " in whole for p in (mandatory or [wording])):
                    labels.add(label)
                    score = max(score, share)
        yield doc_id, ",".join(sorted(labels)), score
