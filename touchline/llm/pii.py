"""Personal data by candidate boosting, with built-in functions alone.

Generators with high recall propose spans, which may overlap: the exact forms (e-mail, IP
address, card, phone), which always stay, and wide ones (numbers with separators, written-out
addresses). Each candidate is described by its format, in small whole numbers.

Boosted trees of depth two learn which candidates are personal data, from their format and their context: the word
before, the distance to the neighbour before, the place in the line. The description leaves out what makes
a span exact (``+``, ``@``, the brackets around ``at``) and the words that serve as labels. The examples
come from elsewhere: for it speak an exact span that a number meets, exact addresses (examples for
written-out ones), and cue words before it (``tel``, ``mail``); against it speak an exact form that fails its
check (13 to 19 digits without a right check digit, four numbers of which one is above 255, ``+`` and too few or many digits) and,
where nothing speaks for it, letters glued to it and words before it that name other things (``invoice``, ``isbn``). Any
other candidate is no example, as nothing is known of it.

Spark counts the examples of all documents by description, so learning sees all rows and the driver only a table
with one row per description, whose number the caps of the features bound. Documents fall into ``FOLDS`` by their text; each
fold is scored by trees that have not seen it, and on these scores the lowest threshold is chosen above which the counts keep the
wanted precision. Candidates that meet no exact form, have nothing against them and reach the threshold are added.

Nulls and edges: a null text is empty and has no spans; a row without ``doc_id`` is treated
like any other; repeated rows give repeated results (and count as often); with too few
examples nothing is added; further columns are kept by ``redacted`` and otherwise ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.native import Match, bound, places
from touchline.llm.shared import stored

#: Share of examples above a threshold that must be personal data, and the least number of them.
PRECISION = 0.95
LEAST = 20

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_ADDRESS = rf"^{_PART}(?:\.{_PART}){{3}}$"
#: Kind, what a text must have for the pattern to run, pattern, exact or wide.
_GENERATORS = (
    ("email", "@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", True),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", True),
    ("card", r"[0-9][0-9\x20-]{11}", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,}+", True),
    ("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", True),
    ("number", r"[0-9][0-9\x20()./-]{5}", r"[0-9](?:[\x20()./-]{0,2}[0-9]){6,}+", False),
    (
        "handle",
        r"(?i)[\[(](?:at|@)[\])]",
        r"(?i)[a-z0-9._%+-]++\x20?[\[(](?:at|@)[\])]\x20?[a-z0-9-]++(?:\x20?[\[(](?:dot|\.)[\])]\x20?[a-z0-9-]++)++",
        False,
    ),
)
KINDS = tuple(g[0] for g in _GENERATORS)
BASE_KINDS = tuple(g[0] for g in _GENERATORS if g[3])
_WORDS = "[^A-Za-z]{0,4}(?:[A-Za-z]{1,8}[^A-Za-z]{1,4})?$"
#: Words before a candidate that speak for personal data, or against it.
_CUES = (
    r"(?i)(?<![A-Za-z])(?:tel|(?:tele|cell)?phone|call|mobile|fax|card|visa|ssn|iban|account|contact|e-?mail|write|reach)(?:s|ed)?"
    rf"(?![A-Za-z]){_WORDS}"
)
_OTHERS = (
    r"(?i)(?<![A-Za-z])(?:order|invoice|isbn|issn|doi|version|build|commit|page|part|item|article|model|serial|ticket|price|total|array|index)"
    rf"(?:s|\x20?no)?(?![A-Za-z]){_WORDS}"
)

FORMAT = ("digits", "marks", "luhn", "dots", "brackets", "name", "labels", "ending")
CONTEXT = ("gap", "line", "word")
FEATURES = FORMAT + CONTEXT
#: Parts of the documents that are scored by trees fitted to the others.
FOLDS = 3


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _holds(kind: str, m: Match) -> Column:
    """The checks beyond the pattern."""
    if kind == "ip":
        return F.rlike(m.text, F.lit(_ADDRESS))
    n = F.length(_digits(m.text))
    if kind == "card":
        return n.between(13, 19) & F.call_function("luhn_check", _digits(m.text))
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _described(kind: str, m: Match) -> list[Column]:
    """Format of a candidate without what makes a span exact, and its context, each a small whole number."""
    near = F.right(m.before, F.lit(32))
    word = F.regexp_extract(near, r"(\p{L}+)[^\p{L}]*$", 1)
    begins = F.rlike(F.right(m.before, F.lit(3)), F.lit(r"(?:^|\n)[\x20\t]*$"))
    made = dict.fromkeys(FEATURES, F.lit(0)) | {
        "gap": F.when(F.length(m.before) < 16, 0).otherwise(1),
        "line": begins.cast("int"),
        # Words that serve as labels are hidden.
        "word": F.when((word == "") | (_evidence(m) != 0), 0).otherwise(1 + F.pmod(F.xxhash64(F.lower(word)), F.lit(4))),
    }
    if kind == "number":
        n = F.length(_digits(m.text))
        made |= {
            "digits": F.least(n, F.lit(20)),
            "marks": F.least(F.length(m.text) - n, F.lit(5)),
            "luhn": F.when(n.between(13, 19), F.call_function("luhn_check", _digits(m.text)).cast("int")).otherwise(0),
            "dots": F.least(F.length(F.regexp_replace(m.text, "[^.]", "")), F.lit(4)),
            "brackets": F.contains(m.text, F.lit(")")).cast("int"),
        }
    if kind in ("email", "handle"):
        bare = F.regexp_replace(m.text, r"(?i)\x20?[\[(](?:at|@)[\])]\x20?", "@")
        bare = F.regexp_replace(bare, r"(?i)\x20?[\[(](?:dot|\.)[\])]\x20?", ".")
        name, domain = F.substring_index(bare, "@", 1), F.substring_index(bare, "@", -1)
        made |= {
            "digits": F.least(F.length(_digits(name)), F.lit(5)),
            "name": F.least(F.floor(F.length(name) / 3), F.lit(4)),
            "labels": F.least(F.length(F.regexp_replace(domain, "[^.]", "")) + 1, F.lit(6)),
            "ending": F.least(F.length(F.regexp_replace(F.substring_index(domain, ".", -1), "[^A-Za-z]", "")), F.lit(8)),
        }
    return [made[name].cast("int").alias(name) for name in FEATURES]


def _evidence(m: Match) -> Column:
    """1 if the words around a candidate speak for personal data, -1 if they speak against it, else 0."""
    near = F.right(m.before, F.lit(32))
    ends = F.concat(F.right(m.before, F.lit(1)), F.lit(" "), F.left(m.after, F.lit(1)))
    return (
        F.when(F.rlike(near, F.lit(_CUES)), 1)
        .when(F.rlike(ends, F.lit(r"[\p{L}0-9_]")) | F.rlike(near, F.lit(_OTHERS)), -1)
        .otherwise(0)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with the array ``__pii_found`` of candidates: (rank, start, end, kind, features, evidence, meets, failed).

    ``meets`` tells whether a wide candidate overlaps an exact span of its text, ``failed`` whether it overlaps an exact form that
    fails its check, and ``evidence`` what the words around it say.
    """
    text = F.coalesce("text", F.lit(""))

    def of(rank: int) -> Column:
        kind, needs, pattern, is_exact = _GENERATORS[rank]

        def build(m: Match) -> Column:
            return F.struct(
                F.lit(rank).alias("rank"),
                m.start.alias("start"),
                m.end.alias("end"),
                F.lit(kind).alias("kind"),
                F.struct(*_described(kind, m)).alias("features"),
                (F.lit(0) if is_exact else _evidence(m)).alias("evidence"),
                F.coalesce(_holds(kind, m), F.lit(False)).alias("holds"),
            )

        wanted = F.contains(text, F.lit(needs)) if len(needs) == 1 else F.rlike(text, F.lit(needs))
        none = F.slice(F.array(build(Match(F.lit(0), F.lit(0), *[F.lit("")] * 4))), 1, 0)
        return F.when(wanted, places(text, pattern, build)).otherwise(none)

    exact = F.flatten(F.array(*(of(i) for i, g in enumerate(_GENERATORS) if g[3])))
    wide = F.flatten(F.array(*(of(i) for i, g in enumerate(_GENERATORS) if not g[3])))
    with_both = docs.withColumn("__pii_exact", exact).withColumn("__pii_wide", wide)

    def out(x: Column, meets: Column, failed: Column) -> Column:
        kept = (x[c].alias(c) for c in ("rank", "start", "end", "kind", "features", "evidence"))
        return F.struct(*kept, meets.alias("meets"), failed.alias("failed"))

    def overlaps(x: Column, right: bool) -> Column:
        """Whether a candidate overlaps an exact form whose check came out so."""
        return F.exists(
            "__pii_exact", lambda y: (y["holds"] == F.lit(right)) & (y["start"] < x["end"]) & (x["start"] < y["end"])
        )

    found = F.concat(
        F.transform(F.filter("__pii_exact", lambda x: x["holds"]), lambda x: out(x, F.lit(True), F.lit(False))),
        F.transform("__pii_wide", lambda x: out(x, overlaps(x, True), overlaps(x, False))),
    )
    fold = F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int")
    return with_both.withColumn("__pii_found", found).withColumn("__pii_fold", fold).drop("__pii_exact", "__pii_wide")


@dataclass(frozen=True)
class Tree:
    """Cut at ``feature <= at``, then one further cut on either side; four leaf values."""

    feature: int
    at: int
    low: tuple[int, int, float, float]
    high: tuple[int, int, float, float]


def _best_cut(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[float, int, int, float, float]:
    """(gain, feature, at, value below, value above) for the rows of a node."""
    all_g, all_h = float(g.sum()), float(h.sum())
    best = (all_g**2 / (all_h + 1), 0, 1 << 20, all_g / (all_h + 1), 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])[:-1]
        if not len(values):
            continue
        low_g, low_h = (np.cumsum(np.bincount(x[:, f], w))[values] for w in (g, h))
        gains = low_g**2 / (low_h + 1) + (all_g - low_g) ** 2 / (all_h - low_h + 1)
        i = int(gains.argmax())
        if gains[i] > best[0] + 1e-9:
            low, high = low_g[i] / (low_h[i] + 1), (all_g - low_g[i]) / (all_h - low_h[i] + 1)
            best = (float(gains[i]), f, int(values[i]), float(low), float(high))
    return best


def boosted(x: np.ndarray, yes: np.ndarray, no: np.ndarray, rounds: int = 30, shrink: float = 0.3) -> list[Tree]:
    """Trees fitted to counts of examples for and against each description."""
    score, trees = np.zeros(len(x)), []
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-score))
        g, h = yes * (1 - p) - no * p, (yes + no) * p * (1 - p)
        _, feature, at, _, _ = _best_cut(x, g, h)
        below = x[:, feature] <= at
        sides = []
        for side in (below, ~below):
            _, f, c, low, high = _best_cut(x[side], g[side], h[side]) if side.any() else (0, 0, 1 << 20, 0.0, 0.0)
            sides.append((f, c, shrink * low, shrink * high))
        trees.append(Tree(feature, at, *sides))
        score += _scores(x, trees[-1:])
    return trees


def _scores(x: np.ndarray, trees: list[Tree]) -> np.ndarray:
    total = np.zeros(len(x))
    for t in trees:
        low, high = (np.where(x[:, f] <= c, a, b) for f, c, a, b in (t.low, t.high))
        total += np.where(x[:, t.feature] <= t.at, low, high)
    return total


@dataclass(frozen=True)
class Model:
    """Trees and least score of each wide kind that may be added."""

    trees: dict[str, list[Tree]]
    thresholds: dict[str, float]

    def score(self, kind: str, features: Column) -> Column:
        """The sum of the leaves of the kind's trees."""

        def side(cut: tuple[int, int, float, float]) -> Column:
            f, at, low, high = cut
            return F.when(features[FEATURES[f]] <= at, F.lit(low)).otherwise(F.lit(high))

        total = F.lit(0.0)
        for t in self.trees[kind]:
            total = total + F.when(features[FEATURES[t.feature]] <= t.at, side(t.low)).otherwise(side(t.high))
        return total


def calibrated(scores: np.ndarray, yes: np.ndarray, no: np.ndarray, precision: float, least: int) -> float | None:
    """The lowest score that keeps ``precision`` over at least ``least`` examples, if there is one.

    A score whose own examples are mostly against ends the search, however many better ones outweigh them; so does
    a lower precision, as soon as there are enough examples to tell.
    """
    found = None
    for t in sorted(set(scores.tolist()), reverse=True):
        above, at = scores >= t, scores == t
        if yes[at].sum() < no[at].sum():
            break
        if (yes + no)[above].sum() < least:
            continue
        if yes[above].sum() < precision * (yes + no)[above].sum():
            break
        found = t
    return found


def learn(found: DataFrame, precision: float = PRECISION, least: int = LEAST) -> Model:
    """Count the examples of each wide kind by description and fold, and fit trees and a threshold to the counts.

    ``found`` has the column ``__pii_fold``.
    """
    wide = [k for k in KINDS if k not in BASE_KINDS]
    x, is_wide = F.col("x"), F.col("x.kind").isin(wide)
    good = ~is_wide | x["meets"] | (~x["failed"] & (x["evidence"] > 0))
    bad = ~good & (x["failed"] | (x["evidence"] < 0))
    folds = range(FOLDS)
    # One row per kind and description: at most 21 * 6 * 2 * 5 * 2 numbers and 6 * 5 * 7 * 9 addresses, in 2 * 2 * 5 contexts.
    counts = (
        found.select(F.explode("__pii_found").alias("x"), "__pii_fold")
        .where((is_wide & (good | bad)) | (F.col("x.kind") == "email"))
        .groupBy(F.when(F.col("x.kind") == "email", "handle").otherwise(F.col("x.kind")).alias("kind"), "x.features")
        .agg(
            *(F.count_if(good & (F.col("__pii_fold") == i)).alias(f"yes{i}") for i in folds),
            *(F.count_if(~good & (F.col("__pii_fold") == i)).alias(f"no{i}") for i in folds),
        )
        .select("kind", "features.*", *(f"{c}{i}" for c in ("yes", "no") for i in folds))
        .orderBy("kind", *FEATURES)
        .toArrow()
    )
    kinds = np.array(counts["kind"].to_pylist(), dtype=object)
    trees, thresholds = {}, {}
    for kind in wide:
        mine = kinds == kind
        features, yes, no = (
            np.stack([counts[c].to_numpy()[mine] for c in names], axis=1)
            for names in (FEATURES, [f"yes{i}" for i in folds], [f"no{i}" for i in folds])
        )
        yes, no = yes.astype(float), no.astype(float)
        unseen = [
            _scores(features, boosted(*_with_examples(features, yes.sum(1) - yes[:, i], no.sum(1) - no[:, i]))) for i in folds
        ]
        trees[kind] = boosted(features, yes.sum(1), no.sum(1))
        held = np.stack(unseen, axis=1).ravel() if len(features) else np.zeros(0)
        there = (yes + no).ravel() > 0
        threshold = calibrated(held[there], yes.ravel()[there], no.ravel()[there], precision, least)
        if threshold is not None:
            thresholds[kind] = threshold
    return Model(trees, thresholds)


def _with_examples(x: np.ndarray, yes: np.ndarray, no: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    some = yes + no > 0
    return x[some], yes[some], no[some]


def spans(model: Model) -> Column:
    """The spans of a row: all exact ones, and wide ones apart from exact forms, with nothing against them, that reach their threshold; by kind, then start."""

    def keep(x: Column) -> Column:
        good = x["kind"].isin(*BASE_KINDS)
        for kind, least in model.thresholds.items():
            apart = (x["kind"] == kind) & ~x["meets"] & ~x["failed"] & (x["evidence"] >= 0)
            good = good | (apart & (model.score(kind, x["features"]) >= least - 1e-9))
        return good

    return F.array_sort(
        F.transform(F.filter("__pii_found", keep), lambda x: F.struct(*(x[c].alias(c) for c in ("rank", "start", "end", "kind"))))
    )


def detected(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for every row: an array of (rank, start, end, kind) in code points, end exclusive."""
    found = stored(candidates(docs.select("doc_id", "text")).drop("text"), "candidates")
    return found.select("doc_id", spans(learn(found)).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets.

    Overlapping spans become one. ``n_chars``, where there is such a column, follows the new text.
    """
    found = stored(candidates(docs), "candidates")
    marked = found.withColumn("__pii_spans", spans(learn(found)))
    ordered = F.array_sort(F.transform("__pii_spans", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    # Texts are cut block by block, of about the root of the number of spans, so that no step copies the whole text.
    width = F.ceil(F.sqrt(F.size("__pii_spans"))).cast("int")

    def block(t: Column, first: Column) -> Column:
        mine = F.slice("__pii_ordered", first, width)
        upto = F.greatest(t["at"], F.array_max(F.transform(mine, lambda x: x["end"])))
        piece = F.struct(F.substring(F.col("text"), t["at"] + 1, upto - t["at"]).alias("text"), upto.alias("upto"), mine.alias("spans"))

        def inside(p: Column) -> Column:
            def step(s: Column, x: Column) -> Column:
                between = F.substring(p["text"], s["at"] - t["at"] + 1, x["start"] - s["at"])
                out = F.concat(s["out"], between, F.lit("["), F.upper(x["kind"]), F.lit("]"))
                fresh = x["start"] >= s["at"]
                return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(fresh, out).otherwise(s["out"]).alias("out"))

            start = F.struct(t["at"].alias("at"), F.lit("").alias("out"))
            return F.struct(p["upto"].alias("at"), F.array_append(t["out"], F.aggregate(p["spans"], start, step)["out"]).alias("out"))

        return bound(piece, inside)

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    text = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size("__pii_spans"), F.lit(1)), F.greatest(width, F.lit(1))),
        none,
        block,
        lambda t: F.concat(F.array_join(t["out"], ""), F.substring(F.col("text"), t["at"] + 1, F.length("text"))),
    )
    marked = marked.withColumn("__pii_ordered", ordered)
    changed = F.when(F.size("__pii_spans") > 0, text).otherwise(F.col("text"))
    out = marked.withColumn("text", changed)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn(
            "n_chars", F.when(F.size("__pii_spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
