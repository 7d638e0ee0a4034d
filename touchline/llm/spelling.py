"""Groups of spelling variants by asymmetric q-chunks.

Words are counted over all documents; a word's near words differ from it by exactly one inserted,
deleted or replaced code point. Of two near words the one that is no longer (``L`` code points) contributes two
disjoint chunks of ``L // 2`` code points, its beginning and its end; the other one contributes its positional grams of that
size. One edit cannot touch both chunks, so one of them is preserved, shifted by at most the difference in
length. Places are counted from the nearer end, which takes up the shift: grams elsewhere can meet no chunk and
are not made. Pairs that meet are verified by their edit distance; a pair that shares both chunks counts
at the first.

Common chunks (beginnings such as ``in``) would bring very many words together. Keys are counted in ``BUCKETS``
counters; where the pairs of a counter exceed ``PAIRS``, its words meet by the chunk *and* what one edit leaves
of the rest: the rest with one place blotted out (replacement), or without one place (insertion). Both ways
find the same pairs, so chance meetings of keys in a counter change work and not results. At most ``BUCKETS`` numbers of
crowded counters are broadcast. All other joins are sort-merge joins by a hint: Spark sizes a table of exploded rows by the
file it comes from, and would broadcast the keys of a vocabulary of a few MB, which are many times as large.

A word's form is its most frequent near word, if that is at least ``RATIO`` times as frequent; roots follow forms to
the last by pointer doubling: counts double at each step, so a few rounds of one join end it.

Nulls and edges: a null text has no words; a null ``doc_id`` counts as an empty one in the hash of occurrences; repeated
rows count as often; ties between forms go to the first word in code-point order; an empty table gives no words;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import stored

LENGTH = 5
TIMES = 3
RATIO = 2
#: Counters of the words that meet at a key, and the pairs of one counter above which keys are refined.
BUCKETS = 1 << 20
PAIRS = 4096

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def occurrences(docs: DataFrame, length: int = LENGTH, drop_one_in: int | None = 97) -> DataFrame:
    """(word): one row per run of letters of ``length`` code points or more.

    With ``drop_one_in``, occurrences whose hash it divides lose the code point that the hash names.
    """
    run = F.col("run")
    lowered = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{length},}}"), F.lit(0))).alias("run"),
    ).withColumn("run", F.when(run.rlike("[A-Z]"), F.translate(run, _UPPER, _LOWER)).otherwise(run))
    if drop_one_in is None:
        return lowered.select(run.alias("word"))
    hashed = lowered.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run"))
    shorter = F.concat(F.substring("run", F.lit(1), at.cast("int")), F.substring("run", (at + 2).cast("int"), F.length("run")))
    word = F.when(F.col("h") % drop_one_in == 0, shorter).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= length)


def vocabulary(docs: DataFrame, length: int = LENGTH, times: int = TIMES, drop_one_in: int | None = 97) -> DataFrame:
    """(word, n) of the words of ``length`` code points or more that occur ``times`` times or more."""
    counted = occurrences(docs, length, drop_one_in).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= times)


def _keys(words: DataFrame, longer: int, length: int) -> DataFrame:
    """(k, side, word, n, size): the two chunks of words as partners of words with ``longer`` code points less."""
    size = F.length("word") - longer
    q = F.floor(size / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", F.lit(1), q).alias("chunk")),
        F.struct(F.lit(1).alias("side"), F.substring("word", F.length("word") - q + 1, q).alias("chunk")),
    )
    return (
        words.where(size >= length)
        .select("word", "n", size.alias("size"), F.inline(sides))
        .select(F.xxhash64("size", "side", "chunk").alias("k"), "side", "word", "n", "size")
    )


def _refined(keys: DataFrame, how: str, longer: int) -> DataFrame:
    """The keys with the rest of the word: ``whole``, ``blotted`` at each place, or with each place ``cut``."""
    q = F.floor(F.col("size") / 2).cast("int")
    rest = F.when(F.col("side") == 0, F.substring("word", q + 1, F.length("word"))).otherwise(
        F.substring("word", F.lit(1), F.length("word") - q)
    )
    places = F.sequence(F.lit(1), F.col("size") - q + longer)

    def around(i: Column, filler: str) -> Column:
        return F.concat(F.substring("rest", F.lit(1), i - 1), F.lit(filler), F.substring("rest", i + 1, F.length("rest")))

    if how == "whole":
        made = F.array(F.xxhash64("k", "rest"))
    elif how == "blotted":
        made = F.transform(places, lambda i: F.xxhash64(F.col("k"), around(i, " ")))
    else:
        made = F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.col("k"), around(i, ""))))
    kept = [c for c in keys.columns if c != "k"]
    return keys.withColumn("rest", rest).select(F.explode(made).alias("k"), *kept)


def _met(chunks: DataFrame, grams: DataFrame, longer: int) -> DataFrame:
    """(a, a_n, b, b_n): verified pairs of words that meet at a key, ``b`` being ``longer``."""
    left = chunks.select("k", "side", "size", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = grams.select("k", F.col("word").alias("b"), F.col("n").alias("b_n"))
    q = F.floor(F.col("size") / 2).cast("int")
    first = (F.col("side") == 0) | (F.substring("a", F.lit(1), q) != F.substring("b", F.lit(1), q))
    once = F.lit(True) if longer else F.col("a") < F.col("b")
    return left.join(right.hint("merge"), "k").where(once & first & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, length: int = LENGTH, buckets: int = BUCKETS, pairs: int = PAIRS) -> DataFrame:
    """(a, a_n, b, b_n): each pair of near words of (word, n) once."""
    found = []
    for longer in (0, 1):
        chunks, grams = _keys(words, 0, length), _keys(words, longer, length)
        bucket = F.pmod("k", F.lit(buckets))
        counted = chunks.select("k", F.lit(1).alias("c"), F.lit(0).alias("g")).union(
            grams.select("k", F.lit(0).alias("c"), F.lit(1).alias("g"))
        )
        crowded = stored(
            counted.groupBy(bucket.alias("bucket"))
            .agg(F.sum("c").alias("c"), F.sum("g").alias("g"))
            .where(F.col("c") * F.col("g") > pairs)
            .select("bucket"),
            "crowded",
        )

        def apart(keys: DataFrame, how: str) -> DataFrame:
            return keys.join(F.broadcast(crowded), F.pmod("k", F.lit(buckets)) == F.col("bucket"), how)

        found.append(_met(apart(chunks, "left_anti"), apart(grams, "left_anti"), longer))
        fine_a = _refined(apart(chunks, "left_semi"), "whole" if longer else "blotted", 0)
        fine_b = _refined(apart(grams, "left_semi"), "cut" if longer else "blotted", longer)
        found.append(_met(fine_a, fine_b, longer))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form), following forms to a word that has none."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(now.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        now = step.select("word", "root")
        if step.where("next IS NOT NULL").isEmpty():
            return now


def variants(docs: DataFrame, length: int = LENGTH, times: int = TIMES, ratio: int = RATIO, drop_one_in: int | None = 97) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of the corpus."""
    return grouped(stored(vocabulary(docs, length, times, drop_one_in), "words"), length, ratio)


def grouped(words: DataFrame, length: int = LENGTH, ratio: int = RATIO, buckets: int = BUCKETS, pairs: int = PAIRS) -> DataFrame:
    """The same for a given table (word, n) of distinct words."""
    found = near_pairs(words, length, buckets, pairs)
    ways = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")),
                   F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("a_n").alias("other_n")))
    best = (
        found.select(F.inline(ways))
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    )
    enough = -F.col("best.less") >= ratio * F.col("n")
    known = stored(
        words.join(best.hint("merge"), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.other")).alias("form"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    led = roots(known.where("form IS NOT NULL"))
    return known.join(led.hint("merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))
