"""Spelling variants, against all pairs of words."""

import random

import pytest

from tests.compare import compare, connect
from tests.llm import brute
from touchline.llm import queries as Q
from touchline.llm import spelling

SF_DIR = "/root/testdata/sf0.001"


def same(found, expected):
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def columns(df):
    return df.select("word", "n", "n_near", "form", "form_n", "root")


def test_matches_sql(spark):
    compare(spark, connect(SF_DIR), "op13_spelling", Q.op13_spelling, Q.oracle_sql()["op13_spelling"], SF_DIR)


def test_awkward_documents(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    same(columns(Q.op13_spelling(spark, folder)), brute.spelling_groups(brute.spelling_words(docs)))


def test_letters_and_lost_code_points(spark):
    """Runs end at anything but the named letters; A-Z alone are lowered; ids and runs decide what is lost."""
    texts = ["Straße ÉCOLE École écoles naïveté ×÷wörter abcde-fghij ABCDE ĀBCDEF xabcdeŁ", None, ""]
    docs = [(i, t) for i, t in enumerate(texts * 2)] + [(i, "flowering flowerings flowring Flowering") for i in range(300)]
    docs.append((None, "flowering"))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS word", "2 AS n", "3 AS h", "4 AS run")
    words = brute.spelling_words(docs)
    found = spelling.vocabulary(frame, times=1)
    everything = {(r.word, r.n) for r in found.collect()}
    assert any(brute.edited(w, "flowering") and len(w) < 9 for w, _ in everything if w != "flowring")
    assert {(w, n) for w, n in everything if n >= 3} == set(words.items())
    same(columns(spelling.variants(frame)), brute.spelling_groups(words))


@pytest.mark.parametrize("pairs", [spelling.PAIRS, 20, 0])
@pytest.mark.parametrize("buckets", [spelling.BUCKETS, 3])
def test_crowded_keys_give_the_same_pairs(spark, pairs, buckets):
    """Few letters, so that all chunks are common: by chunks alone, by refined keys alone, and by both."""
    draw = random.Random(5)
    words = {"".join(draw.choices("abé", k=draw.randint(5, 8))): draw.choice([3, 5, 6, 12, 24, 100]) for _ in range(400)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    same(columns(spelling.grouped(frame, buckets=buckets, pairs=pairs)), brute.spelling_groups(words))


def test_long_chain_of_forms(spark):
    """Each word's form is the next one; roots are found in a few doublings."""
    letters = "abcdefghijklmnopqrst"
    words = {letters[:i] + "z" * (20 - i): 3 * 2**i for i in range(20)}
    found = spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long"))
    same(columns(found), brute.spelling_groups(words))
    assert {r.root for r in found.collect()} == {letters[:19] + "z"}


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.grouped(empty).count() == 0


def test_only_crowded_counters_are_broadcast(spark, tmp_path):
    """Exploded keys of a small vocabulary are larger than Spark takes them for, and never go through the driver."""
    spark.createDataFrame([("flowering", 9), ("flowring", 3)], "word string, n long").write.parquet(f"{tmp_path}/words")
    plan = spelling.near_pairs(spark.read.parquet(f"{tmp_path}/words"))._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert sum("SortMergeJoin [k" in line and "Inner" in line for line in joins) == 4
    assert all("bucket" in line for line in joins if "Broadcast" in line)
