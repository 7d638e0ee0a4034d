"""Every query on awkward tables and on empty ones, against plain loops."""

import random

import duckdb
import pytest

import corpus_pipeline
from tests.compare import canonical, compare, connect
from tests.llm import brute
from touchline.llm import licenses
from touchline.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"


def texts(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def same(found, expected):
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_empty_tables(spark, nothing, name):
    assert Q.queries()[name](spark, nothing).count() == 0


def test_pipeline_of_nothing(spark, nothing):
    assert corpus_pipeline.run(spark, nothing).count() == 0


def test_quality(spark, folder):
    rows = Q.op1_quality(spark, folder).collect()
    assert len(rows) == len(texts(spark, folder))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out is not None for r in rows)
    one = {r.score for r in rows if r.doc_id == 7}
    assert len(one) == 1


def test_langid(spark, folder):
    rows = Q.op2_langid(spark, folder).collect()
    by_text = {(r.doc_id): (r.lang_pred, r.score) for r in rows}
    assert len(rows) == len(texts(spark, folder))
    for i in (1, 2, 3, 15):
        assert by_text[i] == ("und", 0.0)
    assert by_text[7][0] in ("en", "fr") and 0 < by_text[7][1] <= 1


def test_licenses(spark, folder):
    found = {tuple(r[:6]) for r in Q.op3_licenses(spark, folder).collect()}
    assert found == {(i, *brute.licences(t)) for i, t in texts(spark, folder)}


@pytest.mark.parametrize("where", ["awkward", "given"])
def test_licence_labels(spark, folder, where):
    """Labels and score of the method against a plain search for agreeing starts."""
    where = folder if where == "awkward" else SF_DIR
    found = [(r.doc_id, r.labels, r.score) for r in Q.op3_licenses(spark, where).collect()]
    same(found, list(brute.licence_labels(texts(spark, where), licenses.PHRASES, licenses.NOTICES)))


def test_damaged_notices(spark):
    """Words changed, put in and left out of every notice, many of them in a row, and a repetitive text."""
    draw, rows = random.Random(8), []
    for n, t in enumerate(licenses.NOTICES * 6):
        words = t.text.split()
        for _ in range(n % 5):
            at = draw.randrange(len(words))
            words[at : at + draw.choice([0, 1, 1])] = draw.choice([[], ["new"], ["put", "in"]])
        rows.append((n, " ".join(["before"] * (n % 7) + words + ["after"])))
    rows.append((998, " ".join(t.text for t in licenses.NOTICES * 3)))
    rows.append((999, "license may at not of this file " * 200))
    rows.append((1000, None))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [
        (r.doc_id, ",".join(sorted({p.label for p in r.places})), max((p.share for p in r.places), default=0.0))
        for r in licenses.scanned(docs.repartition(3)).collect()
    ]
    same(found, list(brute.licence_labels(rows, licenses.PHRASES, licenses.NOTICES)))
    assert sum(bool(labels) for _, labels, _ in found) > 30


def test_ngram_join(spark, folder):
    found = [tuple(r) for r in Q.op4_ngram_join(spark, folder).collect()]
    same(found, brute.near_duplicates(texts(spark, folder), 4, 85, 100))


@pytest.mark.parametrize("where", ["awkward", "sf0.001"])
def test_urls(spark, folder, where):
    if where == "awkward":
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT page_id, url FROM '{folder}/pages.parquet/*.parquet'")
        df = Q.op5_urls(spark, folder)
        relation = con.sql(Q.oracle_sql()["op5_urls"])
        found = canonical(df.columns, [tuple(r) for r in df.collect()])
        assert found == canonical(relation.columns, relation.fetchall())
    else:
        compare(spark, connect(SF_DIR), "op5_urls", Q.op5_urls, Q.oracle_sql()["op5_urls"], SF_DIR)


def test_embeddings(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same([tuple(r) for r in Q.op6_embeddings(spark, folder).collect()], brute.embeddings(rows, 0.93))


def test_given_embeddings(spark):
    """The query on the smallest given table."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same([tuple(r) for r in Q.op6_embeddings(spark, SF_DIR).collect()], brute.embeddings(rows, 0.93))


def test_pii(spark, folder):
    found = [tuple(r)[:6] for r in Q.op7_pii(spark, folder).collect()]
    same(found, [(i, *brute.spans(t, brute.PERSONAL)) for i, t in texts(spark, folder)])


def test_pieces(spark, folder):
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=Q.model_file())
    hexed = lambda t: hashlib.sha256(t.encode()).hexdigest()
    expected = []
    for i, t in texts(spark, folder):
        ids = library.encode(t or "")
        expected.append((i, len(ids), hexed(",".join(map(str, ids))), hexed(library.decode(ids)), len((t or "").encode())))
    same([tuple(r) for r in Q.op8_pieces(spark, folder).collect()], expected)


def test_secrets(spark, folder):
    found = [tuple(r)[:5] for r in Q.op9_secrets(spark, folder).collect()]
    same(found, [(i, *brute.spans(t, brute.SECRET, by_start=True)) for i, t in texts(spark, folder)])


def test_decontamination(spark, folder):
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    found = [tuple(r) for r in Q.op10_decontamination(spark, folder).collect()]
    same(found, list(brute.contamination(texts(spark, folder), items)))


def test_given_documents(spark):
    """The text queries on the smallest given tables."""
    docs = texts(spark, SF_DIR)
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    same([tuple(r) for r in Q.op10_decontamination(spark, SF_DIR).collect()], list(brute.contamination(docs, items)))
    same([tuple(r) for r in Q.op4_ngram_join(spark, SF_DIR).collect()], brute.near_duplicates(docs, 4, 85, 100))
    same([tuple(r)[:6] for r in Q.op7_pii(spark, SF_DIR).collect()], [(i, *brute.spans(t, brute.PERSONAL)) for i, t in docs])
    same(
        [tuple(r)[:5] for r in Q.op9_secrets(spark, SF_DIR).collect()],
        [(i, *brute.spans(t, brute.SECRET, by_start=True)) for i, t in docs],
    )


def test_pipeline_on_awkward_documents(spark, folder):
    """Each stage against the plain meaning of its operator, on what the one before it kept."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        after = [tuple(r) for r in kept.select("doc_id", "text").collect()]
        if name == "n-gram Jaccard join":
            groups = brute.near_duplicates(before, 5, 80, 100)
            same(after, [b for b, g in zip(before, groups, strict=True) if g[0] == g[2]])
        elif name == "benchmark decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            hit = brute.contamination(before, items)
            same(after, [b for b, h in zip(before, hit, strict=True) if not h[-1]])
        elif name == "PII":
            assert len(after) == len(before)
            assert all(brute.spans(t, brute.PERSONAL)[:4] == (0, 0, 0, 0) for _, t in after)
        docs = kept
