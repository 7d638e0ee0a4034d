"""Alignment of two tokenizers, against plain loops."""

import numpy as np
import pytest

from tests.llm import brute
from touchline.llm import alignment
from touchline.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizers():
    """Both vocabularies through their own libraries, as lists of (id, bytes)."""
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers

    a = Tokenizer.from_file(Q.byte_file())
    a.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=Q.model_file())
    # Every byte's stand-in, from the library itself.
    stands = {}
    for c in map(chr, range(0x800)):
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
        stands.update(zip(shown, c.encode(), strict=True))
    lead = [chr(x) for x in (0x800, 0x1000, 0xFFFD, 0x10000, 0x50000, 0x10FFFF)]
    for c in lead + [chr(x << 12) for x in range(1, 13)] + [chr(x << 18) for x in range(1, 5)]:
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
        stands.update(zip(shown, c.encode(), strict=True))

    def a_tokens(text):
        e = a.encode(" " + text, add_special_tokens=False)
        return [(i, bytes(stands[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]

    def b_tokens(text):
        out = []
        for i in pieces.encode(text):
            p = pieces.id_to_piece(i)
            out.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
        return out

    return a_tokens, b_tokens


CASES = [
    (1, "plain words, and a second sentence."),
    (2, "  leading and trailing  "),
    (3, "日本語 \U0001f600 émigré ñandú <s> <|endoftext|> </s> <0x41>"),
    (4, "a▁b"),
    (5, "\u0000\t\r\n\n  x"),
    (6, " "),
    (7, ""),
    (8, None),
    (None, "plain words, and a second sentence."),
    (1, "plain words, and a second sentence."),
    (10, "foo\n  bar \t baz\u00a0 qux\x1c x  y \u3000z 's ' s it's\n\n end \n"),
    (11, " \n \n"),
    (12, "tail   "),
    (9, "antidisestablishmentarianism pneumonoultramicroscopic " * 30),
]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 7, 1, 0])
def test_against_loops(spark, tokenizers, frequent):
    """Also where few pairs, one, or none have their counts broadcast."""
    docs = spark.createDataFrame(CASES, "doc_id long, text string").selectExpr("*", "1 AS pairs", "2 AS n", "'x' AS row")
    found = alignment.alignments(docs.repartition(3), Q.byte_file(), Q.model_file(), frequent=frequent)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute.alignments(CASES, *tokenizers)))


def test_texts_that_do_not_come_back_have_no_tokens(spark, tokenizers):
    rows = {r[0]: r for r in brute.alignments(CASES, *tokenizers)}
    assert rows[4][1:] == (0, 0, 0, 0, 0, 0, "") and rows[5][1] > 0


def test_given_documents(spark, tokenizers):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    short = [d for d in docs if d[1] is not None and len(d[1]) < 1500]
    frame = spark.createDataFrame(short, "doc_id long, text string")
    found = alignment.alignments(frame, Q.byte_file(), Q.model_file(), frequent=200)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, brute.alignments(short, *tokenizers)))
    assert Q.op12_alignment(spark, SF_DIR).count() == len(docs)


def test_awkward_documents(spark, folder, tokenizers):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in Q.op12_alignment(spark, folder).collect()}
    for i, t in docs:
        if i is not None and t:
            assert (found[i].n_a, found[i].n_b) == tuple(len(f(t)) for f in tokenizers)
    assert found[2].groups_sha256 == "" and found[1].n_a == 0


def test_successors_reach_the_end_of_a_long_chain():
    """Tokens that overlap like bricks share no cut before the last."""
    n = 10_000
    a, b = np.append(np.arange(2, 2 * n, 2), 2 * n), np.append(np.arange(1, 2 * n, 2), 2 * n)
    a_last, b_last = alignment.terminals(a, b)
    assert set(a_last) == set(b_last) == {len(a) - 1}


def test_digits():
    ids = np.array([0, 7, 10, 999, 50256, 100000])
    raw, ends = alignment._decimal(ids, np.full(6, ord(",")))
    assert raw == b"0,7,10,999,50256,100000," and ends.tolist() == [2, 4, 7, 11, 17, 24]


@pytest.mark.parametrize("limit", [0, 3, 1 << 19])
def test_stretches_give_what_whole_texts_give(monkeypatch, limit):
    """Cut at spaces or not, remembered or forgotten."""
    monkeypatch.setattr(alignment, "_STRETCHES", limit)
    texts = [t or "" for _, t in CASES]
    kinds = alignment.ByteTokens(Q.byte_file()), alignment.PieceTokens(Q.model_file())
    assert all(k.cuts_at_spaces for k in kinds)
    cut, whole = alignment.Aligner(*kinds), alignment.Aligner(*kinds)
    whole._cut = False
    for _ in range(2):
        x, y = cut.align(texts), whole.align(texts)
        for name in ("counts", "digests", "pairs", "times", "bounds"):
            assert np.array_equal(getattr(x, name), getattr(y, name)), name
