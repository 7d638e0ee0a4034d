"""Models, codecs and index structures by themselves."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from touchline.llm import arrays, embedding_join, langid, licenses, ngram_join, pieces, pii, quality, secret_scan, urls
from touchline.llm.queries import model_file
from touchline.llm.shared import components

SF_DIR = "/root/testdata/sf0.01"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 é.\n日", max_size=30)), max_size=12))
def test_words_of_a_batch(texts):
    from tests.llm.brute import ALNUM, lower

    found = []
    for chunk in arrays.chunks(pa.array(texts, pa.string()), 16):
        data = chunk.lowered()
        words = arrays.words(data, chunk.bounds, arrays.ALNUM)
        spelled = [bytes(data[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)]
        found += [spelled[a:b] for a, b in zip(words.bounds, words.bounds[1:], strict=False)]
        assert len(set(arrays.hashes(data, words).tolist())) == len(set(spelled))
    assert found == [ALNUM.findall(lower(t)) for t in texts]


def test_sliding_minimum():
    x = np.array([5, 3, 8, 1, 9, 2, 7])
    for size in range(1, 8):
        assert arrays.sliding(np.minimum, x, size).tolist() == [min(x[i : i + size]) for i in range(len(x) - size + 1)]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 400), st.integers(0, 80), st.floats(0, 1), st.integers(0, 10_000))
def test_similar_sets_share_a_signature(n, changed, frequent_share, seed):
    """Whatever other tokens are called frequent, sets that link have a signature in common."""
    rule, draw = ngram_join.Threshold(80, 100), np.random.default_rng(seed)
    one = np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64))
    two = np.unique(np.concatenate([one[min(changed, len(one)) :], draw.integers(0, 1 << 63, changed // 2, dtype=np.uint64)]))
    both = len(np.intersect1d(one, two))
    if not both or 100 * both < 80 * (len(one) + len(two) - both) or np.array_equal(one, two):
        return
    shared = np.intersect1d(one, two)
    frequent = lambda x: np.isin(x, shared) | (arrays.mix(x) % np.uint64(1000) < frequent_share * 1000)
    often = lambda x: arrays.mix(x) % np.uint64(3) == 0
    a, b = (ngram_join.signatures(x, frequent(x), often(x), rule) for x in (one, two))
    assert np.intersect1d(a, b).size


def test_overlaps_of_rare_and_common_tokens():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 60, 40).astype(np.uint64)) for _ in range(80)]
    found = ngram_join.overlaps(sets)
    assert all(found[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(80) for j in range(80) if i != j)


def test_one_text_of_a_repeated_id_stays(spark):
    """Near copies under one id leave one text; two groups with the same smallest id leave one each."""
    words = lambda stem: " ".join(f"{stem}{i}" for i in range(80))
    rows = [(5, words("a")), (5, words("a") + " end"), (6, words("a") + " fin"), (5, words("b")), (7, words("b") + " end"), (9, words("c"))]
    kept = [tuple(r) for r in ngram_join.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted((i, t[:2]) for i, t in kept) == [(5, "a0"), (5, "b0"), (9, "c0")]


def test_low_thresholds_are_refused():
    with pytest.raises(ValueError):
        ngram_join.Threshold(65, 100)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 60)] + [(3, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[i] == 100 for i in range(100, 141)) and all(found[i] == 7 for i in range(7, 60))


def test_components_of_hubs(spark, monkeypatch):
    """Hubs that are handled apart, hubs among hubs, and a long chain hanging from one."""
    from touchline.llm import shared

    edges = [(5000, i) for i in range(1, 1500)] + [(6000, i) for i in range(1400, 2500)] + [(i, i + 1) for i in range(7000, 7040)] + [(6000, 7040), (9000, 9001)]
    for heavy in (1000, 3, 1 << 30):
        monkeypatch.setattr(shared, "HEAVY", heavy)
        found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert found.pop(9000) == found.pop(9001) == 9000
        assert set(found.values()) == {1} and len(found) == 2499 + 2 + 41


def test_rare_language_is_learnt_beside_a_frequent_one(spark):
    """The bound holds per language: five documents of one are all used beside two thousand of another."""
    rows = [(i, f"the house and the tree number {i}", "en") for i in range(2000)]
    rows += [(10_000 + 3 * i, "la maison et les arbres du village", "fr") for i in range(15)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"), max_docs=60)
    assert model.languages == ["en", "fr"]
    docs = spark.createDataFrame([(1, "les arbres et la maison"), (2, "the tree and the house")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predicted(docs, model).orderBy("doc_id").collect()] == ["fr", "en"]


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.scored(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([a > b for a in good for b in bad]) > 0.97
    assert np.mean([s >= 0.7 for s in good]) > 0.97


def test_nothing_is_rejected_without_labels(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(8)] + [(None, None)], "doc_id long, text string")
    held = docs.where(quality.held_out(docs["doc_id"])).select("doc_id", F.lit(1).alias("quality"))
    unusable = docs.select("doc_id", F.lit(None).cast("int").alias("quality"))
    assert held.count()
    for labels in (held.where("false"), held, unusable):
        assert quality.accepted(docs, labels).count() == 9
        assert {r.score for r in quality.scored(docs, labels).collect()} == {0.5}


def test_quality_pairs_matter():
    draw = np.random.default_rng(0)
    x = draw.uniform(size=(4000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert np.mean((quality.fit(x, y, n_pairs=0).score(x) > 0.5) == y) < 0.7
    assert np.mean((quality.fit(x, y, n_pairs=1).score(x) > 0.5) == y) > 0.95


def test_language_held_out_and_spans(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.learn(docs)
    rows = langid.predicted(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = rows.where(langid.held_out(rows["doc_id"])).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    parts = [docs.where(f"lang = '{x}' AND n_chars > 2000").orderBy("doc_id").first().text[:1000] for x in ("fr", "en")]
    mixed = spark.createDataFrame([(1, " ".join(parts))], "doc_id long, text string")
    spans = langid.predicted(mixed, model, spans=True).first().spans
    assert [s.lang for s in spans] == ["fr", "en"] and abs(spans[1].start - 1000) < 60


def test_viterbi_against_all_paths():
    draw = np.random.default_rng(3)
    sizes = [0, 1, 5, 3, 6]
    scores = draw.normal(size=(sum(sizes), 3)).astype(np.float32)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    found = langid.viterbi(scores, bounds, 0.7)
    worth = lambda s, p: sum(s[i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:], strict=False))
    for a, b in zip(bounds, bounds[1:], strict=False):
        paths = np.stack(np.meshgrid(*[range(3)] * (b - a), indexing="ij"), -1).reshape(-1, b - a) if b > a else []
        if len(paths):
            best = max(worth(scores[a:b], p) for p in paths.tolist())
            assert abs(worth(scores[a:b], found[a:b].tolist()) - best) < 1e-4


def test_long_licence_with_changes(spark):
    text = licenses.NOTICES[0].text.split()
    kept = "Foo. " + " ".join([*text[:9], "really", *text[9:]]) + " Bar"
    lost = " ".join(text[:3] + ["not"] + text[4:])
    rows = spark.createDataFrame([(1, kept.upper()), (2, lost), (3, " ".join(reversed(text)))], "doc_id long, text string")
    found = {r.doc_id: [p.label for p in r.places] for r in licenses.scanned(rows).collect()}
    assert found == {1: ["mit"], 2: [], 3: []}


def test_pieces_against_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=model_file())
    ours = pieces.Encoder(pieces.Model.load(open(model_file(), "rb").read()))
    draw = random.Random(5)
    texts = ["".join(draw.choice(" ▁abcthein.\n日é😀́") for _ in range(draw.randint(0, 150))) for _ in range(400)]
    for text in [*texts, "a" * 3000, " " * 300 + "x", "\0"]:
        ids, starts, ends = ours.encode(text)
        found = library.encode(text, return_type="proto")
        assert ids.tolist() == [p.id for p in found.pieces]
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [(p.begin, p.end) for p in found.pieces]
        assert ours.model.decode(ids) == library.decode(ids.tolist())
    assert ours.model.decode([library.piece_to_id("<0xC3>")]) == library.decode([library.piece_to_id("<0xC3>")])


def test_compiled_character_map_against_the_library():
    library = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    rules = dict(pieces._fields(dict(pieces._fields(library.serialized_model_proto()))[3]))
    ours = pieces.Model([], [], [], pieces.CharacterMap(rules[2]), True, True, True, False)
    draw = random.Random(6)
    for _ in range(400):
        text = "".join(draw.choice("  abＡｂﬁ①½が゙か가é\t​㍿Ⅳ…　") for _ in range(draw.randint(0, 25)))
        made, places = ours.normalise(text)
        expected, characters = library.normalize(text, with_offsets=True)
        assert made == expected
        if made:
            assert places.tolist() == [len(text[:c].encode()) for c in characters]


def test_encoded_and_redacted_texts(spark):
    docs = spark.createDataFrame(
        [(1, "Ask joe@x.example.com now"), (2, None), (3, "no")], "doc_id long, text string"
    ).selectExpr("*", "length(text) AS n_chars", "1 AS found")
    rows = {r.doc_id: r for r in pii.redacted(docs).collect()}
    assert rows[1].text == "Ask [EMAIL] now" and rows[1].n_chars == 15 and rows[2].text is None and rows[3].found == 1
    out = {r.doc_id: r for r in pieces.encoded(docs, model_file()).collect()}
    assert out[1].decoded == "Ask joe@x.example.com now" and out[1].ends[-1] == 25 and out[2].ids == []


def test_wide_candidates_are_learnt():
    x = np.array([[0, 0], [0, 1], [1, 0], [1, 1]])
    trees = pii.boosted(x, np.array([0.0, 0, 0, 90]), np.array([50.0, 50, 50, 1]))
    scores = pii._scores(x, trees)
    assert scores[3] > 1 and max(scores[:3]) < -1


def test_written_out_addresses_and_phones_without_plus_are_added(spark):
    """They look like exact ones and are added; numbers with nothing for them or something against them are not."""
    known = [f"+1 (234) 567-{1000 + i} and ann{i % 7}@site.example.com" for i in range(40)]
    against = [f"invoice {70_000_000 + i}; x{8_000_000 + i}f" for i in range(40)]
    asked = ["ask joe [at] site [dot] example [dot] org ok", "ring 1 (234) 567-8901 ok", "ring (345) 678-9012 ok"]
    plain = ["in 71234567 of them", "invoice 1 (234) 567-8901", "x (at) y"]
    texts = [*known, *against, *asked, *plain]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in pii.detected(docs).collect()}
    first = len(known) + len(against)
    assert [spans[first + i] for i in range(3)] == [
        [("handle", "joe [at] site [dot] example [dot] org")], [("number", "1 (234) 567-8901")], [("number", "345) 678-9012")]
    ]
    assert all([k for k, _ in spans[i]] == ["email", "phone"] for i in range(len(known)))
    assert all(spans[i] == [] for i in range(len(texts)) if len(known) <= i < first or i >= first + len(asked))
    out = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert [out[first + i] for i in range(3)] == ["ask [HANDLE] ok", "ring [NUMBER] ok", "ring ([NUMBER] ok"]
    assert out[first - 1] == texts[first - 1] and out[0] == "[PHONE] and [EMAIL]"


def test_trigram_queries():
    q = lambda r: [set(x) for x in secret_scan.trigram_query(r)]
    assert q("abcd") == [{"abc", "bcd"}]
    assert q("(?:abc|xyz)[0-9]+") == [{"abc"}, {"xyz"}]
    assert q("ab[cd]e") == [{"abc", "bce"}, {"abd", "bde"}]
    assert q("(?:abc)?[0-9]{3}") == [set()] and q("[a-z]+") == [set()] and q("abc|x") == [set()]
    assert q("(?:KEY)+=") == [{"key"}]


def test_secret_rules_beyond_the_base(spark):
    rows = spark.createDataFrame(
        [(1, "ghp_" + "z" * 36), (2, "-----BEGIN RSA PRIVATE KEY-----"), (3, "xoxb-1234567890"), (4, "AIza" + "z" * 35)],
        "doc_id long, text string",
    )
    found = {r.doc_id: [s.kind for s in r.spans] for r in secret_scan.scanned(rows).collect()}
    assert found == {1: ["github"], 2: ["private_key"], 3: ["slack"], 4: ["google"]}


def test_rules_are_filed_under_their_rarest_token():
    rule = urls.SiteRule("block", "example.org", "/en/1")
    assert rule.tokens == ("example", "org", "en")


def test_cover_tree_finds_all_pairs():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(12, 16))
    raw = (centres[draw.integers(0, 12, 500)] + draw.normal(size=(500, 16)) * 0.25).astype(np.float64)
    x = raw / np.linalg.norm(raw, axis=1)[:, None]
    tree = embedding_join.cover_tree(x, np.arange(500), 0)
    assert tree.children
    found = {(a, b) for i, j in embedding_join.linked_pairs(x, raw, tree, tree, 0.93) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
    cosine = x @ x.T
    assert found == {(a, b) for a, b in zip(*np.nonzero(cosine >= 0.93), strict=True) if a != b}


def test_many_cells_and_blocks_give_the_same_pairs(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").withColumnRenamed("label", "old").selectExpr(
        "*", "old % 2 AS label"
    )
    one = embedding_join.near_duplicates(vectors, least=0.25, block=4096)
    many = embedding_join.near_duplicates(vectors, least=0.25, block=16)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0 and one.where("n_links > 0").count()


def test_forms_that_fail_their_check_are_not_added(spark):
    """Bare runs of 16 digits without a right check digit, alone, in pairs and after cue words; right ones stay exact."""
    right = [f"pay 4111 1111 1111 {1111 if i else 1111} or +1 (234) 567-{1000 + i}" for i in range(40)]
    wrong = [f"and {9807915762804000 + i} ok" for i in range(0, 900, 7)]
    wrong = [t for t in wrong if not brute._luhn(t.split()[1])]
    asked = ["card 9807915762804490 ok", "9807915762804490 7086638319846192", "tel 1.2.3.400", "tel 020 7946 0018", "call +12 345"]
    texts = [*right, *wrong, *asked]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in pii.detected(docs).collect()}
    first = len(right)
    assert all(spans[i] == [] for i in range(first, first + len(wrong)))
    added = [spans[first + len(wrong) + i] for i in range(len(asked))]
    assert added[0] == added[1] == added[2] == added[4] == []
    assert added[3] in ([], [("number", "020 7946 0018")])
    assert all([k for k, _ in spans[i]] == ["card", "phone"] for i in range(first))


def test_thresholds_come_from_unseen_folds():
    """Trees that only know their own examples by heart find no threshold on others."""
    scores, yes, no = np.array([2.0, 2.0, -1.0]), np.array([30.0, 0.0, 0.0]), np.array([0.0, 20.0, 40.0])
    assert pii.calibrated(scores, yes, no, 0.95, 20) is None
    assert pii.calibrated(np.array([2.0, 1.0, -1.0]), yes, no, 0.95, 20) == 2.0
    # Too few examples at the top decide nothing.
    assert pii.calibrated(np.array([3.0, 2.0]), np.array([5.0, 40.0]), np.array([1.0, 0.0]), 0.95, 20) == 2.0


def test_many_matches_in_one_text(spark):
    """Tens of thousands of places in one text take seconds, and redaction leaves the rest of the text as it is."""
    import time

    n = 20_000
    text = "".join(f"é{i % 10} a{i}@b.example.com " for i in range(n))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    out = pii.redacted(docs).first().text
    assert out == "".join(f"é{i % 10} [EMAIL] " for i in range(n))
    row = secret_scan.scanned(spark.createDataFrame([(1, "token=abcdefgh " * n)], "doc_id long, text string")).first()
    assert len([s for s in row.spans if s.kind == "assign"]) == n
    assert time.time() - began < 120


def test_vectors_of_extreme_lengths(spark):
    """Components whose squares are beyond doubles, or below them, link like any others, also across pivots."""
    rows = [
        (1, [1e200, 1e200], 1), (2, [2e200, 2e200], 1), (3, [1e-200, 0.0], 1), (4, [2e-200, 0.0], 1), (5, [3.0, 3.0], 1),
        (6, [5e-324, 0.0], 1), (7, [1.7e308, -1.7e308], 1), (8, [1e300, 1.0], 1),
    ]
    expected = {1: (2, 1), 2: (2, 1), 5: (2, 1), 3: (3, 3), 4: (3, 3), 6: (3, 3), 8: (3, 3), 7: (0, 7)}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for block in (embedding_join.BLOCK, 2):
        found = embedding_join.near_duplicates(frame, 0.93, block=block).collect()
        assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected


def test_sketches_bound_the_difference_of_sets():
    """Links of sets are never lost by their sketches, unlike sets are told apart, and sizes of sketches may differ."""
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 1 << 64, n, dtype=np.uint64)) for n in (5, 33, 60, 64, 300, 300, 20_000)]
    sets += [np.unique(np.concatenate([x[: len(x) - len(x) // 12], draw.integers(0, 1 << 64, len(x) // 14, dtype=np.uint64)])) for x in sets]
    table = pa.table(
        {
            "h": pa.array(range(len(sets)), pa.int64()),
            "n": pa.array([len(x) for x in sets], pa.int64()),
            "sketch": pa.array([ngram_join.sketch(x) for x in sets], pa.binary()),
        }
    )
    found = {(r["a"], r["b"]) for r in ngram_join._alike(85, 100)(table).to_pylist()}
    assert found == {(i + 7, i) for i in range(7)}


def test_unlike_texts_of_a_group_are_not_compared_whole(spark, monkeypatch):
    """Texts chained together by a frequent passage make one group of signatures, of which only near copies are read again."""
    passage = "of the to and in is it as by"
    rows = [(i, f"{passage} " + " ".join(f"w{i}x{j}" for j in range(12))) for i in range(40)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(3)] + [(200 + i, rows[20][1]) for i in range(30)]
    made, keep = {}, ngram_join.stored

    def noted(df, name):
        made[name] = keep(df, name)
        return made[name]

    monkeypatch.setattr(ngram_join, "stored", noted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs, k=1, num=85, den=100).collect()}
    assert found == {i: i for i in range(40)} | {100 + i: i for i in range(3)} | {200 + i: 20 for i in range(30)}
    assert made["members"].count() == 6
    signed = made["signatures"].where("size(tokens) > 0")
    assert signed.where("doc_id >= 200").count() == 0  # copies of a text are not signed again
