import json

import pytest
from pyspark.sql import functions as F

from touchline.functions.hashtags import detect_club, extract_hashtags, partition_key
from touchline.functions.variants import with_post
from touchline.operators import flatten, validation as val

POST = {
    "id": "700100",
    "text": "Match revu avec la VAR #Ligue1 #OM",
    "created_at": "2026-02-11T20:45:00Z",
    "lang": "fr",
    "author_id": "a5501",
    "public_metrics": {"like_count": 8, "retweet_count": 3, "reply_count": 1, "quote_count": 0},
    "entities": {"hashtags": [{"tag": "Ligue1"}, {"tag": "OM"}, {"tag": "VAR"}]},
}


def changed(**fields):
    return {**POST, **fields}


def without(*names):
    return {k: v for k, v in POST.items() if k not in names}


def metrics(**fields):
    return changed(public_metrics={**POST["public_metrics"], **fields})


CASES = [
    (POST, []),
    (
        {"id": "9", "text": "Un but"},
        [
            "Champ manquant : created_at",
            "Champ manquant : lang",
            "Champ manquant : author_id",
            "Champ manquant : public_metrics",
            "Champ manquant : public_metrics.like_count",
            "Champ manquant : public_metrics.retweet_count",
        ],
    ),
    (changed(text=None), []),
    (changed(lang="en"), ["Langue non autorisée : en (attendu : ['fr'])"]),
    (changed(lang=None), ["Langue non autorisée : None (attendu : ['fr'])"]),
    (changed(lang=True), ["Langue non autorisée : True (attendu : ['fr'])"]),
    (changed(lang=7), ["Langue non autorisée : 7 (attendu : ['fr'])"]),
    (metrics(like_count=-1), ["like_count ne peut pas être négatif"]),
    (metrics(retweet_count=-0.5), ["retweet_count ne peut pas être négatif"]),
    (metrics(like_count=True), []),
    (metrics(like_count=None), ["like_count doit être un entier"]),
    (metrics(like_count="5"), ["like_count doit être un entier"]),
    (changed(public_metrics=None), ["public_metrics doit être un objet"]),
    (changed(public_metrics=3), ["public_metrics doit être un objet"]),
    (
        changed(public_metrics=[]),
        ["Champ manquant : public_metrics.like_count", "Champ manquant : public_metrics.retweet_count"],
    ),
    (changed(public_metrics={"retweet_count": 1}), ["Champ manquant : public_metrics.like_count"]),
    (changed(entities=None), ["entities doit être un objet"]),
    (changed(entities=[]), ["entities doit être un objet"]),
    (changed(entities={}), []),
    (without("entities"), []),
    (changed(entities={"hashtags": "x"}), ["hashtags doit être une liste"]),
    (changed(entities={"hashtags": None}), ["hashtags doit être une liste"]),
    (changed(entities={"hashtags": []}), []),
    (changed(id=5), ["id doit être une chaîne de caractères"]),
    (changed(id=None), ["id doit être une chaîne de caractères"]),
    (
        changed(lang="en", id=5),
        ["Langue non autorisée : en (attendu : ['fr'])", "id doit être une chaîne de caractères"],
    ),
]


def frame(spark, posts):
    rows = [(i, p if isinstance(p, str) else json.dumps(p, ensure_ascii=False)) for i, p in enumerate(posts)]
    return spark.createDataFrame(rows, "i int, value string")


def test_reasons_and_their_order(spark):
    checked = val.validate_tweets(frame(spark, [p for p, _ in CASES]))
    found = {r.i: r.errors for r in checked.collect()}
    for i, (post, expected) in enumerate(CASES):
        assert found[i] == expected, post


def test_parsed_posts_give_the_same_reasons(spark):
    df = frame(spark, [p for p, _ in CASES])
    checked = val.validate_tweets(with_post(df), "post")
    assert [r.errors for r in checked.orderBy("i").collect()] == [e for _, e in CASES]


def test_other_languages_can_be_allowed(spark):
    checked = val.validate_tweets(frame(spark, [changed(lang="en"), changed(lang="de")]), allowed_langs=("fr", "en"))
    errors = [r.errors for r in checked.orderBy("i").collect()]
    assert errors == [[], ["Langue non autorisée : de (attendu : ['fr', 'en'])"]]


FLAT = {
    "tweet_id": "1", "text": "t", "created_at": "2026-01-01", "lang": "fr", "author_id": "a",
    "like_count": 1, "retweet_count": 0, "hashtags": [],
}


@pytest.mark.parametrize(
    "post, expected",
    [
        (FLAT, []),
        ({}, [f"Champ manquant : {f}" for f in FLAT if f not in ()]),
        ({**FLAT, "quote_count": -2}, ["quote_count ne peut pas être négatif"]),
        ({**FLAT, "hashtags": "x"}, ["hashtags doit être une liste"]),
        ({**FLAT, "tweet_id": 1}, ["tweet_id doit être une chaîne de caractères"]),
    ],
)
def test_flat_profile(spark, post, expected):
    checked = val.validate_tweets(frame(spark, [post]), profile="flat")
    assert sorted(checked.first().errors) == sorted(expected)


UNREADABLE = ["{not json", "", "[1]", "3", "null", '"text"']


def test_unreadable_bodies_are_split_off(spark):
    df = frame(spark, [POST, "{}", *UNREADABLE])
    readable, unreadable = val.split_unreadable(df)
    assert {r.i for r in readable.collect()} == {0, 1}
    assert {r.value for r in unreadable.collect()} == set(UNREADABLE)


def test_valid_and_rejected_make_the_whole(spark):
    checked = val.validate_tweets(frame(spark, [p for p, _ in CASES]))
    valid, rejected = val.split_valid(checked)
    assert valid.count() + rejected.count() == len(CASES)
    assert rejected.where(F.size("errors") == 0).count() == 0


def test_a_filter_on_reasons_does_not_parse_again(spark):
    valid, _ = val.split_valid(val.validate_tweets(frame(spark, [POST])))
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_audit_event(spark):
    _, rejected = val.split_valid(val.validate_tweets(frame(spark, [changed(lang="en", text="é\"}")])))
    row = val.to_audit_event(rejected).first()
    event = json.loads(row.value)
    assert bytes(row.key) == b"validation_error"
    assert [(h.key, bytes(h.value)) for h in row.headers] == [("audit_type", b"validation_error")]
    assert event["type"] == "VALIDATION_ERROR" and event["source"] == "tweets_raw_producer"
    assert event["errors"] == ["Langue non autorisée : en (attendu : ['fr'])"]
    assert event["raw_tweet"] == changed(lang="en", text="é\"}")


def test_routing_by_header(spark):
    letters = val.to_dead_letter(frame(spark, ["{bad"]), "tweets_raw")
    events = val.to_audit_event(val.validate_tweets(frame(spark, [changed(lang="en")])))
    bare = frame(spark, ["x"]).select(F.lit(None).cast("binary").alias("key"), "value")
    routed = val.route_audit(val.audit_union(letters, events, bare))
    assert sorted(r.category for r in routed.collect()) == ["dead_letter", "unknown", "validation_error"]


# --- flattening, keys and clubs ------------------------------------------------


def flat(spark, post):
    row = flatten.flatten_tweets(frame(spark, [post])).first()
    return row.flatten_error, json.loads(row.flat) if row.flat else None


def test_flatten(spark):
    error, message = flat(spark, POST)
    assert error is None
    assert message.pop("raw_payload") == POST
    assert message == {
        "tweet_id": POST["id"], "text": POST["text"], "created_at": POST["created_at"],
        "author_id": POST["author_id"], "lang": "fr", "like_count": 8, "retweet_count": 3,
        "hashtags": ["Ligue1", "OM", "VAR"],
    }


def test_flatten_defaults_fill_absent_keys_only(spark):
    _, message = flat(spark, {"id": "1"})
    message.pop("raw_payload")
    assert message == {
        "tweet_id": "1", "text": "", "created_at": "", "author_id": "", "lang": "unknown",
        "like_count": 0, "retweet_count": 0, "hashtags": [],
    }
    _, message = flat(spark, {"id": 7, "text": None, "lang": None, "public_metrics": {"like_count": 1.5}})
    assert message["tweet_id"] == 7 and message["text"] is None and message["lang"] is None
    assert message["like_count"] == 1.5 and message["retweet_count"] == 0


def test_payload_bytes_survive(spark):
    body = '{ "id":"1",  "n": 12345678901234567890123456789012345678901234567890, "z":1, "a":2}'
    row = flatten.flatten_tweets(frame(spark, [body])).first()
    assert body in row.flat


@pytest.mark.parametrize("body", ["[]", "3", "{bad", '{"text":"x"}', '{"id":""}', '{"id":0}', '{"id":null}', '{"id":false}', '{"id":0.0}', '{"id":[]}'])
def test_flatten_errors(spark, body):
    error, message = flat(spark, body)
    assert error and message is None


def test_decode_flat(spark):
    df = spark.createDataFrame([(b'{"a":1}',), (b"\xff\xfe",), (b"{bad",)], "value binary")
    decoded = flatten.decode_flat(df).select(F.to_json("post")).collect()
    assert [r[0] for r in decoded] == ['{"a":1}', None, None]


@pytest.mark.parametrize(
    "post, tags",
    [
        (POST, ["Ligue1", "OM", "VAR"]),
        ({"entities": {"hashtags": [{"tag": ""}, 3, {"x": 1}, {"tag": "OM"}]}}, ["OM"]),
        ({"hashtags": ["Ligue1", "OM"]}, ["Ligue1", "OM"]),
        ({"entities": {"hashtags": []}, "hashtags": ["OM"]}, ["OM"]),
        ({"entities": None, "hashtags": ["OM"]}, ["OM"]),
        ({}, []),
    ],
)
def test_extract_hashtags(spark, post, tags):
    df = with_post(frame(spark, [post]))
    assert df.select(extract_hashtags("post")).first()[0] == tags


@pytest.mark.parametrize(
    "tags, club",
    [
        (["Ligue1", "PSG"], "PSG"),
        (["Ligue1", "OM"], "OM"),
        (["ligue1", "ogcnice"], "OGCNICE"),
        (["##OL"], "OL"),
        (["football", "VAR"], "Ligue1"),
        ([], "Ligue1"),
        (None, "Ligue1"),
        (["PSG", "OM", "Ligue1"], "PSG"),
    ],
)
def test_detect_club(spark, tags, club):
    df = spark.createDataFrame([(tags,)], "hashtags array<string>")
    assert df.select(detect_club("hashtags")).first()[0] == club


@pytest.mark.parametrize("author, key", [("99", b"99"), ("", b"unknown"), (None, b"unknown")])
def test_partition_key(spark, author, key):
    df = spark.createDataFrame([(author,)], "author_id string")
    assert bytes(df.select(partition_key("author_id")).first()[0]) == key
