"""As-of joins against a plain search in each key's versions."""

import random

import pytest

from touchline.operators import asof

LEFT = "key string, t int, id int, note string"
RIGHT = "key string, since int, seq int, what string"


def expected(left, right, tie=True):
    out = []
    for row in left:
        best = None
        for key, since, seq, what in right:
            if row[0] is None or key != row[0] or since is None or row[1] is None or since > row[1]:
                continue
            if best is None or (since, seq) > best[:2]:
                best = (since, seq, what)
        out.append((*row, None if best is None else best[2]))
    return sorted(map(repr, out))


def found(spark, left, right, **options):
    left, right = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    met = asof.as_of(left, right, ["key"], "t", "since", ["what"], order=["id"], tie=["seq"], **options)
    assert met.columns == [*left.columns, "as_of"]
    return sorted(repr((r.key, r.t, r.id, r.note, r.as_of.what if r.as_of else None)) for r in met.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_random_sequences(spark, seed):
    draw = random.Random(seed)
    key = lambda: draw.choice(["hot"] * 4 + ["a", "b", "c", None])
    left = [(key(), draw.choice([None, *range(40)]), i, "n") for i in range(400)]
    right = [(key(), draw.choice([None, *range(2, 38)]), i, f"v{i}") for i in range(60)]
    assert found(spark, left, right) == expected(left, right)


def test_busy_key_at_one_time_is_cut(spark):
    """All rows of the hot key share a time stamp, so only their order can divide them; the version comes before them all."""
    left = [("hot", 5, i, "n") for i in range(5000)]
    right = [("hot", 5, 1, "same time"), ("hot", 4, 0, "before"), ("hot", 6, 2, "after")]
    frame, versions = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)
    met = asof.as_of(frame, versions, ["key"], "t", "since", ["what"], order=["id"], tie=["seq"])
    assert met.select("as_of.what").distinct().collect() == [("same time",)] and met.count() == 5000


def test_version_is_carried_over_parts_without_one(spark):
    left = [("k", t, t, "n") for t in range(3000)]
    assert found(spark, left, [("k", 10, 1, "early")]) == expected(left, [("k", 10, 1, "early")])


def test_empty_sides(spark):
    left = [("k", 1, 1, "n"), (None, None, 2, "n")]
    assert found(spark, left, []) == expected(left, [])
    assert found(spark, [], [("k", 1, 1, "v")]) == []


def test_profile_of_the_time_of_the_post(spark):
    tweets = spark.createDataFrame(
        [("1", "u1", 5), ("2", "u1", 15), ("3", "", 15), ("4", "u2", 15), ("5", None, 15)], "tweet_id string, author_id string, created_at int"
    )
    versions = spark.createDataFrame(
        [(u, n, v, "x", 1, 2, True, "d", "l", False) for u, n, v in [("u1", "old", 0), ("u1", "new", 10), ("u2", "late", 16), ("", "nobody", 0)]],
        "user_id string, username string, valid_from int, name string, followers_count long, following_count long, verified boolean, description string, location string, is_blue_verified boolean",
    )
    met = {r.tweet_id: (r.user_username, r.enriched) for r in asof.merge_profiles_as_of(tweets, versions).collect()}
    assert met == {"1": ("old", True), "2": ("new", True), "3": (None, None), "4": (None, None), "5": (None, None)}
