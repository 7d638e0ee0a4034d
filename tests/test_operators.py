import json
import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from touchline.operators import alerts, applogs, costs, dedup, profiles, reports, search
from touchline.operators.running import running_total

# --- profiles -----------------------------------------------------------------


def profile(spark, **fields):
    df = spark.createDataFrame([(json.dumps(fields),)], "value string")
    return profiles.normalize_profiles(df).first()


def test_profile_defaults(spark):
    row = profile(spark, user_id="7")
    assert (row.user_id, row.username, row.followers_count, row.verified) == ("7", None, 0, False)


def test_profile_spellings(spark):
    row = profile(
        spark, user_id="", id=9, username="", screen_name="s", bio="b", profile_image_url_https="u",
        followers_count="12", following_count=None, verified="false", is_blue_verified=0,
    )
    assert (row.user_id, row.username, row.description, row.profile_image_url) == ("9", "s", "b", "u")
    # Any non-empty text is a set flag.
    assert (row.followers_count, row.following_count, row.verified, row.is_blue_verified) == (12, 0, True, False)


def test_profile_without_id_is_dropped(spark):
    assert profile(spark, username="x") is None


@pytest.fixture(scope="module")
def lookup(spark):
    rows = [("1", "a", 1), ("1", "b", 2), ("2", "c", 1)]
    df = spark.createDataFrame(rows, "user_id string, username string, seq int").selectExpr(
        "user_id", "username", "'n' AS name", "1L AS followers_count", "2L AS following_count", "true AS verified",
        "'d' AS description", "'l' AS location", "false AS is_blue_verified", "seq",
    )
    return profiles.last_profile(df, "seq").drop("seq")


@pytest.fixture(scope="module")
def authored(spark):
    authors = ["1"] * 50 + ["2", "3", "", None, None]
    return spark.createDataFrame(list(enumerate(authors)), "i int, author_id string")


@pytest.mark.parametrize("options", [{}, {"spread_by": "i"}, {"spread_by": "i", "salt": 4}])
def test_lookup_keeps_every_post(authored, lookup, options):
    merged = profiles.merge_profiles(authored, lookup, **options)
    assert merged.count() == 55
    found = {r.i: (r.user_username, r.enriched) for r in merged.collect()}
    assert found[0] == ("b", True) and found[50] == ("c", True)
    assert all(found[i] == (None, None) for i in range(51, 55))
    assert "_key" not in merged.columns and "_salt" not in merged.columns


def test_author_coverage(authored, lookup):
    assert {r.author_id for r in profiles.distinct_authors(authored).collect()} == {"1", "2", "3"}
    assert {r.author_id for r in profiles.matched_authors(authored, lookup).collect()} == {"1", "2"}
    assert {r.author_id for r in profiles.unmatched_authors(authored, lookup).collect()} == {"3"}
    assert tuple(profiles.profile_stats(authored, lookup).first()) == (2, 1)
    assert reports.count_distinct_authors(authored).first().authors == 3
    assert reports.count_distinct_authors(authored, approximate=True).first().authors == 3


def test_usernames_in_first_seen_order(spark):
    rows = [(0, "z", "q"), (1, "", "b"), (2, "z", None), (3, None, "a"), (4, None, None)]
    df = spark.createDataFrame(rows, "i int, author_username string, username string")
    assert [r.username for r in profiles.distinct_usernames(df, "i").collect()] == ["z", "b", "a"]


# --- search ---------------------------------------------------------------------


def test_search_config_limits(caplog):
    assert search.SearchConfig(max_results=900).max_results == 900
    assert search.SearchConfig(max_results=900, ceiling=250).max_results == 250
    assert "capped" in caplog.text
    with pytest.raises(ValueError):
        search.SearchConfig(max_results=9)


def test_search_query_text():
    config = search.SearchConfig(keywords="PSG OR OM", lang="fr", min_retweets=5, start_time="2026-01-01T00:00:00Z")
    assert config.query == "(PSG OR OM) min_retweets:5 -is:retweet"
    params = config.request_params()
    assert params["query"].endswith("-is:retweet lang:fr") and params["max_results"] == 100
    assert params["start_time"] == "2026-01-01T00:00:00Z" and "end_time" not in params
    assert params["user.fields"].startswith("username")
    assert search.SearchConfig(query="abc").query == "abc"


@pytest.mark.parametrize("collected, size", [(0, 100), (200, 50), (245, 10), (250, 10)])
def test_page_size(collected, size):
    assert search.SearchConfig().page_size(collected) == size


def test_search_filter(spark):
    rows = [
        ("l'équipe du PSG gagne", "fr", 9, "2026-01-05"),
        ("RT @x PSG", "fr", 9, "2026-01-05"),
        ("PSGX", "fr", 9, "2026-01-05"),
        ("psg", "en", 9, "2026-01-05"),
        ("psg", "fr", 1, "2026-01-05"),
        ("psg", "fr", 9, "2026-01-09"),
        ("saint étienne!", "fr", 9, "2026-01-01"),
    ]
    df = spark.createDataFrame(rows, "text string, lang string, retweet_count long, created_at string")
    df = df.withColumn("created_at", F.col("created_at").cast("timestamp"))
    config = search.SearchConfig(
        keywords="PSG OR Saint Etienne", lang="fr", min_retweets=5, start_time="2026-01-01", end_time="2026-01-09"
    )
    assert [r.text for r in search.search_filter(df, config).collect()] == [rows[0][0], rows[6][0]]


POSTS = [
    (1, "Le PSG marque", "fr", 9), (2, "RT @x PSG", "fr", 9), (3, "OM et PSG", "fr", 1), (4, "psg om", "en", 9),
    (5, "saint étienne revient", "fr", 9), (6, "étienne, saint patron", "fr", 9), (7, None, "fr", 9),
]


M = search.mentions


@pytest.mark.parametrize(
    "where, ids",
    [
        (lambda: M("psg"), {1, 2, 3, 4}),
        (lambda: M("psg", "OM") & (F.col("retweet_count") >= 5) & ~search.is_retweet(), {1, 4}),
        (lambda: M("psg") & M("om"), {3, 4}),
        (lambda: M("psg") & ~M("om"), {1, 2}),
        (lambda: (M("om") & M("psg")) | M("saint etienne"), {3, 4, 5}),
        (lambda: ~M("psg", "om") & (F.col("lang") == "fr"), {5, 6}),
        (search.is_retweet, {2}),
        (lambda: M("psg") & (M("om") | M("marque")) & (F.col("lang") != "en"), {1, 3}),
        (lambda: "lang = 'fr' AND startswith(text, 'RT @')", {2}),
        (lambda: "text ILIKE '%psg%' AND retweet_count < 5", {3}),
    ],
)
def test_explicit_queries(spark, where, ids):
    df = spark.createDataFrame(POSTS, "id int, text string, lang string, retweet_count long")
    config = search.SearchConfig(query="as the service reads it", where=where())
    assert {r.id for r in search.search_filter(df, config).collect()} == ids


def test_explicit_query_without_filter_raises(spark):
    with pytest.raises(ValueError, match="where"):
        search.SearchConfig(query="from:me").predicate()
    df = spark.createDataFrame(POSTS, "id int, text string, lang string, retweet_count long")
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        search.search_filter(df, search.SearchConfig(query="x", where="lang ="))


def pages(spark, rows):
    return spark.createDataFrame(rows, "run_id string, page int, body string")


def body(ids, token=None):
    return json.dumps({"data": [{"id": str(i), "text": "t", "author_id": "a"} for i in ids],
                       "meta": {"next_token": token} if token else {}})


def test_pages_follow_tokens_and_stop(spark):
    rows = [
        ("two", 1, body([1], "x")), ("two", 2, body([2])), ("two", 3, body([3], "y")),
        ("endless", 1, body(range(100), "x")), ("endless", 2, body(range(100, 200), "x")),
        ("endless", 3, body(range(200, 300), "x")), ("endless", 4, body(range(300, 400), "x")),
        ("empty", 1, '{"meta":{"next_token":"x"}}'), ("empty", 2, body([1])),
        ("bad", 1, body([1], "x")), ("bad", 2, "{bad"), ("bad", 3, body([3], "x")),
        ("gap", 1, body([1], "x")), ("gap", 2, body([], "x")), ("gap", 3, body([3])),
        ("blank", 1, json.dumps({"data": [{"id": "1"}], "meta": {"next_token": ""}})), ("blank", 2, body([2])),
    ]
    found = {}
    for r in search.post_fields(search.read_response_pages(pages(spark, rows), cap=250)).orderBy("run_id", "rank").collect():
        found.setdefault(r.run_id, []).append((r.rank, r.tweet_id))
    assert found["two"] == [(1, "1"), (2, "2")]
    assert found["endless"] == [(i + 1, str(i)) for i in range(250)]
    assert found["bad"] == [(1, "1")] and found["gap"] == [(1, "1")] and found["blank"] == [(1, "1")]
    assert "empty" not in found
    every = search.post_fields(search.read_response_pages(pages(spark, rows))).collect()
    assert sorted(r["rank"] for r in every if r.run_id == "endless") == list(range(1, 401))
    short = lambda rs: sorted((r.run_id, r["rank"], r.tweet_id) for r in rs if r.run_id != "endless")
    assert short(every) == sorted((run, *x) for run, xs in found.items() if run != "endless" for x in xs)


def test_page_limit_reaches_below_the_shuffle(spark):
    plan = search.page_prefix(pages(spark, [("r", 1, body([1]))]), cap=250)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]
    assert plan.count("Exchange") == 1


def test_cap_results(spark):
    df = spark.range(100).selectExpr("id % 2 AS run", "id")
    kept = search.cap_results(df, "run", ["id"], 10)
    assert sorted(r.id for r in kept.collect()) == list(range(20))


# --- cost -------------------------------------------------------------------------


@pytest.mark.parametrize(
    "tweets, cost, left, reach, collections, status",
    [
        (0, 0, 25, 5000, 20, "OK"),
        (100, 0.5, 24.5, 4900, 19, "OK"),
        (3999, 19.995, 5.005, 1001, 4, "OK"),
        (4000, 20, 5, 1000, 4, "WARNING"),
        (5000, 25, 0, 0, 0, "EXCEEDED"),
        (9000, 45, 0, 0, 0, "EXCEEDED"),
    ],
)
def test_api_cost(spark, tweets, cost, left, reach, collections, status):
    df = spark.createDataFrame([(tweets,)], "tweets_fetched long")
    row = costs.with_api_cost(df).withColumn("status", costs.budget_status("api_cost")).first()
    assert float(row.api_cost) == cost and float(row.remaining_budget) == left
    assert (row.remaining_tweets, row.remaining_collections, row.status) == (reach, collections, status)


def test_running_total_equals_a_plain_sum(spark):
    rng = random.Random(3)
    start = datetime(2026, 1, 1)
    rows = [
        ("hot" if rng.random() < 0.5 else f"k{rng.randrange(4)}", start + timedelta(minutes=rng.randrange(3000)), i, rng.randrange(9))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp, i int, v long")
    found = {r.i: r.total for r in running_total(df, ["k"], "ts", ["i"], "v", "total").collect()}
    sums = {}
    for k, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        sums[k] = sums.get(k, 0) + v
        assert found[i] == sums[k]
    assert len(found) == 600


def test_running_total_cuts_one_time_stamp(spark):
    """All rows of a key at one time: they still spread over parts, and no window holds them all."""
    df = spark.range(20_000).selectExpr("'k' AS k", "TIMESTAMP '2026-01-01' AS ts", "id AS i", "1L AS v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        total = running_total(df, ["k"], "ts", ["i"], "v", "total")
        assert total.where("total <> i + 1").isEmpty() and total.count() == 20_000
        parts = total.groupBy(F.spark_partition_id()).count().count()
        assert parts > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# --- reports ------------------------------------------------------------------------


def test_duplicates_and_top(spark):
    df = spark.createDataFrame(
        [("a", 5, ["x"]), ("a", 5, []), ("b", 9, ["x", "y"]), ("c", 9, ["y"]), ("d", 99, [])],
        "tweet_id string, engagement long, themes array<string>",
    ).selectExpr("*", "array('h') AS hashtags", "current_timestamp() AS created_at")
    assert [tuple(r) for r in reports.duplicate_ids(df).collect()] == [("a", 2)]
    assert [r.tweet_id for r in reports.top_engaged(df).collect()] == ["b", "c", "a"]
    assert [tuple(r) for r in reports.theme_counts(df).collect()] == [("x", 2), ("y", 2)]
    assert reports.staging_total(df).first().total == 5


def test_histogram(spark):
    df = spark.createDataFrame([(0.005,), (0.2,), (11.0,)], "s double")
    rows = {r.le: r for r in reports.latency_histogram(df, "s").collect()}
    assert (rows["0.005"].n, rows["0.1"].n, rows["0.25"].n, rows["10"].n, rows["+Inf"].n) == (1, 1, 2, 2, 3)
    assert rows["+Inf"]["count"] == 3 and abs(rows["+Inf"]["sum"] - 11.205) < 1e-9
    assert len(rows) == 15


def test_summary_of_empty_and_failed_runs(spark):
    schema = "run_id string, author_id string, errors array<string>, enriched boolean, flatten_error string"
    rows = [("r", "a", [], True, None), ("r", "b", [], None, "no id"), ("r", "b", ["x"], None, "no id")]
    runs = spark.createDataFrame([("r", []), ("none", []), ("broken", ["API: 500"])], "run_id string, errors array<string>")
    found = {r.run_id: r for r in reports.run_summary(spark.createDataFrame(rows, schema), runs=runs).collect()}
    assert (found["r"].tweets_valid, found["r"].tweets_sent_to_kafka, found["r"].success) == (2, 1, True)
    assert (found["none"].tweets_fetched, found["none"].success, float(found["none"].api_cost_estimate)) == (0, True, 0)
    assert (found["broken"].success, found["broken"].errors) == (False, ["API: 500"])


def test_run_summary(spark):
    rows = [("r", "a", [], True)] * 3 + [("r", "b", ["x"], None), ("r", "", [], None), ("s", None, ["y"], None)]
    df = spark.createDataFrame(rows, "run_id string, author_id string, errors array<string>, enriched boolean")
    found = {r.run_id: r for r in reports.run_summary(df).collect()}
    r = found["r"]
    assert (r.tweets_fetched, r.users_enriched, r.tweets_enriched, r.author_ids_found) == (5, 1, 5, 2)
    assert (r.tweets_valid, r.tweets_invalid, r.tweets_sent_to_kafka, r.success) == (4, 1, 4, True)
    assert float(r.api_cost_estimate) == 0.03 and r.errors == []
    assert (found["s"].author_ids_found, found["s"].tweets_valid) == (0, 0)


# --- logs ---------------------------------------------------------------------------


def test_log_lines(spark):
    lines = [
        "2026-04-03 07:05:09 [ERROR] shop.orders: no stock left",
        "2026-08-12 15:13:52 [INFO] a.b: x: [y] z",
        "    in handler, called twice",
        "2026-08-12 15:13:52 [INFO] a b: x",
        "2026-08-12 15:13:52 [INFO] a:  \n",
        "   \n", "", "  \x1c",
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    rows = {r.i: r for r in applogs.parse_app_logs(applogs.drop_blank_lines(df)).collect()}
    assert set(rows) == {0, 1, 2, 3, 4}
    r = rows[0]
    assert (r.type, r.ts, r.level, r.logger, r.message) == (
        "APP_LOG", "2026-04-03 07:05:09", "ERROR", "shop.orders", "no stock left"
    )
    assert r.event_time == datetime(2026, 4, 3, 7, 5, 9)
    assert (rows[1].level, rows[1].logger, rows[1].message) == ("INFO", "a.b", "x: [y] z")
    for i in (2, 3):
        assert (rows[i].level, rows[i].logger, rows[i].message) == ("UNPARSED", "unknown", lines[i])
        assert rows[i].event_time is not None
    assert (rows[4].logger, rows[4].message) == ("a", " ")
    event = applogs.to_log_event(applogs.parse_app_logs(df.where("i = 0"))).first()
    assert json.loads(event.value)["level"] == "ERROR" and bytes(event.headers[0].value) == b"app_log"


# --- dedup and retention --------------------------------------------------------------


def test_rows_without_a_key_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 2)], "tweet_id string, processed_at int")
    assert sorted(dedup.latest_by_key(df).collect(), key=str) == sorted([(None, 1), (None, 2), ("a", 2)], key=str)


def test_latest_by_key(spark):
    rows = [("hot", i % 7, i) for i in range(500)] + [("a", 1, 1), ("a", 1, 2)]
    df = spark.createDataFrame(rows, "tweet_id string, processed_at int, i int")
    latest = dedup.latest_by_key(df, order=("processed_at", "i"))
    assert sorted(tuple(r) for r in latest.collect()) == [("a", 1, 2), ("hot", 6, 496)]
    again = dedup.latest_by_key(latest, order=("processed_at", "i"))
    assert again.exceptAll(latest).isEmpty()
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_retention(spark):
    days = spark.range(30).selectExpr("timestamp_seconds(id * 86400) AS timestamp", "id")
    assert dedup.apply_retention(days, "tweets_raw").count() == 8
    assert dedup.apply_retention(days, "audit_logs").count() == 15
    fixed = dedup.apply_retention(days, "tweets_raw", now=F.timestamp_seconds(F.lit(10 * 86400)))
    assert fixed.agg(F.min("id")).first()[0] == 3


def test_expired_partitions_are_dropped(spark):
    spark.sql("CREATE TABLE old_posts (id INT, year STRING, month STRING, day STRING) USING parquet PARTITIONED BY (year, month, day)")
    spark.sql("INSERT INTO old_posts VALUES (1,'2026','01','01'), (2,'2026','01','05'), (3,'2026','01','12')")
    dropped = dedup.drop_expired_partitions(spark, "old_posts", "tweets_raw", date(2026, 1, 12))
    assert dropped == ["year=2026/month=01/day=01"]
    assert sorted(r.id for r in spark.table("old_posts").collect()) == [2, 3]


# --- alerts ---------------------------------------------------------------------------


def brute_states(samples, rules, max_gap):
    """State per rule, series and sample by walking each series."""
    out = {}
    for rule in rules:
        series = {}
        for ts, metric, labels, value in samples:
            if metric == rule.metric:
                key = "" if rule.sum_series else ",".join(f"{k}={v}" for k, v in sorted(labels.items()))
                series.setdefault(key, {}).setdefault(ts, 0.0)
                series[key][ts] += value
        for key, points in series.items():
            since = last = None
            for ts in sorted(points):
                value = points[ts]
                bad = {"==": value == rule.threshold, "!=": value != rule.threshold,
                       ">": value > rule.threshold, "<": value < rule.threshold}[rule.compare]
                if last is not None and (ts - last).total_seconds() > max_gap:
                    since = None
                since = (since or ts) if bad else None
                state = "inactive" if not bad else (
                    "firing" if (ts - since).total_seconds() >= rule.for_seconds else "pending")
                out[(rule.name, key, ts)] = state
                last = ts
    return out


def test_alert_states_equal_a_walk_over_each_series(spark):
    rng = random.Random(11)
    start = datetime(2026, 1, 1)
    samples = []
    rules = [replace(r, enabled=True) for r in alerts.RULES]
    for rule in rules:
        for broker in ("1", "2"):
            ts, bad = start, False
            while ts < start + timedelta(hours=4):
                if rng.random() < 0.01:
                    bad = not bad
                value = {"up": 0.0 if bad else 1.0, "kafka_broker_under_replicated_partitions": 2.0 if bad else 0.0,
                         "kafka_controller_active_count": 0.0 if bad else 0.5,
                         "kafka_consumergroup_lag": 2000.0 if bad else 0.0,
                         "kafka_broker_messages_in_per_sec": 0.0 if bad else 5.0}[rule.metric]
                labels = {"job": f"kafka-broker-{broker}", "topic": "tweets_raw"}
                samples.append((ts, rule.metric, labels, value))
                ts += timedelta(seconds=15 if rng.random() < 0.99 else 45)
    df = spark.createDataFrame(samples, "ts timestamp, metric string, labels map<string,string>, value double")
    found = {(r.alertname, r.series, r.ts): r.state for r in alerts.alert_states(df, rules).collect()}
    expected = brute_states(samples, rules, 30)
    assert found == expected
    assert {"inactive", "pending", "firing"} == set(found.values())


def test_disabled_and_unmatched_rules(spark):
    rows = [(datetime(2026, 1, 1), "up", {"job": "other"}, 0.0), (datetime(2026, 1, 1), "kafka_consumergroup_lag", {"topic": "tweets_raw"}, 5000.0)]
    df = spark.createDataFrame(rows, "ts timestamp, metric string, labels map<string,string>, value double")
    assert alerts.alert_states(df).count() == 0


def test_an_alert_that_fires_again_is_told_again(spark):
    start = datetime(2026, 1, 1, 23)
    states = {0: "firing", 10: "inactive", 20: "firing", 90: "firing", 100: "pending", 200: "firing"}
    rows = [("a", "warning", "s", start + timedelta(minutes=m), 1.0, x) for m, x in states.items()]
    rows.append(("a", "warning", "t", start + timedelta(minutes=100), 1.0, "firing"))  # another series keeps it up
    df = spark.createDataFrame(rows, "alertname string, severity string, series string, ts timestamp, value double, state string")
    found = sorted((r.notified_at, r.repeat, r.samples) for r in alerts.group_alerts(df).collect())
    at = lambda m: start + timedelta(minutes=m)
    assert found == [(at(0), 0, 1), (at(20), 0, 1), (at(90), 1, 2), (at(200), 3, 1)]
    daily = sorted((r.notified_at, r.repeat, r.samples) for r in alerts.group_alerts(df, chunk_seconds=60).collect())
    assert daily == found


def test_notifications_repeat_hourly(spark):
    start = datetime(2026, 1, 1)
    rows = [("a", "critical", "s", start + timedelta(minutes=m), 1.0, "firing") for m in (0, 10, 59, 60, 130)]
    rows.append(("b", "warning", "s", start, 1.0, "pending"))
    df = spark.createDataFrame(rows, "alertname string, severity string, series string, ts timestamp, value double, state string")
    found = alerts.group_alerts(df).orderBy("repeat").collect()
    assert [(r.repeat, r.samples, r.receiver) for r in found] == [
        (0, 3, "slack-critical"), (1, 1, "slack-critical"), (2, 1, "slack-critical")
    ]
