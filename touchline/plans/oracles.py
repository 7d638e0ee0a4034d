"""Plain SQL over the given tables for the registered queries (DuckDB dialect)."""

from __future__ import annotations

import re

from touchline.operators.alerts import RULES
from touchline.vocabulary import CLUB_HASHTAGS, LATENCY_BUCKETS, THEME_KEYWORDS

# --- shared relations --------------------------------------------------------

_POSTS = r"""
posts AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS tweet_id, source, lang,
    concat(text, CASE doc_id % 11 WHEN 0 THEN ' Décision VAR' WHEN 1 THEN ' les stats xG'
      WHEN 2 THEN ' analyse vidéo' WHEN 3 THEN ' il varie'
      WHEN 4 THEN ' ralenti puis penalty' ELSE '' END) AS text,
    CASE WHEN doc_id % 29 = 0 THEN '' ELSE concat('2024-01-',
      lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0'), 'T',
      lpad(CAST(doc_id % 24 AS VARCHAR), 2, '0'), ':00:00Z') END AS created_text,
    CASE WHEN doc_id % 29 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 28 AS INTEGER))
      + to_hours(CAST(doc_id % 24 AS INTEGER)) END AS created,
    CASE WHEN doc_id % 43 = 5 THEN '' WHEN doc_id % 3 = 0 THEN 'u0'
      ELSE concat('u', doc_id % 97) END AS author_id,
    CASE WHEN doc_id % 31 = 0 THEN NULL ELSE n_chars % 500 END AS like_count,
    n_chars % 37 AS retweet_count,
    string_split(CASE doc_id % 6 WHEN 0 THEN 'Ligue1,PSG' WHEN 1 THEN 'om' WHEN 2 THEN 'variete'
      WHEN 3 THEN 'Hors-Jeu,LOSC' WHEN 4 THEN 'football' ELSE 'AnalyseVideo' END, ',') AS hashtags
  FROM documents
)"""


def _fold(text: str) -> str:
    return text.replace("é", "e").lower()


def _sql(text: str) -> str:
    return text.replace("'", "''")


def _whole_words(text: str, words: list[str]) -> str:
    body = "|".join(_sql(_fold(w)) for w in words)
    return rf"regexp_matches({text}, '(^|[^\p{{L}}\p{{N}}_])({body})($|[^\p{{L}}\p{{N}}_])')"


def _in_tags(tags: str, words: list[str]) -> str:
    body = "|".join(_sql(re.sub(r"[\s-]", "", _fold(w))) for w in words)
    return f"regexp_matches({tags}, '{body}')"


_NORM = "lower(strip_accents(text))"
_TAGS = "replace(lower(strip_accents(array_to_string(hashtags, chr(10)))), '-', '')"


def _themes() -> str:
    parts = [
        f"CASE WHEN {_whole_words(_NORM, words)} OR {_in_tags(_TAGS, words)} THEN '{theme}' END"
        for theme, words in THEME_KEYWORDS.items()
    ]
    return f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"


_TAGGED = f"tagged AS (SELECT *, {_themes()} AS themes FROM posts)"

# What the strict parse makes of the flat messages: quoted likes become null.
_STAGING = """
staging AS (
  SELECT tweet_id, author_id, lang, text, hashtags,
    CASE WHEN doc_id % 14 = 3 THEN NULL ELSE like_count END AS like_count, retweet_count,
    CASE WHEN doc_id % 14 = 3 THEN 0 ELSE coalesce(like_count, 0) END + retweet_count AS engagement,
    themes, created
  FROM tagged WHERE doc_id % 41 <> 0
)"""
_STAGED = f"WITH {_POSTS}, {_TAGGED}, {_STAGING}"


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


_STAGING_VIEW = f"""{_STAGED}
SELECT tweet_id, author_id, lang, md5(text) AS text_md5, array_to_string(hashtags, ',') AS hashtags,
  like_count, retweet_count, engagement, array_to_string(themes, ',') AS themes,
  {_stamp('created')} AS created_at FROM staging"""

_SILVER_TIME = "strftime(created, '%Y-%m-%dT%H:%M:%S.000Z')"

# Nested posts: which keys are there, and the reasons that follow.
_LIKE_ABSENT = "(doc_id % 47 <> 0 AND doc_id % 53 <> 0 AND doc_id % 17 <> 0 AND doc_id % 41 <> 0 AND doc_id % 31 = 0)"
_LIKE_NULL = "(doc_id % 47 <> 0 AND doc_id % 53 <> 0 AND doc_id % 17 <> 0 AND doc_id % 41 = 0)"
_LIKE_NEGATIVE = "(doc_id % 47 <> 0 AND doc_id % 53 <> 0 AND doc_id % 17 = 0)"
_METRICS_ABSENT = "(doc_id % 47 <> 0 AND doc_id % 53 = 0)"


# Such an id passes validation, and the post cannot be flattened.
_EMPTY_ID = "(doc_id % 61 = 0 AND doc_id % 19 <> 0)"
_RAW_ID = f"CASE WHEN {_EMPTY_ID} THEN '' ELSE tweet_id END"


def _errors(rules: list[tuple[str, str]]) -> str:
    cases = [f"CASE WHEN {test} THEN {text} END" for test, text in rules]
    return f"list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL)"


_NESTED_ERRORS = _errors(
    [
        ("doc_id % 43 = 0", "'Champ manquant : created_at'"),
        ("doc_id % 13 = 0", "'Champ manquant : author_id'"),
        (_METRICS_ABSENT, "'Champ manquant : public_metrics'"),
        ("doc_id % 47 = 0", "'public_metrics doit être un objet'"),
        (f"{_METRICS_ABSENT} OR {_LIKE_ABSENT}", "'Champ manquant : public_metrics.like_count'"),
        (_METRICS_ABSENT, "'Champ manquant : public_metrics.retweet_count'"),
        ("lang <> 'fr'", "concat('Langue non autorisée : ', lang, ' (attendu : [''fr''])')"),
        (_LIKE_NULL, "'like_count doit être un entier'"),
        (_LIKE_NEGATIVE, "'like_count ne peut pas être négatif'"),
        ("doc_id % 29 <> 0 AND doc_id % 23 = 0", "'hashtags doit être une liste'"),
        ("doc_id % 19 = 0", "'id doit être une chaîne de caractères'"),
    ]
)
_FLAT_ERRORS = _errors(
    [
        ("doc_id % 43 = 0", "'Champ manquant : created_at'"),
        ("doc_id % 13 = 0", "'Champ manquant : author_id'"),
        ("doc_id % 31 = 0", "'Champ manquant : like_count'"),
        ("lang <> 'fr'", "concat('Langue non autorisée : ', lang, ' (attendu : [''fr''])')"),
        ("doc_id % 17 = 0", "'reply_count ne peut pas être négatif'"),
        ("doc_id % 7 = 0", "'quote_count ne peut pas être négatif'"),
        ("doc_id % 23 = 0", "'hashtags doit être une liste'"),
        ("doc_id % 19 = 0", "'tweet_id doit être une chaîne de caractères'"),
    ]
)
# A nested hashtag list wins, a flat one is read where there is none.
_NESTED_TAGS = "CASE WHEN doc_id % 29 <> 0 AND doc_id % 23 = 0 THEN CAST([] AS VARCHAR[]) ELSE hashtags END"
_CHECKED = f"checked AS (SELECT *, {_NESTED_ERRORS} AS errors FROM posts WHERE doc_id % 59 <> 0)"
_VALIDATED = f"WITH {_POSTS}, {_CHECKED}"

_CLUBS = "MAP {" + ", ".join(f"'{tag}': '{club}'" for tag, club in CLUB_HASHTAGS.items()) + "}"


def _club(tags: str) -> str:
    found = f"list_transform({tags}, lambda t: {_CLUBS}[ltrim(lower(t), '#')])"
    return f"coalesce(list_filter({found}, lambda c: c IS NOT NULL)[1], 'Ligue1')"


_PROFILE_ROWS = """
versions AS (
  SELECT *, unnest(range(0, 1 + CAST(c_custkey % 2 AS BIGINT))) AS version FROM customer
),
profile_rows AS (
  SELECT CAST(version AS INTEGER) AS version, concat('u', c_custkey * 2) AS user_id, c_name AS username,
    c_mktsegment AS name,
    CASE WHEN c_custkey % 10 = 7 THEN 0 ELSE CAST(floor(c_acctbal) AS BIGINT) + version END AS followers_count,
    CAST(CASE WHEN c_custkey % 3 = 0 THEN c_nationkey ELSE 0 END AS BIGINT) AS following_count,
    c_custkey % 5 IN (0, 2) AS verified,
    CASE WHEN c_custkey % 4 = 3 THEN 'supporter' ELSE 'fan' END AS description,
    CAST(NULL AS VARCHAR) AS profile_image_url, CAST(c_nationkey AS VARCHAR) AS location,
    CAST(NULL AS VARCHAR) AS created_at, false AS is_blue_verified
  FROM versions WHERE c_custkey % 50 <> 49
)"""
_LAST_PROFILE = """
last_profile AS (
  SELECT * FROM profile_rows QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY version DESC) = 1
)"""
_PROFILES = f"{_PROFILE_ROWS}, {_LAST_PROFILE}"

_SUMMARY = f"""
WITH {_POSTS}, {_CHECKED}, {_PROFILES},
merged AS (
  SELECT c.source AS run_id, CASE WHEN doc_id % 13 = 0 OR c.author_id = '' THEN NULL ELSE c.author_id END AS author,
    len(c.errors) = 0 AS ok, len(c.errors) = 0 AND NOT {_EMPTY_ID} AS sent, p.user_id
  FROM checked c LEFT JOIN last_profile p
    ON p.user_id = CASE WHEN doc_id % 13 = 0 OR c.author_id = '' THEN NULL ELSE c.author_id END
),
summary AS (
  SELECT run_id, true AS success, count(*) AS tweets_fetched, count(DISTINCT user_id) AS users_enriched,
    count(*) AS tweets_enriched, count(*) FILTER (WHERE ok) AS tweets_valid, count(*) FILTER (WHERE NOT ok) AS tweets_invalid,
    count(*) FILTER (WHERE sent) AS tweets_sent_to_kafka, count(DISTINCT author) AS author_ids_found,
    CAST(round(CAST(count(*) AS DECIMAL(18,3)) * 0.005, 2) AS DOUBLE) AS api_cost_estimate,
    CAST(round(greatest(0, 25 - CAST(count(*) AS DECIMAL(18,3)) * 0.005), 2) AS DOUBLE) AS remaining_budget
  FROM merged GROUP BY run_id
)"""

_LINES = """
lines AS (
  SELECT *, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END AS lvl,
    concat('user ', user_id, ' value ', CAST(value AS DECIMAL(12,2)), ': done') AS body,
    event_id % 20 = 1 AS trace
  FROM events
),
logged AS (
  SELECT event_id, CASE WHEN trace THEN concat('    at line ', event_id)
      ELSE concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), ' [', lvl, '] ', event_type, '.handler: ', body) END AS line,
    'APP_LOG' AS type, CASE WHEN NOT trace THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts,
    CASE WHEN trace THEN 'UNPARSED' ELSE lvl END AS level,
    CASE WHEN trace THEN 'unknown' ELSE concat(event_type, '.handler') END AS logger,
    CASE WHEN trace THEN concat('    at line ', event_id) ELSE body END AS message
  FROM lines WHERE event_id % 50 <> 0
)"""

_PAGES = """
pages_in AS (
  SELECT source AS run_id, doc_id AS page, string_split(text, chr(10)) AS texts,
    doc_id % 71 <> 70 AND doc_id % 67 <> 66 AS has_data, doc_id % 71 <> 70 AND doc_id % 50 <> 49 AS has_token
  FROM documents
),
pages_run AS (
  SELECT *, CASE WHEN has_data THEN len(texts) ELSE 0 END AS n_items,
    coalesce(bool_and(has_data AND has_token) OVER earlier, true) AS reached,
    CAST(coalesce(sum(CASE WHEN has_data THEN len(texts) ELSE 0 END) OVER earlier, 0) AS BIGINT) AS n_before
  FROM pages_in
  WINDOW earlier AS (PARTITION BY run_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
pages_all AS (SELECT * FROM pages_run WHERE reached AND has_data),
pages_kept AS (SELECT * FROM pages_all WHERE n_before < 250)"""

# Many runs, and a long one that no page ends early.
_MANY_PAGES = """
many_in AS (
  SELECT CASE WHEN doc_id % 3 = 0 THEN 'long' ELSE concat(source, '-', doc_id // 50) END AS run_id, doc_id AS page,
    string_split(text, chr(10)) AS texts, doc_id % 3 = 0 OR (doc_id % 71 <> 70 AND doc_id % 67 <> 66) AS has_data,
    doc_id % 3 = 0 OR (doc_id % 71 <> 70 AND doc_id % 50 <> 49) AS has_token
  FROM documents
),
many_run AS (
  SELECT *, coalesce(bool_and(has_data AND has_token) OVER earlier, true) AS reached,
    CAST(coalesce(sum(CASE WHEN has_data THEN len(texts) ELSE 0 END) OVER earlier, 0) AS BIGINT) AS n_before
  FROM many_in
  WINDOW earlier AS (PARTITION BY run_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
many_posts AS (SELECT run_id, page, n_before, unnest(texts) AS text, unnest(range(0, len(texts))) AS i
  FROM many_run WHERE reached AND has_data)"""

_RUNS = """
runs AS (
  SELECT o_orderkey AS run_id, CASE WHEN o_custkey % 3 = 0 THEN 'a0' ELSE concat('a', o_custkey % 101) END AS account,
    CASE WHEN o_custkey % 3 = 0 THEN DATE '1995-01-01' ELSE o_orderdate END AS run_started, CAST(floor(o_totalprice) AS BIGINT) % 251 AS tweets_fetched
  FROM orders
)"""
_COSTED = """
costed AS (
  SELECT *, tweets_fetched * 5 AS mills, greatest(0, 1000 - tweets_fetched * 5) AS left_mills FROM runs
)"""

_COPIES = """
copies AS (
  SELECT CASE WHEN doc_id % 3 = 1 THEN 'hot' ELSE tweet_id END AS tweet_id, doc_id, retweet_count + copy AS retweet_count,
    TIMESTAMP '2024-02-01' + to_hours(CAST(copy AS INTEGER)) AS processed
  FROM (SELECT *, unnest(range(0, 1 + doc_id % 3)) AS copy FROM posts)
)"""

_SAMPLES = """
scraped AS (
  SELECT TIMESTAMP '2024-01-01' + to_seconds(CAST((event_id * 3 // 15) * 15 AS BIGINT)) AS ts,
    CASE event_type WHEN 'error' THEN 'up' WHEN 'view' THEN 'kafka_broker_under_replicated_partitions'
      WHEN 'click' THEN 'kafka_controller_active_count' WHEN 'purchase' THEN 'kafka_broker_messages_in_per_sec'
      ELSE 'kafka_consumergroup_lag' END AS metric,
    CASE WHEN user_id % 3 = 2 THEN 0 ELSE user_id % 3 END AS instance, max(value) AS v
  FROM events GROUP BY ALL
),
samples AS (
  SELECT ts, metric, concat('job=kafka-broker-', instance, ',topic=tweets_raw') AS series,
    CASE metric WHEN 'up' THEN CASE WHEN v > 5 THEN 0 ELSE 1 END
      WHEN 'kafka_broker_under_replicated_partitions' THEN floor(v / 5)
      WHEN 'kafka_controller_active_count' THEN CASE WHEN v > 20 THEN 0 ELSE 1 END
      WHEN 'kafka_broker_messages_in_per_sec' THEN CASE WHEN v > 3 THEN 0.5 ELSE 2 END
      ELSE v * 200 END AS value
  FROM scraped
)"""


def _rule_rows() -> str:
    parts = []
    for rule in RULES:
        compare = {"==": "=", "!=": "<>"}.get(rule.compare, rule.compare)
        source = f"SELECT ts, series, value FROM samples WHERE metric = '{rule.metric}'"
        if rule.sum_series:
            source = f"SELECT ts, '' AS series, sum(value) AS value FROM samples WHERE metric = '{rule.metric}' GROUP BY ts"
        parts.append(
            f"SELECT '{rule.name}' AS alertname, '{rule.severity}' AS severity, {rule.for_seconds} AS hold, "
            f"ts, series, value {compare} {rule.threshold} AS breached FROM ({source})"
        )
    return " UNION ALL ".join(parts)


# Plain gaps and islands over each whole series.
_STATES = f"""
evaluated AS ({_rule_rows()}),
marked AS (
  SELECT *, breached AND (lag(breached) OVER w IS NULL OR NOT lag(breached) OVER w
      OR date_diff('second', lag(ts) OVER w, ts) > 120) AS starts
  FROM evaluated WINDOW w AS (PARTITION BY alertname, series ORDER BY ts)
),
islands AS (
  SELECT *, max(CASE WHEN starts THEN ts END) OVER (PARTITION BY alertname, series ORDER BY ts
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM marked
),
states AS (
  SELECT alertname, severity, series, ts, CASE WHEN NOT breached THEN 'inactive'
    WHEN date_diff('second', since, ts) >= hold THEN 'firing' ELSE 'pending' END AS state FROM islands
)"""

_DEAD_HEADERS = (
    "'__connect.errors.topic=tweets_raw;__connect.errors.connector.name=archive;"
    "__connect.errors.exception.message=Le tweet à sérialiser doit être un dict'"
)

_COUNTED_AUDIT = f"""WITH {_POSTS}, {_CHECKED}, {_LINES},
rejected AS (SELECT count(*) AS n FROM checked WHERE len(errors) > 0),
dead AS (SELECT count(*) AS n FROM posts WHERE doc_id % 59 = 0),
app AS (SELECT count(*) AS n FROM logged)"""


def _found(pages: str) -> str:
    return f"""WITH {_PAGES},
            found AS (SELECT run_id, page, n_before, unnest(texts) AS text,
                unnest(range(0, len(texts))) AS i FROM {pages})
            SELECT run_id, n_before + i + 1 AS rank, concat(page, '-', i) AS tweet_id, md5(text) AS text,
                concat('u', (page + i) % 97) AS author_id FROM found"""


_TWICE = f"""{_STAGED}, twice AS (
  SELECT * FROM staging UNION ALL SELECT * FROM staging WHERE CAST(tweet_id AS BIGINT) % 3 = 0
)"""

# Posts that a collection reads: up to the first page without a token, at most 250 of a run.
_COLLECTED = f"""WITH {_POSTS}, {_PROFILES},
read AS (
  SELECT *, {_NESTED_ERRORS} AS errors, row_number() OVER w AS place,
    coalesce(bool_and(doc_id % 97 <> 96) OVER (PARTITION BY source ORDER BY doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS reached
  FROM posts WINDOW w AS (PARTITION BY source ORDER BY doc_id)
),
shaped AS (
  SELECT source, doc_id % 59 = 0 AS hollow,
    CASE WHEN doc_id % 59 = 0 OR doc_id % 13 = 0 OR author_id = '' THEN NULL ELSE author_id END AS author,
    CASE WHEN doc_id % 59 <> 0 THEN {_RAW_ID} END AS id, doc_id % 59 <> 0 AND len(errors) = 0 AS ok,
    doc_id % 59 <> 0 AND len(errors) = 0 AND NOT {_EMPTY_ID} AS sent
  FROM read WHERE reached AND place <= 250
),
kept AS (
  SELECT s.*, p.user_id, p.username AS user_username, CAST(p.followers_count AS VARCHAR) AS user_followers_count,
    CASE WHEN p.user_id IS NOT NULL THEN 'true' END AS enriched
  FROM shaped s LEFT JOIN last_profile p ON p.user_id = s.author
)"""


# Runs that reach every post: one long run, and one for each source and block of 50 ids.
_COLLECTED_ALL = f"""WITH {_POSTS}, {_PROFILES},
read AS (
  SELECT *, {_NESTED_ERRORS} AS errors,
    CASE WHEN doc_id % 3 = 0 THEN 'long' ELSE concat(source, '-', doc_id // 50) END AS run_id
  FROM posts
),
shaped AS (
  SELECT run_id,
    CASE WHEN doc_id % 59 = 0 OR doc_id % 13 = 0 OR author_id = '' THEN NULL ELSE author_id END AS author,
    CASE WHEN doc_id % 59 <> 0 THEN {_RAW_ID} END AS id, doc_id % 59 <> 0 AND len(errors) = 0 AS ok,
    doc_id % 59 <> 0 AND len(errors) = 0 AND NOT {_EMPTY_ID} AS sent
  FROM read
),
kept AS (
  SELECT s.*, p.user_id, p.username AS user_username, CAST(p.followers_count AS VARCHAR) AS user_followers_count,
    CASE WHEN p.user_id IS NOT NULL THEN 'true' END AS enriched
  FROM shaped s LEFT JOIN last_profile p ON p.user_id = s.author
)"""


def _histogram() -> str:
    rows = [
        f"SELECT '{b:g}' AS le, count(*) FILTER (WHERE value / 100 <= {b}) AS n FROM events" for b in LATENCY_BUCKETS
    ]
    rows.append("SELECT '+Inf' AS le, count(value) AS n FROM events")
    return (
        "SELECT le, n, (SELECT count(value) FROM events) AS count, "
        f"(SELECT round(sum(value / 100), 2) FROM events) AS sum FROM ({' UNION ALL '.join(rows)})"
    )


def oracle_sql() -> dict[str, str]:
    archived = f"""WITH {_POSTS}, dated AS (SELECT tweet_id, retweet_count,
        coalesce(created, TIMESTAMP '2024-02-01') AS d FROM posts)"""
    date_parts = "strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day"
    bronze = f"""{_VALIDATED} SELECT CASE WHEN author_id = '' THEN 'unknown' ELSE author_id END AS key, tweet_id, lang,
        CAST(like_count AS VARCHAR) AS like_count, CAST(retweet_count AS VARCHAR) AS retweet_count,
        created_text AS created_at, tweet_id AS raw_id FROM checked WHERE len(errors) = 0 AND NOT {_EMPTY_ID}"""
    silver = f"""{_STAGED} SELECT tweet_id AS key, tweet_id, CAST(engagement AS VARCHAR) AS engagement, author_id,
        {_SILVER_TIME} AS created_at, CAST(retweet_count AS VARCHAR) AS retweet_count FROM staging"""
    routed = f"""{_VALIDATED} SELECT CASE WHEN len(errors) = 0 AND NOT {_EMPTY_ID} THEN 'bronze' ELSE 'validation_error' END
            AS category, count(*) AS n FROM checked GROUP BY ALL
            UNION ALL SELECT 'dead_letter', count(*) FROM posts WHERE doc_id % 59 = 0"""
    reasons = "SELECT unnest(errors) AS reason FROM checked"
    found = {
        # sources
        "read_tweets": f"""WITH {_POSTS} SELECT CASE WHEN ok THEN tweet_id END AS tweet_id,
            CASE WHEN ok THEN author_id END AS author_id, CASE WHEN ok THEN CAST(retweet_count AS VARCHAR) END AS retweet_count
            FROM (SELECT *, doc_id % 41 <> 0 AS ok FROM posts)""",
        "max_per_trigger": "SELECT CAST(1 AS BIGINT) AS files, true AS several, count(*) AS n FROM documents",
        "starting_offsets": "SELECT count(*) AS n, true AS several, 'earliest' AS start FROM documents",
        "stream_config": f"{_STAGED} SELECT tweet_id, engagement FROM staging",
        "utc_session": f"WITH {_POSTS} SELECT tweet_id, {_stamp('created')} AS created_at FROM posts",
        "read_response_pages": f"{_found('pages_kept')} WHERE n_before + i + 1 <= 250",
        "read_response_pages_all": _found("pages_all"),
        "read_response_pages_many": f"""WITH {_MANY_PAGES} SELECT run_id, n_before + i + 1 AS rank,
            concat(page, '-', i) AS tweet_id, md5(text) AS text, concat('u', (page + i) % 97) AS author_id FROM many_posts""",
        "page_prefix": f"WITH {_PAGES} SELECT run_id, page, CAST(n_items AS INTEGER) AS n_items, n_before FROM pages_kept",
        "read_app_logs": f"""WITH {_LINES} SELECT line FROM logged
            UNION ALL SELECT '   ' FROM events WHERE event_id % 50 = 0""",
        "follow_app_logs": f"""WITH {_LINES} SELECT line FROM logged
            UNION ALL SELECT '   ' FROM events WHERE event_id % 50 = 0""",
        "read_raw_archive": f"{archived} SELECT tweet_id, retweet_count, {date_parts} FROM dated WHERE d < TIMESTAMP '2024-02-01'",
        "read_profiles": f"WITH {_PROFILE_ROWS} SELECT user_id, username, followers_count, verified FROM profile_rows",
        # sinks
        "staging_table_sink": _STAGING_VIEW,
        "staging_two_checkpoints": _STAGING_VIEW,
        "compact_staging": _STAGING_VIEW,
        "sql_top_engaged": f"""{_TWICE} SELECT tweet_id, engagement, array_to_string(themes, ',') AS themes,
            array_to_string(hashtags, ',') AS hashtags, {_stamp('created')} AS created_at FROM twice
            WHERE len(themes) > 0 ORDER BY engagement DESC, tweet_id LIMIT 50""",
        "sql_total": f"{_TWICE} SELECT count(*) AS total FROM twice",
        "sql_themes": f"{_TWICE} SELECT theme, count(*) AS n FROM (SELECT unnest(themes) AS theme FROM twice) GROUP BY theme",
        "sql_duplicates": f"""{_TWICE} SELECT tweet_id, count(*) AS n FROM twice GROUP BY tweet_id
            HAVING count(*) > 1 ORDER BY n DESC, tweet_id LIMIT 50""",
        "silver_publisher": silver,
        "dual_sink": f"""{_STAGED} SELECT 'silver' AS sink, tweet_id FROM staging
            UNION ALL SELECT 'staging', tweet_id FROM staging""",
        "write_raw_archive": f"{archived} SELECT tweet_id, retweet_count, {date_parts} FROM dated",
        "archive_counts": f"{archived} SELECT {date_parts}, count(*) AS n FROM dated GROUP BY ALL",
        # All events lie in January, when Europe/Paris is one hour ahead of UTC.
        "archive_stream": f"SELECT event_id, user_id, {date_parts} FROM (SELECT *, ts + INTERVAL 1 HOUR AS d FROM events)",
        "dead_letter": f"SELECT '{{not a json}}' AS value, {_DEAD_HEADERS} AS headers FROM documents WHERE doc_id % 59 = 0",
        "publish_bronze": bronze,
        "publish_audit": f"""{_VALIDATED} SELECT 'validation_error' AS key, 'validation_error' AS audit_type,
            'VALIDATION_ERROR' AS type, 'tweets_raw_producer' AS source, {_RAW_ID} AS raw_id,
            array_to_string(errors, '|') AS errors FROM checked WHERE len(errors) > 0""",
        "run_summary": f"{_SUMMARY} SELECT * FROM summary",
        "write_run_summary": f"""{_SUMMARY} SELECT run_id, tweets_fetched, tweets_valid, api_cost_estimate,
            'Ligue1' AS arg_keywords FROM summary""",
        # parsing and enrichment
        "parse_tweets": f"""WITH {_POSTS} SELECT CASE WHEN ok THEN tweet_id END AS tweet_id,
            CASE WHEN ok THEN md5(text) END AS text, CASE WHEN ok THEN created_text END AS created_at,
            CASE WHEN ok THEN author_id END AS author_id, CASE WHEN ok THEN lang END AS lang,
            CASE WHEN ok AND doc_id % 14 <> 3 THEN like_count END AS like_count,
            CASE WHEN ok THEN retweet_count END AS retweet_count,
            CASE WHEN ok THEN array_to_string(hashtags, ',') END AS hashtags
            FROM (SELECT *, doc_id % 41 <> 0 AS ok FROM posts)""",
        "parse_tweets_coerced": f"""WITH {_POSTS} SELECT tweet_id, like_count, retweet_count,
            coalesce(like_count, 0) + retweet_count AS engagement FROM posts WHERE doc_id % 41 <> 0""",
        "drop_unparseable": f"WITH {_POSTS} SELECT tweet_id, lang FROM posts WHERE doc_id % 41 <> 0",
        "with_engagement": f"""WITH {_POSTS} SELECT tweet_id, like_count, retweet_count,
            coalesce(like_count, 0) + retweet_count AS engagement FROM posts""",
        "with_themes": f"WITH {_POSTS}, {_TAGGED} SELECT tweet_id, array_to_string(themes, ',') AS themes FROM tagged",
        "tag_themes_udf": f"WITH {_POSTS}, {_TAGGED} SELECT tweet_id, array_to_string(themes, ',') AS themes FROM tagged",
        "enrich": f"""WITH {_POSTS}, {_TAGGED} SELECT tweet_id, author_id,
            coalesce(like_count, 0) + retweet_count AS engagement, array_to_string(themes, ',') AS themes FROM tagged""",
        "normalize_text": f"""WITH {_POSTS} SELECT tweet_id, md5({_NORM}) AS normal_md5,
            CAST(length({_NORM}) AS INTEGER) AS n FROM posts""",
        "match_keywords": f"""WITH {_POSTS} SELECT tweet_id, {_whole_words(_NORM, ['les', 'the', 'hors jeu'])}
            OR {_in_tags(_TAGS, ['les', 'the', 'hors jeu'])} AS matched FROM posts""",
        "parse_created_at": f"WITH {_POSTS} SELECT tweet_id, {_stamp('created')} AS created_at FROM posts",
        "with_processed_at": "SELECT count(*) AS n FROM documents",
        "to_staging": _STAGING_VIEW,
        "to_kafka_frame": silver,
        "flatten_tweets": f"""WITH {_POSTS}, shaped AS (SELECT *, doc_id % 59 <> 0 AND NOT {_EMPTY_ID} AS ok FROM posts)
            SELECT doc_id, CASE WHEN doc_id % 59 = 0 THEN 'Le tweet à sérialiser doit être un dict'
                WHEN {_EMPTY_ID} THEN 'Champ manquant : id' END AS flatten_error,
            CASE WHEN ok THEN tweet_id END AS tweet_id,
            CASE WHEN ok THEN CASE WHEN doc_id % 43 = 0 THEN '' ELSE created_text END END AS created_at,
            CASE WHEN ok THEN CASE WHEN doc_id % 13 = 0 THEN '' ELSE author_id END END AS author_id,
            CASE WHEN ok THEN lang END AS lang,
            CASE WHEN NOT ok OR {_LIKE_NULL} THEN NULL WHEN {_LIKE_NEGATIVE} THEN '-1'
                 WHEN doc_id % 47 = 0 OR {_METRICS_ABSENT} OR {_LIKE_ABSENT} THEN '0'
                 ELSE CAST(like_count AS VARCHAR) END AS like_count,
            CASE WHEN NOT ok THEN NULL WHEN doc_id % 47 = 0 OR {_METRICS_ABSENT} THEN '0'
                 ELSE CAST(retweet_count AS VARCHAR) END AS retweet_count,
            CASE WHEN ok AND doc_id % 37 <> 0 THEN md5(text) END AS text_md5,
            CASE WHEN ok THEN CASE WHEN doc_id % 29 = 0 OR doc_id % 23 = 0 THEN ''
                 ELSE array_to_string(hashtags, ',') END END AS hashtags FROM shaped""",
        "decode_flat": f"""WITH {_POSTS} SELECT doc_id, CASE WHEN doc_id % 41 <> 0 THEN tweet_id END AS tweet_id,
            CASE WHEN doc_id % 41 <> 0 THEN CAST(like_count AS VARCHAR) END AS like_count FROM posts""",
        "partition_key": f"""WITH {_POSTS} SELECT tweet_id, CASE WHEN author_id = '' THEN 'unknown' ELSE author_id END AS key
            FROM posts""",
        "extract_hashtags": f"""WITH {_POSTS} SELECT doc_id, CASE WHEN doc_id % 59 = 0 THEN ''
            ELSE array_to_string({_NESTED_TAGS}, ',') END AS hashtags FROM posts""",
        "detect_club": f"WITH {_POSTS} SELECT tweet_id, {_club('hashtags')} AS club FROM posts",
        # validation and audit
        "validate_tweets": f"""{_VALIDATED} SELECT doc_id, array_to_string(errors, '|') AS errors,
            len(errors) = 0 AS is_valid FROM checked""",
        "validate_flat_profile": f"""WITH {_POSTS} SELECT doc_id, array_to_string({_FLAT_ERRORS}, '|') AS errors FROM posts""",
        "validation_errors": f"""{_VALIDATED} SELECT doc_id, CAST(unnest(range(0, len(errors))) AS INTEGER) AS position,
            unnest(errors) AS reason FROM checked""",
        "split_valid": f"""{_VALIDATED} SELECT doc_id, CASE WHEN len(errors) = 0 THEN 'bronze' ELSE 'audit' END AS route
            FROM checked""",
        "to_audit_event": f"""{_VALIDATED} SELECT 'validation_error' AS key, 'VALIDATION_ERROR' AS type,
            'tweets_raw_producer' AS source, {_RAW_ID} AS raw_id, lang AS raw_lang FROM checked WHERE len(errors) > 0""",
        "audit_union": f"""{_COUNTED_AUDIT} SELECT 'validation_error' AS key, 'VALIDATION_ERROR' AS type, n FROM rejected
            UNION ALL SELECT NULL, NULL, n FROM dead UNION ALL SELECT NULL, 'APP_LOG', n FROM app""",
        "route_audit": f"""{_COUNTED_AUDIT} SELECT 'validation_error' AS category, n FROM rejected
            UNION ALL SELECT 'dead_letter', n FROM dead UNION ALL SELECT 'app_log', n FROM app""",
        "parse_app_logs": f"WITH {_LINES} SELECT event_id, type, ts, level, logger, message, ts AS event_time FROM logged",
        "drop_blank_lines": f"WITH {_LINES} SELECT event_id, line FROM logged",
        "audit_by_level": f"WITH {_LINES} SELECT type, level, count(*) AS n FROM logged GROUP BY ALL",
        # profiles, search, cost
        "normalize_profiles": f"WITH {_PROFILE_ROWS} SELECT * FROM profile_rows",
        "merge_profiles": f"""WITH {_POSTS}, {_PROFILES} SELECT t.doc_id, t.author_id, p.username AS user_username,
            p.followers_count AS user_followers_count, p.verified AS user_verified, p.description AS user_description,
            CASE WHEN p.user_id IS NOT NULL THEN true END AS enriched
            FROM posts t LEFT JOIN last_profile p ON p.user_id = t.author_id""",
        "merge_profiles_as_of": f"""WITH {_POSTS}, profile_versions AS (
            SELECT concat('u', (c_custkey - 1) * 2) AS user_id, concat(c_name, '-', version) AS user_username,
                CAST(c_custkey * 10 + version AS BIGINT) AS user_followers_count, version % 2 = 1 AS user_verified,
                TIMESTAMP '2024-01-01' + to_hours(CAST(c_custkey % 11 + version * CASE WHEN c_custkey = 1 THEN 17 ELSE 144 END AS INTEGER)) AS valid_from
            FROM (SELECT *, unnest(range(0, CASE WHEN c_custkey = 1 THEN 40 ELSE 1 + CAST(c_custkey % 4 AS BIGINT) END)) AS version FROM customer))
            SELECT doc_id, author_id, user_username, user_followers_count, user_verified,
                CASE WHEN user_id IS NOT NULL THEN true END AS enriched
            FROM posts ASOF LEFT JOIN profile_versions ON author_id = user_id AND created >= valid_from""",
        "matched_authors": f"""WITH {_POSTS}, {_PROFILES} SELECT DISTINCT author_id FROM posts
            WHERE author_id IN (SELECT user_id FROM last_profile)""",
        "unmatched_authors": f"""WITH {_POSTS}, {_PROFILES} SELECT DISTINCT author_id FROM posts
            WHERE author_id <> '' AND author_id NOT IN (SELECT user_id FROM last_profile)""",
        "distinct_authors": f"WITH {_POSTS} SELECT DISTINCT author_id FROM posts WHERE author_id <> ''",
        "count_distinct_authors": f"WITH {_POSTS} SELECT count(DISTINCT nullif(author_id, '')) AS authors FROM posts",
        "distinct_usernames": f"""WITH {_POSTS} SELECT coalesce(nullif(CASE WHEN doc_id % 4 = 0 THEN '' ELSE author_id END, ''),
            source) AS username, min(doc_id) AS first_seen FROM posts GROUP BY ALL""",
        "profile_stats": f"""WITH {_POSTS}, {_PROFILES}, authors AS (SELECT DISTINCT author_id FROM posts WHERE author_id <> '')
            SELECT count(*) FILTER (WHERE author_id IN (SELECT user_id FROM last_profile)) AS success,
                   count(*) FILTER (WHERE author_id NOT IN (SELECT user_id FROM last_profile)) AS failed FROM authors""",
        "search_filter": f"""WITH {_POSTS} SELECT tweet_id, lang, retweet_count, {_stamp('created')} AS created_at FROM posts
            WHERE lang = 'fr' AND retweet_count >= 3 AND created >= TIMESTAMP '2024-01-03' AND created < TIMESTAMP '2024-01-25'
              AND NOT starts_with(text, 'RT @') AND {_whole_words(_NORM, ['les', 'decision var', 'analyse video'])}""",
        "search_config": f"""WITH {_POSTS} SELECT source, tweet_id FROM posts
            WHERE lang = 'en' AND {_whole_words(_NORM, ['the', 'is'])}
            QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 250""",
        "search_query": f"""WITH {_POSTS}, plain AS (SELECT tweet_id FROM posts WHERE retweet_count >= 3
                AND NOT starts_with(text, 'RT @') AND {_whole_words(_NORM, ['les', 'decision var', 'the'])})
            SELECT 'keywords' AS query, tweet_id FROM plain UNION ALL SELECT 'explicit', tweet_id FROM plain
            UNION ALL SELECT 'all', tweet_id FROM posts WHERE lang <> 'de' AND retweet_count >= 2
                AND NOT {_whole_words(_NORM, ['analyse video'])} AND ({_whole_words(_NORM, ['les'])}
                OR {_whole_words(_NORM, ['the'])} AND NOT {_whole_words(_NORM, ['is'])})""",
        "cap_results": """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) <= 250""",
        "with_api_cost": f"""WITH {_RUNS}, {_COSTED} SELECT run_id, tweets_fetched, mills / 1000.0 AS api_cost,
            left_mills / 1000.0 AS remaining_budget, left_mills // 5 AS remaining_tweets,
            left_mills // 1250 AS remaining_collections FROM costed""",
        "budget_status": f"""WITH {_RUNS}, {_COSTED} SELECT run_id, CASE WHEN mills >= 1000 THEN 'EXCEEDED'
            WHEN mills >= 800 THEN 'WARNING' ELSE 'OK' END AS status FROM costed""",
        "cumulative_cost": f"""WITH {_RUNS}, total AS (SELECT account, run_id, CAST(sum(tweets_fetched) OVER
            (PARTITION BY account ORDER BY run_started, run_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_tweets FROM runs)
            SELECT account, run_id, cumulative_tweets, cumulative_tweets * 5 / 1000.0 AS cumulative_cost,
            CASE WHEN cumulative_tweets >= 5000 THEN 'EXCEEDED' WHEN cumulative_tweets >= 4000 THEN 'WARNING' ELSE 'OK' END
            AS status FROM total""",
        # reports
        "top_engaged": f"""{_STAGED} SELECT tweet_id, engagement, array_to_string(themes, ',') AS themes,
            array_to_string(hashtags, ',') AS hashtags, {_stamp('created')} AS created_at FROM staging
            WHERE len(themes) > 0 ORDER BY engagement DESC, tweet_id LIMIT 50""",
        "staging_total": f"{_STAGED} SELECT count(*) AS total FROM staging",
        "theme_counts": f"{_STAGED} SELECT theme, count(*) AS n FROM (SELECT unnest(themes) AS theme FROM staging) GROUP BY theme",
        "duplicate_ids": f"""WITH {_POSTS}, {_COPIES} SELECT tweet_id, count(*) AS n FROM copies GROUP BY tweet_id
            HAVING count(*) > 1 ORDER BY n DESC, tweet_id LIMIT 50""",
        "ordered_counts": "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey",
        "valid_invalid_counts": f"""{_VALIDATED} SELECT count(*) FILTER (WHERE len(errors) = 0) AS valid,
            count(*) FILTER (WHERE len(errors) > 0) AS invalid FROM checked""",
        "rejects_by_reason": f"{_VALIDATED} SELECT reason, count(*) AS n FROM ({reasons}) GROUP BY reason",
        "sent_by_club": f"""{_VALIDATED} SELECT {_club(_NESTED_TAGS)} AS club, count(*) AS n FROM checked
            WHERE len(errors) = 0 GROUP BY ALL""",
        "delivery_failures": "SELECT 'tweets_raw' AS topic, count(*) AS n FROM documents WHERE doc_id % 59 = 0",
        "latency_histogram": _histogram(),
        "authors_by_range": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS posts, count(DISTINCT o_custkey) AS exact, true AS within
            FROM orders GROUP BY ALL""",
        "latency_quantiles": """SELECT event_type AS topic, count(value) AS n, share, true AS within
            FROM events, (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE)) AS s(share) GROUP BY ALL""",
        "heavy_authors": f"""WITH {_POSTS} SELECT author_id AS key, count(*) AS n FROM posts GROUP BY ALL
            HAVING count(*) > 0.02 * (SELECT count(author_id) FROM posts)""",
        # windows, alerts, retention
        "latest_by_key": f"""WITH {_POSTS}, {_COPIES} SELECT tweet_id, doc_id, retweet_count, {_stamp('processed')} AS processed_at
            FROM copies QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY processed DESC, doc_id DESC) = 1""",
        "alert_for": f"""WITH {_SAMPLES}, {_STATES} SELECT alertname, severity, series, {_stamp('ts')} AS ts, state FROM states""",
        "controllers_active": f"""WITH {_SAMPLES} SELECT {_stamp('ts')} AS ts, sum(value) AS active, sum(value) <> 1 AS breached
            FROM samples WHERE metric = 'kafka_controller_active_count' GROUP BY ALL""",
        "group_alerts": f"""WITH {_SAMPLES}, {_STATES},
            per_ts AS (SELECT alertname, severity, ts, bool_or(state = 'firing') AS fires,
                count(*) FILTER (WHERE state = 'firing') AS n FROM states GROUP BY ALL),
            begun AS (SELECT *, CASE WHEN fires AND NOT coalesce(lag(fires) OVER w, false) THEN ts END AS start_ts
                FROM per_ts WINDOW w AS (PARTITION BY alertname, severity ORDER BY ts)),
            episodes AS (SELECT *, max(start_ts) OVER (PARTITION BY alertname, severity ORDER BY ts
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS first_ts FROM begun),
            firing AS (SELECT *, date_diff('second', first_ts, ts) // 3600 AS repeat FROM episodes WHERE fires)
            SELECT alertname, severity, repeat, {_stamp('min(ts)')} AS notified_at, CAST(sum(n) AS BIGINT) AS samples,
                CASE severity WHEN 'critical' THEN 'slack-critical' ELSE 'slack-alerts' END AS receiver
            FROM firing GROUP BY alertname, severity, first_ts, repeat""",
        "apply_retention": """SELECT event_id, 'tweets_raw' AS topic FROM events
                WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY
            UNION ALL SELECT event_id, 'audit_logs' FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 14 DAY""",
        # streams
        "run_stream": _STAGING_VIEW,
        "durable_checkpoint": f"{_STAGED} SELECT count(*) AS total FROM staging",
        "stream_validate_route": routed,
        "audit_three_producers": f"{routed} UNION ALL SELECT 'app_log', count(*) FROM events WHERE event_id % 50 <> 0",
        "collection_run": f"""{_COLLECTED} SELECT 'archive' AS place, id, user_username, user_followers_count, enriched FROM kept
            UNION ALL SELECT CASE WHEN sent THEN 'bronze' ELSE 'audit' END, id, user_username, user_followers_count, enriched
            FROM kept""",
        "collection_summary": f"""{_COLLECTED}, counted AS (SELECT source AS run_id, true AS success, count(*) AS tweets_fetched,
                count(DISTINCT user_id) AS users_enriched, count(*) AS tweets_enriched,
                count(*) FILTER (WHERE ok) AS tweets_valid, count(*) FILTER (WHERE NOT ok) AS tweets_invalid,
                count(*) FILTER (WHERE sent) AS tweets_sent_to_kafka, count(DISTINCT author) AS author_ids_found, '' AS errors
            FROM kept GROUP BY source)
            SELECT * FROM counted UNION ALL SELECT 'empty', true, 0, 0, 0, 0, 0, 0, 0, ''
            UNION ALL SELECT 'failed', false, 0, 0, 0, 0, 0, 0, 0, 'API: 500'""",
        "collection_run_all": f"""{_COLLECTED_ALL} SELECT 'archive' AS place, id, user_username, user_followers_count, enriched
            FROM kept UNION ALL SELECT CASE WHEN sent THEN 'bronze' ELSE 'audit' END, id, user_username, user_followers_count,
            enriched FROM kept""",
        "collection_summary_all": f"""{_COLLECTED_ALL}, counted AS (SELECT run_id, true AS success, count(*) AS tweets_fetched,
                count(DISTINCT user_id) AS users_enriched, count(*) AS tweets_enriched,
                count(*) FILTER (WHERE ok) AS tweets_valid, count(*) FILTER (WHERE NOT ok) AS tweets_invalid,
                count(*) FILTER (WHERE sent) AS tweets_sent_to_kafka, count(DISTINCT author) AS author_ids_found, '' AS errors
            FROM kept GROUP BY run_id)
            SELECT * FROM counted UNION ALL SELECT 'empty', true, 0, 0, 0, 0, 0, 0, 0, ''
            UNION ALL SELECT 'failed', false, 0, 0, 0, 0, 0, 0, 0, 'API: 500'""",
        "stream_app_logs": f"WITH {_LINES} SELECT 'app_log' AS category, level, logger, message FROM logged",
        "stream_dedup": _STAGING_VIEW,
        "stream_upsert": _STAGING_VIEW,
        "stream_metrics": f"""{_VALIDATED} SELECT 'rejected' AS counter, reason AS label, count(*) AS n
            FROM ({reasons} UNION ALL SELECT 'Champ manquant : id' FROM checked WHERE len(errors) = 0 AND {_EMPTY_ID})
            GROUP BY reason
            UNION ALL SELECT 'sent', {_club(_NESTED_TAGS)} AS label, count(*) FROM checked
            WHERE len(errors) = 0 AND NOT {_EMPTY_ID} GROUP BY ALL""",
    }
    # Streams give what the same operator gives in batch.
    return found | {f"stream_{name}": found[name] for name in ("alert_for", "group_alerts")}
