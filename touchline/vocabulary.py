"""Word lists, lookup tables, field lists and message texts.

Everything here must equal the published contract exactly for results to
agree; none of it is logic.
"""

from __future__ import annotations

# --- fixed values: theme -> keywords, in reporting order ---------------------
THEME_KEYWORDS: dict[str, list[str]] = {
    "analyse_video": [
        "analyse video",
        "video analysis",
        "analyse d'image",
        "ralenti",
        "montage video",
        "highlights",
        "resume video",
        "sequence video",
    ],
    "stats_analytics": [
        "stats",
        "statistiques",
        "statistique",
        "analytics",
        "xg",
        "expected goals",
        "opta",
        "heatmap",
        "data foot",
        "datascout",
        "metriques",
    ],
    "var": [
        "var",
        "arbitrage",
        "arbitre",
        "hors jeu",
        "penalty",
        "carton rouge",
    ],
}

# --- fixed values: lowercase hashtag -> club --------------------------------
CLUB_HASHTAGS: dict[str, str] = {
    "psg": "PSG",
    "allez_paris": "PSG",
    "om": "OM",
    "allezlom": "OM",
    "ol": "OL",
    "teamol": "OL",
    "ogcnice": "OGCNICE",
    "lesgym": "OGCNICE",
    "losc": "LOSC",
    "asmonaco": "MONACO",
    "asm": "MONACO",
    "girondins": "BORDEAUX",
    "fcnantes": "NANTES",
    "rennais": "RENNES",
    "srfc": "RENNES",
    "rcstrasbourg": "STRASBOURG",
    "rcsa": "STRASBOURG",
    "estac": "TROYES",
    "fclorient": "LORIENT",
    "angers": "ANGERS",
    "sco": "ANGERS",
    "reims": "REIMS",
    "staderennais": "RENNES",
    "mhsc": "MONTPELLIER",
    "toulouse": "TOULOUSE",
    "tfc": "TOULOUSE",
    "auxerre": "AUXERRE",
    "aja": "AUXERRE",
    "havre": "HAVRE",
    "hac": "HAVRE",
    "brest": "BREST",
    "sbfcbrest": "BREST",
    "lens": "LENS",
    "rclens": "LENS",
    "saintetienne": "SAINTETIENNE",
    "asse": "SAINTETIENNE",
}
CLUB_FALLBACK = "Ligue1"
KEY_FALLBACK = "unknown"

# --- fixed values: validation contract --------------------------------------
ALLOWED_LANGS = ("fr",)
NESTED_REQUIRED = ("id", "text", "created_at", "lang", "author_id", "public_metrics")
NESTED_METRICS = ("like_count", "retweet_count")
FLAT_REQUIRED = (
    "tweet_id",
    "text",
    "created_at",
    "lang",
    "author_id",
    "like_count",
    "retweet_count",
    "hashtags",
)
FLAT_COUNTERS = ("like_count", "retweet_count", "reply_count", "quote_count")

MSG_MISSING = "Champ manquant : {field}"
MSG_LANG_PREFIX = "Langue non autorisée : "
MSG_LANG_SUFFIX = " (attendu : {allowed})"
MSG_NEGATIVE = "{field} ne peut pas être négatif"
MSG_NOT_A_LIST = "{field} doit être une liste"
MSG_NOT_A_STRING = "{field} doit être une chaîne de caractères"
# Inputs on which the published rules have no answer get a reason of their own.
MSG_NOT_AN_OBJECT = "{field} doit être un objet"
MSG_NOT_A_NUMBER = "{field} doit être un entier"
MSG_BODY_NOT_OBJECT = "Le tweet à sérialiser doit être un dict"

# --- fixed values: topics, headers and event types --------------------------
TOPIC_BRONZE = "tweets_raw"
TOPIC_SILVER = "tweets_enriched"
TOPIC_AUDIT = "audit_logs"
AUDIT_HEADER = "audit_type"
AUDIT_VALIDATION = "validation_error"
AUDIT_APP_LOG = "app_log"
AUDIT_SOURCE = "tweets_raw_producer"
EVENT_VALIDATION = "VALIDATION_ERROR"
EVENT_APP_LOG = "APP_LOG"
LEVEL_UNPARSED = "UNPARSED"
LOGGER_UNKNOWN = "unknown"
DEAD_LETTER_HEADER_PREFIX = "__connect.errors."

# --- fixed values: collection cost and limits -------------------------------
COST_PER_TWEET = "0.005"
BUDGET_LIMIT = "25.00"
BUDGET_WARNING_RATIO = "0.80"
MAX_RESULTS_PER_COLLECT = 250
MIN_RESULTS_PER_COLLECT = 10
MAX_RESULTS_PER_PAGE = 100

# --- fixed values: archive and retention ------------------------------------
ARCHIVE_TIME_ZONE = "Europe/Paris"
ARCHIVE_RECORDS_PER_FILE = 100
ARCHIVE_ROTATION = "60 seconds"
RETENTION_DAYS = {TOPIC_BRONZE: 7, TOPIC_SILVER: 7, TOPIC_AUDIT: 14}

# --- fixed values: default histogram bounds of the public metrics client ----
LATENCY_BUCKETS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)
