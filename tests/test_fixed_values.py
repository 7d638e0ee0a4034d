"""The published constants, stated apart from the library: the SQL of the queries takes them from it."""

from collections import Counter

from touchline import vocabulary as V
from touchline.operators import alerts

# Alert rules, as (name, comparison, threshold, seconds, severity, summed over series).
RULES = [
    ("kafkaBrokerDown", "==", 0, 60, "critical", False),
    ("kafkaUnderReplicatedPartitions", ">", 0, 120, "warning", False),
    ("kafkaControllerNotActive", "!=", 1, 60, "critical", True),
    ("kafkaHighConsumerLag", ">", 1000, 300, "warning", False),
    ("kafkaLowIncomingMessages", "<", 1, 600, "warning", False),
]


def test_alert_rules():
    assert [(r.name, r.compare, r.threshold, r.for_seconds, r.severity, r.sum_series) for r in alerts.RULES] == RULES
    assert [r.name for r in alerts.RULES if not r.enabled] == ["kafkaHighConsumerLag"]
    assert {r.metric for r in alerts.RULES} == {
        "up", "kafka_broker_under_replicated_partitions", "kafka_controller_active_count",
        "kafka_consumergroup_lag", "kafka_broker_messages_in_per_sec",
    }


def test_theme_keywords():
    words = V.THEME_KEYWORDS
    assert {t: len(k) for t, k in words.items()} == {"analyse_video": 8, "stats_analytics": 11, "var": 6}
    assert list(words) == ["analyse_video", "stats_analytics", "var"]
    assert {t: (k[0], k[-1]) for t, k in words.items()} == {
        "analyse_video": ("analyse video", "sequence video"),
        "stats_analytics": ("stats", "metriques"),
        "var": ("var", "carton rouge"),
    }
    assert len({w for k in words.values() for w in k}) == 25


def test_clubs():
    assert len(V.CLUB_HASHTAGS) == 36 and (V.CLUB_FALLBACK, V.KEY_FALLBACK) == ("Ligue1", "unknown")
    twice = {"PSG", "OM", "OL", "OGCNICE", "MONACO", "STRASBOURG", "ANGERS", "TOULOUSE", "AUXERRE", "HAVRE", "BREST", "LENS", "SAINTETIENNE"}
    once = {"LOSC", "BORDEAUX", "NANTES", "TROYES", "LORIENT", "REIMS", "MONTPELLIER"}
    assert Counter(V.CLUB_HASHTAGS.values()) == dict.fromkeys(twice, 2) | dict.fromkeys(once, 1) | {"RENNES": 3}
    assert (V.CLUB_HASHTAGS["psg"], V.CLUB_HASHTAGS["asse"], V.CLUB_HASHTAGS["staderennais"]) == ("PSG", "SAINTETIENNE", "RENNES")


def test_buckets_and_limits():
    assert V.LATENCY_BUCKETS == (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1, 2.5, 5, 7.5, 10)
    assert (V.MAX_RESULTS_PER_COLLECT, V.MAX_RESULTS_PER_PAGE, V.MIN_RESULTS_PER_COLLECT) == (250, 100, 10)
    assert alerts.REPEAT_SECONDS == 3600 and str(V.BUDGET_LIMIT).startswith("25")
