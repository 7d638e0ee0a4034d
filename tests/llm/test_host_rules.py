"""Rules on documents and their hosts, against plain loops and hand-made rates."""

import pytest

from tests.compare import compare, connect
from tests.llm import brute
from touchline.llm import host_rules
from touchline.llm import queries as Q

SF_DIR = "/root/testdata/sf0.001"
GOOD = " ".join(f"word{i}" for i in range(60))
BAD = "too short"


def made(spark, hosts):
    """One document per outcome; ``hosts`` maps a host to (number of good, number of bad) documents."""
    rows = []
    for host, (good, bad) in hosts.items():
        rows += [(host, GOOD + f" {host} {i}") for i in range(good)] + [(host, BAD)] * bad
    return spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string")


@pytest.mark.parametrize("where", ["awkward", "given"])
def test_figures(spark, folder, where):
    where = folder if where == "awkward" else SF_DIR
    docs = [tuple(r) for r in spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r)[:7] for r in Q.op11_host_rules(spark, where).collect()]
    expected = [(i, *brute.rule_figures(t)) for i, t in docs]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))


def test_matches_sql(spark):
    name = "op11_host_rules"
    compare(spark, connect(SF_DIR), name, Q.op11_host_rules, Q.oracle_sql()[name], SF_DIR)


def test_lines_and_windows(spark):
    text = "a a a a\n\n x \nb\r\n x \nb\n \t\nb\n# <é>"
    row = host_rules.measured(spark.createDataFrame([(1, "h", text)], "doc_id int, source string, text string")).first()
    assert (row.n_lines, row.n_dup_lines, row.n_symbols, row.word_chars) == (7, 2, 3, 13)
    assert row.n_repeat_words == brute.rule_figures(text)[4] == 4


def test_few_bad_documents_do_not_reject_a_small_host(spark):
    """A host's own rate is 1, but two documents say little against a prior of good hosts."""
    docs = made(spark, {f"h{i}": (20, 1) for i in range(10)} | {"small": (0, 2), "bad": (1, 40)})
    hosts = {r.host: r for r in host_rules.hosts(host_rules.measured(docs)).collect()}
    assert hosts["bad"].rejected and not hosts["h0"].rejected
    assert 0.05 < hosts["h0"].short_rate < hosts["small"].short_rate < 1
    assert 0.5 < hosts["bad"].short_rate < 40 / 41
    kept = {r.host: r.kept for r in host_rules.judged(docs).where("NOT base_failed").collect()}
    assert kept == {f"h{i}": True for i in range(10)} | {"bad": False}
    assert host_rules.kept(docs).count() == 200


def test_equal_rates_shrink_to_the_overall_one(spark):
    docs = made(spark, {f"h{i}": (3, 1) for i in range(5)})
    for r in host_rules.hosts(host_rules.measured(docs)).collect():
        assert abs(r.short_rate - 0.25) < 1e-4 and r.lines_rate == 0.0 and not r.rejected


def test_one_host_and_none(spark):
    docs = made(spark, {"only": (1, 9), None: (1, 1)})
    rows = host_rules.judged(docs).collect()
    assert len(rows) == 12
    assert {r.host for r in rows if r.host_rejected} == {"only"}
    assert [r.kept for r in rows if r.host is None and not r.base_failed] == [True]


def test_light_hosts_are_joined(spark, monkeypatch):
    """Hosts below the share that is broadcast get the same verdicts."""
    docs = made(spark, {f"h{i}": (2, 1) for i in range(9)} | {"bad": (1, 30), "worse": (1, 9)})
    expected = sorted(map(tuple, host_rules.judged(docs).select("doc_id", "host_rejected", "kept").collect()))
    assert {r[1] for r in expected} == {True, False}
    for heavy in (1, 3):
        monkeypatch.setattr(host_rules, "HEAVY", heavy)
        found = sorted(map(tuple, host_rules.judged(docs).select("doc_id", "host_rejected", "kept").collect()))
        assert found == expected


def test_clashing_columns_stay(spark, awkward):
    kept = host_rules.kept(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {7, 8, None}
