"""A table with one row per key: copies at any distance, repeated batches, lookups by filter, compaction."""

import numpy as np
import pytest

from touchline.session import scratch_path
from touchline.sinks import keyed
from touchline.sinks.keyed import KeyedTable, bloom_bits, may_hold


def batch(spark, rows):
    return spark.createDataFrame(rows, "id string, n long")


def rows(table, spark):
    return sorted(map(tuple, table.read(spark, "id string, n long").collect()), key=repr)


@pytest.fixture
def table(spark):
    return KeyedTable(scratch_path(spark, "keyed"), "id", order=["n"], buckets=4, run="r")


def test_first_copy_stays_whenever_the_next_one_comes(spark, table):
    table(batch(spark, [("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 4)]), 0)
    for n in range(1, 6):
        table(batch(spark, [(f"x{n}", n), ("a", 10 + n)]), n)
    table(batch(spark, [("b", 99), ("c", 7), (None, 4)]), 6)
    expected = [("a", 1), ("b", 3), ("c", 7), (None, 4), (None, 4), (None, 4)] + [(f"x{n}", n) for n in range(1, 6)]
    assert rows(table, spark) == sorted(expected, key=repr)


def test_repeated_batch_replaces_itself(spark, table):
    table(batch(spark, [("a", 1), ("b", 2)]), 0)
    for _ in range(2):
        table(batch(spark, [("b", 5), ("c", 3)]), 1)
    assert rows(table, spark) == [("a", 1), ("b", 2), ("c", 3)]
    assert [x.written for x in table.lookups] == [2, 1, 1]


def test_batch_that_failed_before_its_filters_is_done_again(spark, table, monkeypatch):
    table(batch(spark, [("a", 1)]), 0)
    monkeypatch.setattr(keyed, "_FILTER", "nonsense")
    with pytest.raises(Exception):
        table(batch(spark, [("b", 2), ("a", 9)]), 1)
    monkeypatch.undo()
    table(batch(spark, [("b", 2), ("a", 9)]), 1)
    assert rows(table, spark) == [("a", 1), ("b", 2)]


def test_only_folders_that_may_hold_a_key_are_read(spark):
    table = KeyedTable(scratch_path(spark, "keyed"), "id", buckets=8, run="r")
    for n in range(4):
        table(batch(spark, [(f"{n}-{i}", i) for i in range(200)]), n)
    assert all(x.written == 200 and x.rows == 200 for x in table.lookups)
    # New keys are looked up by chance only: about one in a hundred.
    table(batch(spark, [(f"new-{i}", i) for i in range(4)]), 4)
    table(batch(spark, [("2-17", 1)]), 5)
    new, old = table.lookups[-2:]
    assert new.folders == old.folders - 4 or new.folders == 32
    assert new.folders_read <= 4 and new.written == 4
    assert 1 <= old.folders_read <= 3 and old.files_read <= old.folders_read * 2 and old.written == 0


def test_first_copies_are_found_on_narrow_rows(spark):
    """Only rows that are written go through a shuffle by bucket; copies are told apart without their other columns."""
    table = KeyedTable(scratch_path(spark, "keyed"), "id", order=["n"], buckets=4, run="r")
    frame = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", None, "z"), (None, 1, "v"), (None, 1, "v")], "id string, n long, text string")
    frame.write.parquet(source := scratch_path(spark, "wide"))
    firsts = table._firsts(table._numbered(spark.read.parquet(source)))
    assert "text:string" not in firsts._jdf.queryExecution().executedPlan().toString()
    assert firsts.count() == 3
    table(spark.read.parquet(source), 0)
    table(spark.read.parquet(source).where("id IS NOT NULL"), 1)
    assert sorted(r.text for r in table.read(spark).collect()) == ["v", "v", "z"]


def test_compaction_keeps_rows_and_filters(spark, table):
    for n in range(3):
        table(batch(spark, [(f"k{n}", n), ("a", n), (None, n)]), n)
    before = rows(table, spark)
    table.compact(spark)
    assert rows(table, spark) == before
    again = KeyedTable(table._path, "id", order=["n"], buckets=4, run="r")
    again(batch(spark, [("k1", 50), ("a", 51), ("z", 52)]), 3)
    assert rows(again, spark) == sorted([*before, ("z", 52)], key=repr)
    assert again.lookups[0].folders <= 4
    # A batch that was compacted and is then repeated adds nothing.
    again(batch(spark, [("k2", 2), ("a", 2)]), 2)
    assert rows(again, spark) == sorted([*before, ("z", 52)], key=repr)


def test_nothing_to_compact_and_empty_batch(spark, table):
    table.compact(spark)
    table(batch(spark, []), 0)
    assert rows(table, spark) == [] and table.lookups[0].written == 0


def test_clashing_columns(spark):
    table = KeyedTable(scratch_path(spark, "keyed"), "id", buckets=2, run="r")
    frame = batch(spark, [("a", 1)]).selectExpr("id", "n", "'x' AS keys", "1 AS bits")
    table(frame, 0)
    table(frame, 1)
    assert table.read(spark).select("id", "n", "keys", "bits").collect() == frame.collect()


def test_filters_never_deny():
    draw = np.random.default_rng(1)
    for n in (1, 7, 1000, 20_000):
        there, others = (draw.integers(-(2**63), 2**63 - 1, n) for _ in range(2))
        bits = bloom_bits(there)
        assert may_hold(bits, there).all()
        assert may_hold(bits, others).mean() < 0.05 or n < 100
