"""The keyed table: last wins, compaction changes no row, interrupted and double work."""

import random

import pytest
from pyspark.sql import types as T

from eventlens.sources import files
from eventlens.sources.keyed_table import KeyedTable

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("at", T.LongType()), T.StructField("v", T.StringType())])


def rows(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def held(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "table"), SCHEMA, ["k"], ["at"], buckets=4)


def test_last_wins_before_and_after_compaction(spark, table):
    assert held(table) == [] and table.compact() is False
    draw = random.Random(1)
    want = {}
    for batch in range(5):
        items = [(draw.choice(["a", "b", "c", "d", "e", None, ""]), draw.randrange(3), draw.choice("xyz")) for _ in range(12)]
        table.write_batch(rows(spark, items), batch)
        for k in {i[0] for i in items}:
            want[k] = max(i for i in items if i[0] == k)     # ties: by the whole row
        expected = sorted(want.values(), key=repr)
        assert held(table) == expected
        if batch in (1, 3):
            assert table.compact() is True
            assert held(table) == expected
    assert sorted(map(tuple, table.lookup(("a",), (None,), ("unknown",)).collect()), key=repr) == sorted(
        [want["a"], want[None]], key=repr)


def test_replays(spark, table):
    table.write_batch(rows(spark, [("a", 1, "x"), ("b", 1, "x")]), 0)
    table.write_batch(rows(spark, [("a", 1, "y")]), 0)      # replaces itself
    assert held(table) == [("a", 1, "y")]
    table.write_batch(rows(spark, [("a", 2, "z")]), 1)
    table.compact()
    table.write_batch(rows(spark, [("a", 9, "old")]), 0)    # taken in before
    assert held(table) == [("a", 2, "z")]


def test_interrupted_compaction_loses_nothing(spark, table, monkeypatch):
    table.write_batch(rows(spark, [("a", 1, "x"), ("b", 1, "x")]), 0)

    def crash(manifest):
        raise RuntimeError("lost before the swap")
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.compact()
    assert held(table) == [("a", 1, "x"), ("b", 1, "x")]
    table.write_batch(rows(spark, [("b", 1, "w")]), 1)
    assert table.compact() and held(table) == [("a", 1, "x"), ("b", 1, "w")]
    assert len(files.names(spark, f"{table.path}/base")) == 2
    table.vacuum()
    assert len(files.names(spark, f"{table.path}/base")) == 1
    assert files.names(spark, f"{table.path}/batches") == [] and held(table) == [("a", 1, "x"), ("b", 1, "w")]


def test_one_of_two_compactions_commits(spark, table):
    table.write_batch(rows(spark, [("a", 1, "x")]), 0)
    manifest = table.manifest()
    assert table.compact()
    assert table._commit({**manifest, "number": manifest["number"] + 1}) is False
    assert held(table) == [("a", 1, "x")]


def test_untouched_buckets_are_read_as_they_are(spark, table):
    table.write_batch(rows(spark, [(str(i), 1, "x") for i in range(40)]), 0)
    table.compact()
    before = table.manifest()["base"]
    table.write_batch(rows(spark, [("7", 2, "y")]), 1)
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" in plan
    assert len(held(table)) == 40
    table.compact()
    after = table.manifest()["base"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert not table.read()._jdf.queryExecution().optimizedPlan().toString().count("Aggregate")
