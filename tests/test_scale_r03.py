"""Work by split and by hit: what the queries must not do in one task, or once for each topic."""
import datetime

import checks.records
import checks.streams
import pytest
from eventlens.plans import classify
from eventlens.sources import connectors

SCORES = [("a", "1", 2), ("a", "2", 3), ("b", "1", 1), ("c", "10", 5), ("d", "3", 0)]


@pytest.fixture
def tables(spark, tmp_path):
    """Documents and events in five files each, and splits so small that each file is its own."""
    texts = ['one\ntwo', 'say "x"', "", None, "a,b", '{"k": 4}', "x\r\nend", "plain"]
    docs = [(i, texts[i % len(texts)], "en", "src1", 1) for i in range(40)]
    events = [(i, datetime.datetime(2024, 1, 1), i, "t", 1.0, '{"k": %d}' % i) for i in range(30)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "4096")
    yield str(tmp_path), docs, events
    for k, v in held.items():
        spark.conf.set(k, v)


def test_csv_is_written_by_every_split(spark, tables, monkeypatch):
    path, docs, _ = tables
    tasks, write = [], connectors.write_csv
    monkeypatch.setattr(connectors, "write_csv", lambda df, to: (tasks.append(df.rdd.getNumPartitions()), write(df, to)))
    got = {(r.doc_id, r.text, r.lang) for r in checks.records.csv_split(spark, path).collect()}
    assert got == {(d[0], d[1], d[2]) for d in docs}
    assert tasks[0] >= 5


def test_stream_files_follow_the_splits(spark, tables, monkeypatch):
    path, docs, events = tables
    made, scratch = {}, checks.streams.scratch_path
    monkeypatch.setattr(checks.streams, "scratch_path", lambda s, name: made.setdefault(name, scratch(s, name)))
    got = {r.rejected: (r.n, r.total) for r in checks.streams.stream_quarantine(spark, path).collect()}
    good = sum(d[1] == '{"k": 4}' for d in docs)
    assert got == {False: (30 + good, sum(range(30)) + 4 * good), True: (40 - good, 0)}
    files = spark.read.text(made["wire"] + "/*.parquet").select("_metadata.file_name").distinct().count()
    batches = {r.batch_id for folder in ("good", "bad") for r in spark.read.parquet(made[folder]).select("batch_id").distinct().collect()}
    assert files > 4 and len(batches) == 2


def test_hits_are_added_once_not_for_each_topic(spark):
    weights = spark.createDataFrame(SCORES, "word string, topic_id string, thousandths long")
    docs = spark.createDataFrame([("p", ["a", "b", "a", "x"]), ("q", ["c", "a", "b", "b"]), ("r", []), ("s", ["x"]),
                                  ("t", ["d", "d"]), ("u", ["a", "b", "b"] * 5000)], "message_id string, tokens array<string>")
    scored = classify.keyword_scores(docs, weights)
    assert {r.message_id: (r.topic_id, r.score, r.total) for r in scored.collect()} == {
        "p": ("2", 6, 11), "q": ("10", 5, 12), "r": ("1", 0, 0), "s": ("1", 0, 0), "t": ("3", 0, 0), "u": ("1", 20000, 35000)}
    by_join = classify.keyword_scores(docs, weights, in_row=0)
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, by_join.collect()))
    assert "filter(_hits" not in scored._jdf.queryExecution().optimizedPlan().toString()
