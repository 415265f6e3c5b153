from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException

from eventlens import schemas
from eventlens.operators.upsert import merge_by_key
from eventlens.plans import classify, reports
from eventlens.sources import connectors

D = datetime(2024, 1, 3)
DIM = [("0", "Functions", '0.500*"alpha" + 0.100*"beta"'),
       ("1", "Deployment", '0.500*"gamma" + 0.200*"beta"'),
       ("2", "Windows", '0.300*"delta"'),
       ("11", "Deployment", '0.300*"delta"')]
SUBJECTS = {
    "null": None,
    "empty": "",
    "stopwords": "and the of",
    "newline": "Re: gamma\n\tgamma beta",
    "quote": "'alpha' isn't beta",
    "other script": "Проблема с окнами 窗口",
    "accent": "ALPHÁ bèta",
    "tie": "delta",
    "x" * 120: "beta beta beta",
}
EXPECTED = {"empty": "0", "stopwords": "0", "newline": "1", "quote": "0", "other script": "0",
            "accent": "0", "tie": "2", "x" * 120: "1"}


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame(
        [(D, k, None, "", "a@example.org", s) for k, s in SUBJECTS.items()], schemas.MESSAGES)


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(DIM, schemas.DIM_TOPICS)


def test_topic_of_each_subject(messages, dim):
    rows = classify.keyword_scores(classify.with_tokens(messages), classify.topic_weights(dim))
    assert {r.message_id: r.topic_id for r in rows.collect()} == EXPECTED


def test_a_test_of_the_topic_does_not_repeat_the_scoring(messages, dim):
    """A dimension with a condition on its id becomes a condition on the messages' topics."""
    scores = classify.keyword_scores(classify.with_tokens(messages), classify.topic_weights(dim))
    found = classify.topic_lookup(scores, dim.where("id <> '1'"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and plan.count("aggregate(") == 1
    assert {r.message_id: r.topic_id for r in found.collect()} == {k: t for k, t in EXPECTED.items() if t != "1"}


def test_named_function_agrees(spark, messages, dim):
    classify.register_class_topic(spark, classify.topic_weights(dim))
    messages.createOrReplaceTempView("m")
    rows = spark.sql("select message_id, CLASS_TOPIC(message_subject) as t from m "
                     "where message_subject is not null").collect()
    assert {r.message_id: r.t for r in rows} == EXPECTED


def test_model_is_loaded_once_per_task_and_run_once_per_row(spark):
    loads, seen = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def load():
        loads.add(1)

        def predict(batch):
            seen.add(len(batch))
            return batch
        return predict
    df = spark.range(1000, numPartitions=2).selectExpr("cast(id as string) s")
    f = classify.topic_udf(load)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        out = df.select(f("s").alias("t")).where("t <> '7'")
        assert out.count() == 999
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert loads.value == 2
    assert seen.value == 1000


def test_lookup_is_inner_and_shared_labels_merge(messages, dim):
    known = dim.where("id <> '2'")
    rows = classify.classified_messages(messages, classify.topic_weights(dim), known)
    assert rows.schema.names == schemas.MESSAGE_TOPICS.names
    got = {r.message_id: (r.topic, r.topic_description) for r in rows.collect()}
    labels = {i: t for i, t, _ in DIM}
    assert got == {k: (t, labels[t]) for k, t in EXPECTED.items() if t != "2"}
    weekly = {r.topic_description: r.n for r in reports.weekly_topic_counts(rows).collect()}
    assert weekly == Counter(labels[t] for t in EXPECTED.values() if t != "2")


def test_series_limit_is_over_all_time(spark):
    rows = [("2024-01-01", "steady", 3), ("2024-01-08", "steady", 3), ("2024-01-01", "burst", 4),
            ("2024-01-08", "late", 1)]
    df = spark.createDataFrame([(d, t) for d, t, n in rows for _ in range(n)], "d string, topic_description string") \
        .selectExpr("cast(d as timestamp) message_date", "topic_description")
    top = reports.weekly_top_topics(df, series=1).collect()
    assert [(r.topic_description, r.n) for r in top] == [("steady", 3), ("steady", 3)]
    within = reports.top_within_week(df, k=1).collect()
    assert sorted((r.topic_description, r.n) for r in within) == [("burst", 4), ("steady", 3)]


def test_keys_and_lengths(spark, dim):
    doubled = dim.unionByName(dim.where("id = '0'"))
    assert [(r.id, r.n) for r in schemas.key_violations(doubled, "id").collect()] == [("0", 2)]
    assert schemas.key_violations(dim, "id").count() == 0
    long = schemas.length_violations(dim, {"topic": 9}, "id").collect()
    assert sorted((r.id, r.actual_length) for r in long) == [("1", 10), ("11", 10)]
    schemas.enforce_lengths(dim, schemas.DIM_TOPICS_LENGTHS).collect()
    with pytest.raises(PySparkException, match="VARCHAR"):
        schemas.enforce_lengths(dim, {"topic": 9}).collect()


def test_merge_by_key(spark):
    existing = spark.createDataFrame([("a", 0, "old"), ("b", 0, "old")], "k string, v int, s string")
    updates = spark.createDataFrame([("b", 1, "x"), ("b", 2, "y"), ("c", 1, "z")],
                                    "k string, v int, s string")
    once = merge_by_key(existing, updates, ["k"], ["v"])
    twice = merge_by_key(once, updates, ["k"], ["v"])
    want = [("a", 0, "old"), ("b", 2, "y"), ("c", 1, "z")]
    assert sorted(map(tuple, once.collect())) == want
    assert sorted(map(tuple, twice.collect())) == want


def test_keyed_files_absorb_a_replay(spark, tmp_path):
    schema = "k string, v int"
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], schema)
    second = spark.createDataFrame([("b", 5)], schema)
    for batch, df in [(0, first), (1, second), (1, second)]:
        connectors.upsert_files(df, batch, path, ["k"], ["v"])
    rows = connectors.read_upserted(spark, path, first.schema, ["k"]).collect()
    assert sorted(map(tuple, rows)) == [("a", 2), ("b", 5)]


def test_csv_round_trip(spark, messages, tmp_path):
    path = str(tmp_path / "csv")
    plain = messages.select("message_id", "message_subject", "message_in_reply_to")
    for _ in range(2):      # the second run replaces the first
        connectors.write_csv(plain, path)
    back = connectors.read_csv(spark, path, plain.schema)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_connector_options():
    kafka = connectors.kafka_source_options("h:1", "t", group_id="g", max_per_trigger=5)
    assert kafka["startingOffsets"] == "latest" and kafka["kafka.group.id"] == "g"
    table = connectors.JdbcTable("jdbc:x", "s.t", user="u")
    assert connectors.jdbc_read_options(table) == {
        "url": "jdbc:x", "dbtable": "s.t", "user": "u", "fetchsize": "10000"}
    split = connectors.jdbc_read_options(table, "message_date", "2021-01-01", "2021-02-01", 8)
    assert split["partitionColumn"] == "message_date" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        connectors.jdbc_read_options(table, "message_date")


def test_merge_statement():
    assert connectors.merge_statement("t1", "st", ["k", "v"], ["k"]) == (
        "MERGE INTO t1 t USING st s ON t.k = s.k WHEN MATCHED THEN UPDATE SET v = s.v "
        "WHEN NOT MATCHED THEN INSERT (k, v) VALUES (s.k, s.v)")
