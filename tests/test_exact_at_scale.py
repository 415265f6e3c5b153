"""Ids, ties and counts beyond what small tables hold."""

from eventlens.operators import coherence, corpus, windows
from eventlens.operators.upsert import latest_per_key
from eventlens.plans import classify
from eventlens.sources import standin
from tests.conftest import SF


def test_topic_ids_over_99(spark):
    messages = spark.createDataFrame([("m", ["a", "b"])], "message_id string, tokens array<string>")
    weights = spark.createDataFrame([("105", "a", 500), ("7", "b", 400)], "topic_id string, word string, thousandths long")
    assert classify.keyword_scores(messages, weights).first()[:] == ("m", "105", 500, 900)


def test_event_ids_over_34_bits(spark):
    rows = spark.sql("SELECT timestamp'2024-01-01 00:00:01' AS transaction_time, id, 5.0D AS in_store_payment_amount, "
                     "double(id) AS lat, double(id) AS lon FROM VALUES (17179869183L), (17179869184L) AS t(id)")
    point = windows.last_in_store_point("5 minutes", "id", "transaction_time")
    assert rows.agg(*point).first()[:] == (17179869184.0, 17179869184.0)


def test_ties_of_updates_have_one_outcome(spark):
    rows = [("k", 1, "x"), ("k", 1, "y")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, d int, v string").coalesce(1)
        assert latest_per_key(df, ["k"], ["d"]).first().v == "y"


def test_products_of_pair_counts_over_a_long(spark, monkeypatch):
    pairs = spark.createDataFrame([("a", "b", 4_000_000_000), ("b", "", 4_000_000_000)], "a string, b string, n_ab long")
    monkeypatch.setattr(corpus, "_pair_counts", lambda docs, tokens: pairs)
    row = corpus.bigram_scores(pairs, threshold=0).first()
    assert row.n_a == row.n_b == 4_000_000_000 and 0 < row.score < 1


def test_scores_are_the_same_in_the_row_and_by_join(spark):
    messages = spark.createDataFrame(
        [("m", ["a", "b", "b"]), ("m", ["w9"]), ("n", []), ("o", ["none"]), ("p", ["w1", "w1", "w2"])],
        "message_id string, tokens array<string>")
    rows = [(str(i % 105), f"w{i}", i % 7) for i in range(10_500)] + [("7", "b", 400), ("3", "b", 400), ("105", "a", 900)]
    weights = spark.createDataFrame(rows, "topic_id string, word string, thousandths long")
    want = [("m", "105", 900, 2500), ("m", "9", 2, 2), ("n", "0", 0, 0), ("o", "0", 0, 0), ("p", "1", 2, 4)]
    assert sorted(map(tuple, classify.keyword_scores(messages, weights).collect())) == want
    few = weights.where("word in ('a', 'b', 'w0', 'w1', 'w2', 'w9')")
    for limit in (0, 1000):
        assert sorted(map(tuple, classify.keyword_scores(messages, few, in_row=limit).collect())) == want


def test_scoring_a_large_table_does_not_shuffle(spark):
    messages = classify.with_tokens(standin.messages(spark, SF))
    weights = spark.createDataFrame([("105", "a", 500)], "topic_id string, word string, thousandths long")
    plan = classify.keyword_scores(messages, weights)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("regexp_extract_all") == 1


def test_more_than_two_thousand_topic_words(spark):
    docs = spark.createDataFrame([(["w1", "w2", "x"],), (["w2"],)], "tokens array<string>")
    words = spark.createDataFrame([(i // 10, f"w{i}") for i in range(2500)], "topic int, word string")
    counts = coherence.window_counts(docs, words)
    got = {(r.a, r.b): r.n for r in counts.collect()}
    assert got == {(None, None): 2, ("w1", "w1"): 1, ("w2", "w2"): 2, ("w1", "w2"): 1}
    pairs = coherence.npmi_pairs(words, counts)
    assert pairs.count() == 25_000 and pairs.where("word = 'w3' and npmi = 0").count() == 10
    assert coherence.coherence_by_topic(pairs).count() == 250
