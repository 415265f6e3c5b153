import random

import pytest

from eventlens.operators import coherence
from eventlens.plans import topic_model

random.seed(5)
THEMES = [["cat", "dog", "bird", "fish"], ["disk", "cpu", "ram", "bus"], ["red", "blue", "green", "pink"]]
DOCS = [(f"d{i}", random.choices(THEMES[i % 3], k=12)) for i in range(90)] + [("none", [])]
SETTINGS = topic_model.Training(topics=3, passes=5, chunk=30)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id string, tokens array<string>").repartition(4, "id")


@pytest.fixture(scope="module")
def model(docs):
    return topic_model.train(docs, "id", SETTINGS)


def answers(docs, model):
    return {r.id: (r.topic_id, round(r.share, 6)) for r in
            topic_model.classify(docs, model, "id").collect()}


def test_one_topic_per_document(docs, model):
    got = answers(docs, model)
    assert set(got) == {d for d, _ in DOCS}
    assert all(0 <= int(t) < 3 for t, _ in got.values())
    prior = list(model.stages[-1].estimatedDocConcentration())
    assert got["none"] == (str(prior.index(max(prior))), round(max(prior) / sum(prior), 6))
    sums = topic_model.distributions(docs.where("size(tokens) > 0"), model).selectExpr(
        "aggregate(shares, 0d, (a, x) -> a + x) s").collect()
    assert all(r.s == pytest.approx(1) for r in sums)


def test_themes_are_told_apart(docs, model):
    got = answers(docs, model)
    by_theme = [{got[f"d{i}"][0] for i in range(t, 90, 3)} for t in range(3)]
    assert all(len(s) == 1 for s in by_theme) and len(set.union(*by_theme)) == 3


def test_saved_model_gives_the_same(docs, model, tmp_path):
    topic_model.save(model, str(tmp_path / "m"))
    topic_model.save(model, str(tmp_path / "m"))
    assert answers(docs, topic_model.load(str(tmp_path / "m"))) == answers(docs, model)


def test_same_seed_same_model(docs, model):
    assert answers(docs, topic_model.train(docs, "id", SETTINGS)) == answers(docs, model)


def test_dictionary_is_ordered_and_whole(spark):
    df = spark.createDataFrame([(list("aaabbccd"),), (list("eb"),)], "tokens array<string>")
    assert topic_model.dictionary(df) == list("abcde")
    assert topic_model.dictionary(df, min_doc_freq=2) == ["b"]


def test_schedule_is_one_at_every_size():
    t = topic_model.Training()
    assert t.schedule(441) == (10, 1.0)
    for documents in (10_000, 10**10):
        updates, portion = t.schedule(documents)
        assert updates == documents // 1000 * t.passes and portion * documents == pytest.approx(1000)
    assert t.partitions(10) == 8 and t.partitions(10**9) == 20_000


def test_all_documents_in_each_iteration(docs):
    whole = topic_model.Training(topics=3, passes=15, optimizer="em")
    got = answers(docs, topic_model.train(docs, "id", whole))
    assert set(got) == {d for d, _ in DOCS} and all(0 <= int(t) < 3 for t, _ in got.values())


def test_report_and_listing(spark, docs, model):
    rows = topic_model.report(docs, model, "id", words=2).collect()
    assert len(rows) == len(DOCS) and all(len(r.keywords.split(", ")) == 2 for r in rows)
    assert {r.id: list(r.text) for r in rows} == dict(DOCS)
    listing = topic_model.topic_listing(topic_model.describe_topics(spark, model, 2)).collect()
    assert len(listing) == 3 and all(r.listing.count(" + ") == 1 for r in listing)
    shares = topic_model.document_topics(docs, model, "id").collect()
    assert all(r.share >= 0.01 for r in shares)


def test_scores_of_the_model(docs, model, spark):
    assert topic_model.log_perplexity(docs, model) > 0
    words = topic_model.describe_topics(spark, model, 4).select("topic", "word")
    assert 0.5 < coherence.coherence(docs, words).first().c_v <= 1.000001
