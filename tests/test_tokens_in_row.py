"""Tokens counted, joined and looked up by batch, beside plain loops and the joins."""
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlens.operators import corpus
from eventlens.plans import artefact, topic_model

random.seed(5)
ODD = [("n1", None), ("e", []), (None, ["a", "b", "a", "b"]), ("h", [None, "a", None, "b", "a", "b"]), ("one", ["a"])]
DOCS = ODD + [(f"d{i}", [random.choice("aabbcdé") for _ in range(random.randrange(0, 30))]) for i in range(80)]
PAIRS = [("a", "b"), ("b", "a"), ("c", "c"), ("é", "d"), ("a", "zz")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(DOCS)], "id string, tokens array<string>, more int").repartition(3).cache()


def merged(tokens):
    out, i = [], 0
    while i < len(tokens):
        both = tuple(tokens[i:i + 2]) in PAIRS
        out.append("_".join(tokens[i:i + 2]) if both else tokens[i])
        i += 1 + both
    return out


def test_counts(docs):
    lists = [[x for x in t or []] for _, t in DOCS]
    df, tf = Counter(x for t in lists for x in set(t) if x), Counter(x for t in lists for x in t if x)
    assert {tuple(r) for r in corpus.vocabulary(docs).collect()} == {(x, df[x], tf[x]) for x in tf}
    pairs = Counter((x, y or "") for t in lists for x, y in zip(t, [*t[1:], ""]) if x)
    assert {(r.a, r.b): r.n_ab for r in corpus._pair_counts(docs, "tokens").collect()} == pairs


def test_the_empty_token_is_in_no_document(spark):
    docs = spark.createDataFrame([(["", "a", ""],), (["a"],), (["b", ""],)], "tokens array<string>")
    assert {tuple(r) for r in corpus.vocabulary(docs).collect()} == {("", 0, 3), ("a", 2, 2), ("b", 1, 1)}


def test_bigrams_in_the_row(spark, docs):
    table = spark.createDataFrame(PAIRS, "a string, b string")
    twice = docs.union(docs.where("id = 'd7'"))     # a key that repeats
    found = corpus.apply_bigrams(twice, table, "id")
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString() and found.columns == docs.columns
    want = {i: t if t is None or k is None else merged(t) for i, (k, t) in enumerate(DOCS)}
    assert {r.more: r.tokens for r in found.collect()} == want and found.count() == len(DOCS) + 1
    by_join = corpus._apply_bigrams_by_join(docs.where("tokens IS NOT NULL"), table, "id", "tokens")
    assert {r.more: r.tokens for r in by_join.collect()} == {i: t for i, t in want.items() if t is not None}
    none = corpus.apply_bigrams(docs, table.where("a = 'x'"), "id")
    assert {r.more: r.tokens for r in none.collect()} == {i: t for i, (_, t) in enumerate(DOCS)}


@pytest.mark.parametrize("allowed", [("NOUN",), None])
def test_lemmas_in_the_row_equal_the_join(spark, docs, allowed):
    table = spark.createDataFrame([("a", "A", "NOUN"), ("b", None, "NOUN"), ("c", "C", None), ("d", "D", "VERB"), (None, "N", "NOUN")],
                                  "surface string, lemma string, pos string")
    found = corpus.lemmas(docs, table, "id", allowed_pos=allowed)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    want = {r.id: r.tokens for r in corpus._lemmas_by_join(docs, table, "id", "tokens", allowed).collect()}
    assert {r.id: r.tokens for r in found.collect()} == want and len(want) == len(DOCS)
    # documents of one key stay one, their tokens by place
    again = docs.union(docs.where("id = 'd7'"))
    known = next(r for r in corpus.lemmas(again, table, "id", allowed_pos=allowed).collect() if r.id == "d7")
    assert known.tokens == [x for t in want["d7"] for x in (t, t)]
    twice = corpus.lemmas(docs, table.union(table.limit(1)), "id", allowed_pos=allowed)
    assert twice.count() == len(DOCS)


def test_each_document_is_inferred_once(spark):
    docs = spark.createDataFrame([(f"m{i}", ["x", "y"] * 3 if i % 2 else ["p", "q", "r"]) for i in range(40)], "id string, tokens array<string>")
    model = topic_model.train(docs, "id", topic_model.Training(topics=2, passes=2, optimizer="em"))

    def filters(df):
        return [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x and "UDF(" in x]
    shares, report = topic_model.document_topics(docs, model, "id"), topic_model.report(docs, model, "id", words=2)
    assert not filters(report) and {r.id for r in report.collect()} == {f"m{i}" for i in range(40)}
    assert not any("size(" in x for x in filters(shares)) and shares.count() == 80
    messages = spark.createDataFrame([("a", "x y"), ("b", None)], "message_id string, message_subject string").selectExpr(
        "*", "timestamp'2024-01-01' AS message_date", "'n' AS message_from_name")
    lexicon = spark.createDataFrame([("x", "x", "NOUN"), ("y", "y", "NOUN")], artefact.LexiconModel.SCHEMA)
    whole = artefact.train(messages.select("message_id", F.lit("xx yy").alias("message_subject")), lexicon.selectExpr(
        "concat(surface, surface) AS surface", "concat(lemma, lemma) AS lemma", "pos"),
        settings=topic_model.Training(topics=2, passes=2, optimizer="em"))
    found = artefact.classified_messages(messages, whole, spark.createDataFrame([("0", "t0", ""), ("1", "t1", "")], "id string, topic string, topic_weigh string"))
    assert not filters(found) and [r.message_id for r in found.collect()] == ["a"]


@pytest.mark.parametrize("allowed", [("X",), None])
def test_a_large_lexicon_is_looked_up_by_block(spark, docs, monkeypatch, allowed):
    table = spark.createDataFrame([("a", "A", "X"), ("b", None, "X"), ("c", "C", "Y"), ("d", "", "X"), (None, "no", "X")],
                                  "surface string, lemma string, pos string")
    own = docs.where("id IS NOT NULL").select("id", "tokens")
    want = {r.id: r.tokens for r in corpus.lemmas(own, table, "id", allowed_pos=allowed).collect()}
    monkeypatch.setattr(corpus, "MAX_BROADCAST_ROWS", 2)
    monkeypatch.setattr(corpus, "BLOCK_TOKENS", 40)

    def by_token(*_):
        raise AssertionError("every token is shuffled")
    monkeypatch.setattr(corpus, "_lemmas_by_join", by_token)
    found = corpus.lemmas(own, table, "id", allowed_pos=allowed).collect()
    assert {r.id: r.tokens for r in found} == want and len(found) == len(want)


# with a prior learnt below one, the random start decides between optima of a document
@pytest.mark.parametrize("optimizer, near", [("em", 1e-6), ("online", 1e-3)])
def test_perplexity_is_sparks_without_its_matrix_for_each_document(spark, monkeypatch, optimizer, near):
    docs = spark.createDataFrame([(f"m{i}", [random.choice("abcde" if i % 2 else "defghi") for _ in range(i % 30)]) for i in range(120)],
                                 "id string, tokens array<string>")
    model = topic_model.train(docs, "id", topic_model.Training(topics=3, passes=3, chunk=60, optimizer=optimizer))
    lda = model.stages[-1]
    want = lda.logPerplexity(model.stages[0].transform(docs))

    def by_document(*_):
        raise AssertionError("the matrix of words once for each document")
    monkeypatch.setattr(type(lda), "logPerplexity", by_document)
    assert topic_model.log_perplexity(docs, model) == pytest.approx(want, rel=near)
