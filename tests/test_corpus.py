import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eventlens.operators import corpus, joins, ranking

random.seed(1)
WORDS = ["hot"] * 12 + [f"w{i}" for i in range(8)]
DOCS = [(f"d{i}", [random.choice(WORDS) for _ in range(random.randrange(0, 40))])
        for i in range(60)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id string, tokens array<string>").repartition(4).cache()


def test_bag_of_words(docs):
    got = {(r.id, r.token): r.n for r in corpus.bag_of_words(docs, "id").collect()}
    assert got == {(d, t): n for d, ts in DOCS for t, n in Counter(ts).items()}


def test_vocabulary_ids_and_frequencies(docs):
    rows = corpus.number_vocabulary(corpus.vocabulary(docs)).collect()
    tf = Counter(t for _, ts in DOCS for t in ts)
    df = Counter(t for _, ts in DOCS for t in set(ts))
    ids = {t: i for i, t in enumerate(sorted(tf))}
    assert {(r.token, r.term_freq, r.doc_freq, r.token_id) for r in rows} == {
        (t, tf[t], df[t], ids[t]) for t in tf}


def test_unknown_tokens_are_dropped(spark, docs):
    numbered = spark.createDataFrame([("hot", 0)], "token string, token_id long")
    bag = corpus.encode_bag(corpus.bag_of_words(docs, "id"), "id", numbered)
    assert {(r.id, r.token_id, r.n) for r in bag.collect()} == {
        (d, 0, ts.count("hot")) for d, ts in DOCS if "hot" in ts}


def test_stats(docs):
    r = corpus.corpus_stats(docs).first()
    assert (r.documents, r.tokens, r.distinct_tokens) == (
        60, sum(len(ts) for _, ts in DOCS), len({t for _, ts in DOCS for t in ts}))


@pytest.mark.parametrize("min_count, threshold", [(0, 0.0), (0, 0.1), (5, 0.02)])
def test_scores_equal_brute_force(docs, min_count, threshold):
    words = Counter(t for _, ts in DOCS for t in ts)
    pairs = Counter(p for _, ts in DOCS for p in zip(ts, ts[1:]))
    size = len(words) + len(pairs)
    expected = {}
    for (a, b), n in pairs.items():
        score = (n - min_count) * size / (words[a] * words[b])
        if score > threshold:
            expected[a, b] = pytest.approx(score)
    got = {(r.a, r.b): r.score for r in
           corpus.bigram_scores(docs, min_count=min_count, threshold=threshold).collect()}
    assert expected and got == expected


def greedy(tokens, phrases):
    out, i = [], 0
    while i < len(tokens):
        if tuple(tokens[i:i + 2]) in phrases:
            out.append("_".join(tokens[i:i + 2]))
            i += 2
        else:
            out.append(tokens[i])
            i += 1
    return out


def test_merge_is_greedy_from_the_left(spark):
    df = spark.createDataFrame([("x", list("ababca")), ("y", list("aaaaa")), ("z", []), ("q", ["a"])],
                               "id string, tokens array<string>")
    phrases = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "a")], "a string, b string")
    got = {r.id: r.tokens for r in corpus.apply_bigrams(df, phrases, "id").collect()}
    assert got == {"x": ["a_b", "a_b", "c", "a"], "y": ["a_a", "a_a", "a"], "z": [], "q": ["a"]}


@pytest.mark.parametrize("max_rows", [joins.MAX_BROADCAST_ROWS, 0])
def test_merge_equals_brute_force(spark, docs, monkeypatch, max_rows):
    monkeypatch.setattr(corpus, "lookup_join",
                        lambda *a, **k: joins.lookup_join(*a, **k, max_rows=max_rows))
    phrases = {("hot", "hot"), ("w1", "hot"), ("hot", "w2"), ("w3", "w4")}
    table = spark.createDataFrame(sorted(phrases), "a string, b string")
    got = {r.id: r.tokens for r in corpus.apply_bigrams(docs, table, "id").collect()}
    assert got == {d: greedy(ts, phrases) for d, ts in DOCS}


@pytest.mark.parametrize("max_rows", [joins.MAX_BROADCAST_ROWS, 0])
@pytest.mark.parametrize("allowed", [corpus.CONTENT_POS, None])
def test_lemmas(spark, docs, monkeypatch, max_rows, allowed):
    monkeypatch.setattr(corpus, "lookup_join",
                        lambda *a, **k: joins.lookup_join(*a, **k, max_rows=max_rows))
    lexicon = {"hot": ("heat", "NOUN"), "w1": ("w", "DET"), "w2": ("w", "VERB")}
    table = spark.createDataFrame([(s, *v) for s, v in lexicon.items()],
                                  "surface string, lemma string, pos string")
    got = {r.id: r.tokens for r in corpus.lemmas(docs, table, "id", allowed_pos=allowed).collect()}
    def kept(t):
        return allowed is None or lexicon.get(t, (None, None))[1] in allowed
    assert got == {d: [lexicon.get(t, (t,))[0] for t in ts if kept(t)] for d, ts in DOCS}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_salted_lookup_equals_broadcast(spark, how):
    facts = spark.range(2000).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(
            (F.col("id") % 50).cast("string")).alias("k"))
    lookup = spark.createDataFrame([("hot", 1), ("3", 2), ("6", 3), ("none", 4)], "k string, v int")
    plain, salted = (sorted(map(tuple, joins.lookup_join(
        facts, lookup, ["k"], ["id"], how, max_rows=m).collect()), key=repr) for m in (100, 0))
    assert plain == salted and plain


def test_salts_split_a_hot_key(spark):
    facts = spark.range(10_000).select("id", F.lit("hot").alias("k"))
    lookup = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.lookup_join(facts, lookup, ["k"], ["id"], max_rows=0)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 10_000
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 4_000


def test_outer_lookup_is_refused(spark):
    df = spark.range(1).withColumn("k", F.lit("a"))
    with pytest.raises(ValueError):
        joins.lookup_join(df, df, ["k"], ["id"], how="full")


@pytest.mark.parametrize("partitions", [1, 5])
def test_number_rows(spark, partitions):
    keys = [f"k{random.randrange(10**6)}" for _ in range(500)]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i long").repartition(7)
    got = ranking.number_rows(df, ["k", "i"], "no", partitions).collect()
    order = sorted((k, i) for i, k in enumerate(keys))
    assert {(r.k, r.i): r.no for r in got} == {key: n for n, key in enumerate(order)}


def test_top_k_and_argmax(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 3, "w"), ("b", 1, "z")],
                               "g string, n int, t string")
    top = ranking.top_k_per_group(df, ["g"], [F.desc("n"), F.asc("t")], 2)
    assert sorted((r.g, r.t, r["rank"]) for r in top.collect()) == [("a", "w", 1), ("a", "y", 2), ("b", "z", 1)]
    p = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.0, 0.0, 0.0],)], "p array<double>")
    assert [r.x for r in p.select(ranking.first_argmax(F.col("p")).alias("x")).collect()] == [1, 0]
