import random

import numpy as np
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel

from eventlens.plans import em, topic_model
from eventlens.session import cut_lineage_in_place

rng = random.Random(11)
WORDS = [f"w{i}" for i in range(40)]
DOCS = [(f"d{i}", rng.choices(WORDS, k=rng.choice([0, 1, 5, 60]))) for i in range(120)]


def bags(spark):
    docs = spark.createDataFrame(DOCS, "id string, tokens array<string>")
    bagger = CountVectorizerModel.from_vocabulary(WORDS, inputCol="tokens", outputCol="bag")
    return cut_lineage_in_place(bagger.transform(docs).select("id", "bag").repartition(3, "id").sortWithinPartitions("id"))


def test_the_topics_are_those_of_sparks_own_training(spark, monkeypatch):
    monkeypatch.setattr(em, "ENTRIES", 100)
    rows = bags(spark)
    spark_lda = LDA(k=4, seed=7, optimizer="em", maxIter=6, featuresCol="bag").fit(rows).toLocal().setFeaturesCol("bag")
    mine = em.fit(rows, len(WORDS), 4, 6, 7)
    np.testing.assert_allclose(mine.topicsMatrix().toArray(), spark_lda.topicsMatrix().toArray(), rtol=1e-9)
    assert mine.estimatedDocConcentration() == spark_lda.estimatedDocConcentration()
    shares = [[r.topicDistribution.toArray() for r in m.transform(rows).orderBy("id").collect()] for m in (mine, spark_lda)]
    np.testing.assert_allclose(*shares, rtol=1e-9)


def test_java_random_goes_on_between_calls():
    some = em.JavaRandom(100)
    np.testing.assert_array_equal(np.concatenate([some.doubles(2), some.doubles(1)]), em.JavaRandom(100).doubles(3))


def test_training_sends_no_vector_along_each_edge(spark, tmp_path, monkeypatch):
    """Training by em does not go through Spark's graph."""
    monkeypatch.setattr(LDA, "fit", lambda *a: (_ for _ in ()).throw(AssertionError("trained by the graph")))
    docs = spark.createDataFrame(DOCS, "id string, tokens array<string>")
    model = topic_model.train(docs, "id", topic_model.Training(topics=3, passes=2, optimizer="em"))
    topic_model.save(model, str(tmp_path / "m"))
    loaded = topic_model.load(str(tmp_path / "m"))
    best = [{r.id: r.topic_id for r in topic_model.classify(docs, m, "id").collect()} for m in (model, loaded)]
    assert len(best[0]) == len(DOCS) and best[0] == best[1]
