"""Topic model: training by :mod:`online` or :mod:`em`, inference and report on Spark ML's LDA model."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.operators.corpus import vocabulary
from eventlens.operators.ranking import first_argmax, number_rows
from eventlens.plans import em, online
from eventlens.session import cut_lineage_in_place, passing_tables


@dataclass(frozen=True)
class Training:
    """Settings of the training job.

    Fixed values: 22 topics, seed 100, 10 passes, an update every 1000
    documents, learned document prior, shares below 0.01 not listed.

    The schedule is the same at every size: in each of ``passes`` every document is
    used once, in the order of the keys, and an update follows every ``chunk`` of
    them. ``optimizer="em"`` is another method, which has no chunks and learns no
    prior: all documents at once in each of ``passes`` iterations.

    The dictionary holds all words that occur in at least ``min_doc_freq``
    documents, and in at least the share ``min_doc_share`` of them. It and the model,
    topics x words, are on the driver. A share bounds both at every size: if a
    document has L distinct words on average, at most L / share words pass. Without
    one the caller raises the number for a large corpus.
    """
    topics: int = 22
    seed: int = 100
    passes: int = 10
    chunk: int = 1000
    optimizer: str = "online"
    min_doc_freq: int = 1
    min_doc_share: float = 0.0
    docs_per_partition: int = 50_000
    min_share: float = 0.01

    def schedule(self, documents: int) -> tuple[int, float]:
        """(updates, share of the documents in each)."""
        per_pass = max(math.ceil(documents / self.chunk), 1)
        return per_pass * self.passes, 1.0 / per_pass

    def least(self, documents: int) -> int:
        """Documents in which a word of the dictionary must occur."""
        return max(self.min_doc_freq, math.ceil(self.min_doc_share * documents))

    def partitions(self, documents: int) -> int:
        """By the number of documents, not of cores, so that a seed draws the same anywhere."""
        return max(math.ceil(documents / self.docs_per_partition), 8)


def dictionary(docs: DataFrame, min_doc_freq: int = 1, tokens: str = "tokens") -> list[str]:
    """The model's words, most frequent first, then by name: the same for the same corpus."""
    words = vocabulary(docs, tokens).where(F.col("doc_freq") >= min_doc_freq)
    ordered = words.orderBy(F.desc("term_freq"), F.asc("token")).select("token")
    return ordered.toArrow().column(0).to_pylist()


def _bagger(spark: SparkSession, words: list[str], tokens: str) -> CountVectorizerModel:
    """The dictionary as a model: its words go to the JVM as one text, not one by one."""
    if not words or any(not w or "\0" in w for w in words):
        return CountVectorizerModel.from_vocabulary(words, inputCol=tokens, outputCol="bag")
    split = spark._jvm.org.apache.commons.lang3.StringUtils.splitPreserveAllTokens("\0".join(words), "\0")
    model = CountVectorizerModel._create_from_java_class("org.apache.spark.ml.feature.CountVectorizerModel", split)
    return model._set(inputCol=tokens, outputCol="bag", vocabSize=len(words))


def train(docs: DataFrame, key: str, settings: Training = Training(),
          tokens: str = "tokens") -> PipelineModel:
    """Dictionary, bag of words and LDA as one model that can be saved and loaded.

    The bags of words are written once to the shared folder: the updates read
    them again and again, and must not tokenise again or lose them with an
    executor. They are numbered, or laid out, by key, so that a seed gives the same
    model in every run.
    """
    if settings.optimizer not in ("online", "em"):
        raise ValueError(f"optimizer={settings.optimizer!r}")
    documents = docs.count()
    words = dictionary(docs, settings.least(documents), tokens)
    bagger, size = _bagger(docs.sparkSession, words, tokens), len(words)
    bags = bagger.transform(docs).select(key, "bag")
    if settings.optimizer == "online":
        with passing_tables():
            numbered = number_rows(bags, [key], "_number").select("_number", "bag")
            return PipelineModel([bagger, online.fit(numbered, documents, size, settings.topics, settings.passes,
                                                     settings.chunk, settings.seed)])
    laid = cut_lineage_in_place(bags.repartition(settings.partitions(documents), key).sortWithinPartitions(key))
    return PipelineModel([bagger, em.fit(laid, size, settings.topics, settings.passes, settings.seed)])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _lda(model: PipelineModel):
    return model.stages[-1]


def describe_topics(spark: SparkSession, model: PipelineModel, words: int = 10) -> DataFrame:
    """(topic, rank, word, weight): k x ``words`` rows, however large the vocabulary is."""
    vocabulary = model.stages[0].vocabulary
    rows = [(t.topic, r + 1, vocabulary[i], float(w))
            for t in _lda(model).describeTopics(words).collect()
            for r, (i, w) in enumerate(zip(t.termIndices, t.termWeights))]
    return spark.createDataFrame(rows, "topic int, rank int, word string, weight double")


def topic_listing(described: DataFrame) -> DataFrame:
    """(topic, listing): ``0.144*"word" + …`` per topic."""
    listed = described.groupBy("topic").agg(
        F.sort_array(F.collect_list(F.struct("rank", "weight", "word"))).alias("_w"))
    text = F.transform("_w", lambda w: F.format_string('%.3f*"%s"', w["weight"], w["word"]))
    return listed.select("topic", F.array_join(text, " + ").alias("listing"))


def distributions(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """Documents with ``shares``: the probability of each topic, in topic order.

    A document without known tokens, to which Spark gives zeros, has the learned prior.
    """
    prior = _lda(model).estimatedDocConcentration().toArray()
    learned = F.array(*[F.lit(float(p)) for p in prior / prior.sum()])
    shares = vector_to_array("topicDistribution")
    return (model.transform(docs)
            .withColumn("shares", F.when(F.array_max(shares) > 0, shares).otherwise(learned))
            .drop("bag", "topicDistribution"))


def document_topics(docs: DataFrame, model: PipelineModel, key: str,
                    min_share: float = Training.min_share) -> DataFrame:
    """(key, topic, share) for every topic of a document with at least ``min_share``.

    The outer form keeps Spark from testing the shares' size below the generator, which would
    infer every document a second time.
    """
    return (distributions(docs, model)
            .select(key, F.posexplode_outer("shares").alias("topic", "share"))
            .where(F.col("share") >= min_share))


def classify(docs: DataFrame, model: PipelineModel, *keep: str) -> DataFrame:
    """(keep…, topic_id, share): the most probable topic, the lower id on a tie."""
    known = distributions(docs, model)
    best = first_argmax(F.col("shares"))
    return known.select(*keep, best.cast("string").alias("topic_id"),
                        F.array_max("shares").alias("share"))


def report(docs: DataFrame, model: PipelineModel, key: str, tokens: str = "tokens",
           words: int = 10) -> DataFrame:
    """(key, dominant_topic, topic_perc_contrib, keywords, text) for every document."""
    described = describe_topics(docs.sparkSession, model, words)
    listed = described.groupBy("topic").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("_w"))
    # one row per topic of the model
    named = F.broadcast(listed.select(F.col("topic").alias("dominant_topic"),
                                      F.array_join(F.col("_w.word"), ", ").alias("keywords")))
    topics = classify(docs, model, key, tokens)
    # every document has a topic of the model; an inner join would test that for null below the
    # inference, and so infer twice
    return (topics.withColumn("dominant_topic", F.col("topic_id").cast("int"))
            .join(named, "dominant_topic", "left")
            .select(key, "dominant_topic", F.round("share", 4).alias("topic_perc_contrib"),
                    "keywords", F.col(tokens).alias("text")))


def _digamma(x: np.ndarray) -> np.ndarray:
    """The derivative of the logarithm of the gamma function, for positive numbers."""
    x, total = np.array(x, np.float64), np.zeros(np.shape(x))
    for _ in range(10):
        small = x < 10
        total -= np.where(small, 1 / x, 0.0)
        x = np.where(small, x + 1, x)
    y = 1 / (x * x)
    return total + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.lgamma, np.ravel(x)), np.float64, np.size(x)).reshape(np.shape(x))


def _bounds(shared) -> Callable:
    """For mapInArrow: (bag, topicDistribution) of documents to (bound, tokens), one row for a batch.

    A document's variational parameters add up to the prior's sum and its tokens, so the
    shares that Spark inferred give them back.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word, prior = shared.value
        for batch in batches:
            bags, shares = batch.column(0), batch.column(1).field("values")
            indices, counts = bags.field("indices"), bags.field("values")
            sizes = np.diff(np.asarray(indices.offsets))
            word, count = np.asarray(indices.flatten()), np.asarray(counts.flatten())
            owner = np.repeat(np.arange(len(sizes)), sizes)
            word, count, owner = (c[count != 0] for c in (word, count, owner))
            tokens = np.bincount(owner, count, len(sizes))
            has = tokens > 0        # the others have no part in the bound
            gamma = np.asarray(shares.flatten()).reshape(len(sizes), -1) * (prior.sum() + tokens)[:, None]
            gamma[~has] = 1.0
            by_topic = _digamma(gamma) - _digamma(gamma.sum(axis=1))[:, None]
            own = ((prior - gamma) * by_topic + _lgamma(gamma) - _lgamma(prior)).sum(axis=1)
            own += math.lgamma(prior.sum()) - _lgamma(gamma.sum(axis=1))
            bound = own[has].sum()
            for i in range(0, len(word), em.ENTRIES):
                at = slice(i, i + em.ENTRIES)
                logs = by_topic[owner[at]] + by_word[word[at]]
                top = logs.max(axis=1)
                bound += count[at] @ (top + np.log(np.exp(logs - top[:, None]).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([pa.array([float(bound)]), pa.array([float(tokens.sum())])], ["bound", "tokens"])
    return run


def log_perplexity(docs: DataFrame, model: PipelineModel) -> float:
    """Upper bound on the log perplexity of ``docs`` under the model (Hoffman, Blei, Bach 2010).

    Spark's own ``logPerplexity`` takes the exponential of the whole matrix of words for every
    document. This one lets the model infer each document once, from the random start of all its
    inference (Spark's own adds the row's number to the seed), and adds up the bound's parts by batch.
    """
    lda = _lda(model)
    words = lda.topicsMatrix().toArray()
    prior = lda.estimatedDocConcentration().toArray()
    eta = lda._call_java("getEffectiveTopicConcentration")
    by_word = _digamma(words) - _digamma(words.sum(axis=0))
    shared = docs.sparkSession.sparkContext.broadcast((by_word, prior))
    inferred = model.transform(docs).select("bag", "topicDistribution")
    total = inferred.mapInArrow(_bounds(shared), "bound double, tokens double").agg(F.sum("bound"), F.sum("tokens")).first()
    shared.destroy()
    size = len(words)
    by_topic = ((eta - words) * by_word + _lgamma(words) - math.lgamma(eta)).sum() + (
        math.lgamma(eta * size) - _lgamma(words.sum(axis=0))).sum()
    return -(total[0] + by_topic) / total[1]
