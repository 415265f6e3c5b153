"""Classify messages by topic and look up the topic's label."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlens.functions import text
from eventlens.operators.corpus import lemmas
from eventlens.operators.joins import fits, lookup_join
from eventlens.schemas import MESSAGE_TOPICS, conform
from eventlens.session import cut_lineage

MAX_WEIGHTS = 10_000        # (topic, word) rows that may be broadcast
IN_ROW = 1_000              # (topic, word) rows that become constants of an expression


def with_tokens(messages: DataFrame, deaccent: bool = True, stop: bool = True) -> DataFrame:
    """Messages with a subject, plus its ``tokens``. Only a NULL subject is left out."""
    words = text.tokens(F.col("message_subject"), deaccent)
    if stop:
        words = text.without_stopwords(words)
    return messages.where(F.col("message_subject").isNotNull()).withColumn("tokens", words)


def serving_tokens(messages: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(message_id, tokens) in the serving order: lemmas first, stopwords after, no
    collocations and no part-of-speech filter."""
    spelled = with_tokens(messages, stop=False).select("message_id", "tokens")
    return lemmas(spelled, lexicon, "message_id", allowed_pos=None).withColumn(
        "tokens", text.without_stopwords(F.col("tokens")))


def topic_weights(dim_topics: DataFrame) -> DataFrame:
    """(topic_id, word, thousandths) from the dimension's weighted-word text."""
    return dim_topics.select(
        F.col("id").alias("topic_id"),
        F.inline(text.weighted_words(F.col("topic_weigh")))).select(
        "topic_id", "word", "thousandths")


def keyword_scores(messages: DataFrame, weights: DataFrame, *carry: str,
                   in_row: int = IN_ROW) -> DataFrame:
    """One row per message: ``topic_id``, ``score`` and ``total`` in thousandths.

    A topic's score is the sum of its words' weights over the message's tokens,
    in whole thousandths, so that no order of addition can change it. The
    highest score wins, on a tie the lower id; a message without any weighted
    word ties at zero and gets the lowest id. ``carry`` columns ride along.
    Rows that share a message_id keep their own scores.

    A row's scores come out of a generator: Spark would else move a later test of the topic, as
    a join with a filtered dimension makes one, below the scoring and write the whole scoring
    into it, lists taken anew for each of their elements.

    Up to ``in_row`` weights become constants of the expression and every message is
    scored in its own row, without a shuffle. More are joined to the distinct
    token lists; the rows are the same.
    """
    scored = (scores_in_row(messages, weights) if fits(weights, in_row)
              else scores_by_join(messages, weights))
    found = F.struct(F.col("_topic").cast("string").alias("topic_id"), "score", "total")
    return scored.select("message_id", *carry, F.inline_outer(F.array(found)))


def scores_in_row(messages: DataFrame, weights: DataFrame) -> DataFrame:
    """``messages`` with ``_topic``, ``score`` and ``total``, by array functions over the tokens."""
    by_word: dict[str, list[dict]] = {}
    ids = []
    for row in weights.collect():
        ids.append(int(row.topic_id))
        by_word.setdefault(row.word, []).append({"t": ids[-1], "w": row.thousandths})
    constants = F.from_json(F.lit(json.dumps(by_word)), "map<string,array<struct<t:int,w:bigint>>>")
    found = messages.withColumn("_found", F.sort_array(F.filter("tokens", lambda t: t.isin(*by_word))))
    # equal words are neighbours: each distinct one is looked up once, however often it occurs
    f, starts = F.col("_found"), F.col("_starts")
    found = found.withColumn("_starts", F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(f) - 1, F.lit(0))),
        lambda i: (i < F.size(f)) & ((i == 0) | (F.get(f, i) != F.get(f, i - 1)))))
    hits = found.withColumn("_hits", F.sort_array(F.flatten(F.transform(starts, lambda at, j: F.transform(
        F.element_at(constants, F.get(f, at)), lambda h: F.struct(h["t"].alias("t"), (
            h["w"] * (F.coalesce(F.get(starts, j + 1), F.size(f)) - at)).alias("w")))))))
    # One pass by topic: weights are never negative, so a sum that passes the best so far stays above
    # it, and an equal one leaves the lower id.
    nothing = F.expr("named_struct('t', cast(null as int), 's', 0L, 'best', cast(null as int), 'top', -1L, 'total', 0L)")

    def add(state, h):
        s = F.when(state["t"] == h["t"], state["s"]).otherwise(F.lit(0).cast("long")) + h["w"]
        more = s > state["top"]
        return F.struct(h["t"].alias("t"), s.alias("s"), F.when(more, h["t"]).otherwise(state["best"]).alias("best"),
                        F.when(more, s).otherwise(state["top"]).alias("top"), (state["total"] + h["w"]).alias("total"))
    best = hits.withColumn("_best", F.aggregate("_hits", nothing, add))
    return best.select(
        *messages.columns, F.coalesce("_best.best", F.lit(min(ids, default=None))).alias("_topic"),
        F.greatest(F.coalesce("_best.top", F.lit(0)), F.lit(0)).alias("score"),
        F.coalesce("_best.total", F.lit(0)).alias("total"))


def scores_by_join(messages: DataFrame, weights: DataFrame) -> DataFrame:
    """The same for any number of weights: distinct token lists are taken apart, joined to the
    words by size-checked lookup, added up, and joined back by the list's hash."""
    own = messages.withColumn("_list", F.sha2(F.array_join("tokens", " "), 256))
    spelled = cut_lineage(own.select("_list", "tokens").dropDuplicates(["_list"])
                          .select("_list", F.explode("tokens").alias("_word"))
                          .groupBy("_list", "_word").agg(F.count(F.lit(1)).alias("_n")))
    by_word = cut_lineage(weights.groupBy(F.col("word").alias("_word")).agg(F.collect_list(
        F.struct(F.col("topic_id").cast("int").alias("t"), F.col("thousandths").alias("w"))).alias("_topics")))
    per_topic = (lookup_join(spelled, by_word, ["_word"], ["_list"])
                 .select("_list", "_n", F.inline("_topics").alias("_t", "_w"))
                 .groupBy("_list", "_t").agg(F.sum(F.col("_n") * F.col("_w")).alias("_s")))
    # score and id in one number with room for any id: the highest score, then the lowest id
    ranked = F.col("_s").cast("decimal(20,0)") * F.expr(f"{1 << 32}BD") - F.col("_t")
    best = per_topic.groupBy("_list").agg(F.max_by("_t", ranked).alias("_best"),
                                          F.max("_s").alias("_top"), F.sum("_s").alias("_total"))
    lowest = weights.agg(F.min(F.col("topic_id").cast("int"))).first()[0]
    return own.join(best, "_list", "left").select(
        *messages.columns, F.coalesce("_best", F.lit(lowest)).alias("_topic"),
        F.coalesce("_top", F.lit(0)).alias("score"), F.coalesce("_total", F.lit(0)).alias("total"))


def topic_lookup(topics: DataFrame, dim_topics: DataFrame) -> DataFrame:
    """Inner lookup of the topic's label: an id the dimension lacks drops the message.

    Ids are unique VARCHAR(2) values, which bounds the broadcast side; it is checked.
    """
    dim = dim_topics.select("id", F.col("topic").alias("topic_name"))
    dim = F.broadcast(dim) if fits(dim, MAX_WEIGHTS) else dim
    return topics.join(dim, F.col("topic_id") == F.col("id"), "inner").drop("id")


def to_message_topics(looked_up: DataFrame, *carry: str) -> DataFrame:
    """The sink's columns: the query's topic_id and topic_name under the sink's names.
    ``carry`` columns come after them."""
    named = (looked_up.withColumn("topic", F.col("topic_id"))
             .withColumn("topic_description", F.col("topic_name")))
    if not carry:
        return conform(named, MESSAGE_TOPICS)
    carried = [named.schema[c] for c in carry]
    return conform(named, T.StructType([*MESSAGE_TOPICS.fields, *carried]))


def classified_messages(messages: DataFrame, weights: DataFrame,
                        dim_topics: DataFrame) -> DataFrame:
    """Not-null filter, topic of the subject, label lookup: the rows of the keyed sink."""
    topics = keyword_scores(with_tokens(messages), weights, "message_date", "message_from_name")
    return to_message_topics(topic_lookup(topics, dim_topics))


def classified_by_function(messages: DataFrame, dim_topics: DataFrame, function: str) -> DataFrame:
    """The same rows by a registered function from text to topic id."""
    topics = (messages.where(F.col("message_subject").isNotNull())
              .withColumn("topic_id", F.call_function(function, F.col("message_subject"))))
    return to_message_topics(topic_lookup(topics, dim_topics))


def with_processing_time(messages: DataFrame) -> DataFrame:
    return messages.withColumn("proc_time", F.current_timestamp())


# --- user models as a vectorised function ---------------------------------

Predict = Callable[[pd.Series], pd.Series]


def topic_udf(load: Callable[[], Predict]):
    """A string-to-string function over Arrow batches.

    ``load`` runs once per task and returns the model's batch prediction. The
    result is marked nondeterministic so that a filter or a join on it does not
    make Spark evaluate the model a second time.
    """
    def predict_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for subjects in batches:
            yield predict(subjects)
    predict_batches.__annotations__ = {"batches": Iterator[pd.Series],
                                       "return": Iterator[pd.Series]}
    return F.pandas_udf(predict_batches, "string").asNondeterministic()


def keyword_model(weights: DataFrame, max_weights: int = MAX_WEIGHTS) -> Callable[[], Predict]:
    """A loader for :func:`topic_udf` that scores by the weights. Every task holds them, so
    their number is checked; :func:`keyword_scores` takes any number."""
    if not fits(weights, max_weights):
        raise ValueError(f"more than {max_weights} topic words: use keyword_scores, or raise max_weights")
    by_word: dict[str, list[tuple[int, int]]] = {}
    ids = []
    for row in weights.collect():
        by_word.setdefault(row.word, []).append((int(row.topic_id), row.thousandths))
        ids.append(int(row.topic_id))
    lowest = min(ids)

    def load() -> Predict:
        def topic(words) -> str:
            scores: dict[int, int] = {}
            for w in words:
                for t, weight in by_word.get(w, ()):
                    scores[t] = scores.get(t, 0) + weight
            return str(min(scores, key=lambda t: (-scores[t], t))) if scores else str(lowest)
        return lambda batch: batch.map(topic)
    return load


def register_class_topic(spark: SparkSession, weights: DataFrame,
                         name: str = "CLASS_TOPIC") -> None:
    """Register ``CLASS_TOPIC(text)`` for SQL.

    Tokens are made by SQL expressions in the JVM; only they go to the Python
    function, which scores them.
    """
    spark.udf.register(f"{name}_OF_TOKENS", topic_udf(keyword_model(weights)))
    spark.sql(f"create or replace temporary function {name}(subject string) returns string "
              f"return {name}_OF_TOKENS({text.tokens_sql('subject')})")
