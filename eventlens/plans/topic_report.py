"""The dominant-topic report: document number, topic, share, keywords, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventlens.functions.text import weighted_words_text
from eventlens.operators.joins import fits
from eventlens.plans.classify import MAX_WEIGHTS

# Words named per topic in the report and in the weight text.
REPORT_WORDS = 10
WEIGHT_WORDS = 5


def thousandths(n: Column, total: Column) -> Column:
    """n / total in thousandths, half up, in whole numbers."""
    return F.floor((n * 2000 + total) / (total * 2)).cast("long")


def share(part: Column, total: Column, digits: int = 4) -> Column:
    """part / total rounded half up, computed from whole numbers; 0 of nothing is 0."""
    scale = 10 ** digits
    return F.when(total > 0, F.floor((part * 2 * scale + total) / (total * 2)) / scale) \
            .otherwise(0.0)


def topic_words(top: DataFrame, topic: Column) -> DataFrame:
    """(topic_id, rank, word, thousandths) from ranked token counts of a topic's texts."""
    return top.select(topic.alias("topic_id"), "rank", F.col("token").alias("word"),
                      thousandths(F.col("n"), F.col("total")).alias("thousandths"))


def weight_text(words: DataFrame) -> DataFrame:
    """(topic_id, topic_weigh): the words by rank, as weighted-word text."""
    listed = words.groupBy("topic_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "thousandths", "word"))).alias("_w"))
    return listed.select("topic_id", weighted_words_text(F.col("_w")).alias("topic_weigh"))


def keywords(words: DataFrame) -> DataFrame:
    """(topic_id, keywords): the words by rank, joined by commas."""
    listed = words.groupBy("topic_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("_w"))
    return listed.select("topic_id", F.array_join(F.col("_w.word"), ", ").alias("keywords"))


def dominant_topics(scored: DataFrame, topic_keywords: DataFrame) -> DataFrame:
    """(message_id, dominant_topic, topic_perc_contrib, keywords) from keyword scores."""
    named = F.broadcast(topic_keywords) if fits(topic_keywords, MAX_WEIGHTS) else topic_keywords
    return scored.join(named, "topic_id").select(
        "message_id", F.col("topic_id").cast("int").alias("dominant_topic"),
        share(F.col("score"), F.col("total")).alias("topic_perc_contrib"), "keywords")


def with_text(report: DataFrame, docs: DataFrame, key: str = "message_id",
              tokens: str = "tokens") -> DataFrame:
    """Put each document's tokens beside its report row: joined by key, never by row order."""
    return report.join(docs.select(key, F.col(tokens).alias("text")), key)


def topic_sizes(report: DataFrame) -> DataFrame:
    return report.groupBy("dominant_topic").agg(F.count(F.lit(1)).alias("n"))
