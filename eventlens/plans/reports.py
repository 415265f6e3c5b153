"""Reports over classified messages: activity by week, and its largest topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from eventlens.functions.times import in_range, week_start
from eventlens.operators.ranking import top_k_per_group

# Series limit and row limits of the two charts and of the server.
SERIES = 5
ACTIVITY_ROWS = 50_000
TOPIC_ROWS = 10_000
SERVER_ROWS = 5_000


def weekly_activity(messages: DataFrame, date: str = "message_date") -> DataFrame:
    return (messages.groupBy(week_start(F.col(date)).alias("week"))
            .agg(F.count(F.lit(1)).alias("n")))


def activity_in_range(messages: DataFrame, start=None, end=None,
                      date: str = "message_date") -> DataFrame:
    """Weekly activity of start <= date < end."""
    return weekly_activity(messages.where(in_range(F.col(date), start, end)), date)


def weekly_topic_counts(classified: DataFrame) -> DataFrame:
    """Messages per week and topic label; topics that share a label are one series."""
    return (classified.groupBy(week_start(F.col("message_date")).alias("week"),
                               "topic_description")
            .agg(F.count(F.lit(1)).alias("n")))


def weekly_top_topics(classified: DataFrame, series: int = SERIES) -> DataFrame:
    """The ``series`` labels with most messages over all time, by week."""
    weekly = weekly_topic_counts(classified)
    # totals come from the weekly counts, so the messages are read once
    top = (weekly.groupBy("topic_description").agg(F.sum("n").alias("total"))
                 .orderBy(F.desc("total"), F.asc("topic_description")).limit(series))
    chosen = F.broadcast(top.select(F.col("topic_description").alias("_chosen")))
    # Null-safe, as a missing label is a series too. Inner, as Spark would push a semi join
    # below the count and classify twice; the chosen labels are distinct.
    return weekly.join(chosen, F.col("topic_description").eqNullSafe(F.col("_chosen"))) \
                 .drop("_chosen")


def top_within_week(classified: DataFrame, k: int = SERIES) -> DataFrame:
    """The ``k`` largest labels inside each week."""
    return top_k_per_group(weekly_topic_counts(classified), ["week"],
                           [F.desc("n"), F.asc("topic_description")], k)


def limited_activity(weekly: DataFrame, rows: int = ACTIVITY_ROWS,
                     server_rows: int = SERVER_ROWS) -> DataFrame:
    """Latest weeks first, within the chart's and the server's row limits."""
    return weekly.orderBy(F.desc("week")).limit(min(rows, server_rows))
