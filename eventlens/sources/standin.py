"""Views over the test tables that stand in for the transactions and messages.

The jobs' own inputs are not public, so ``events`` plays the transactions and
``documents`` the messages. Every row and every whole text is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.sources.tables import read_table, spread

EPOCH_MICROS = 1704067200000000     # 2024-01-01 00:00:00 UTC
SQUEEZE = 720                       # 30 days of events become one hour


def as_transactions(events: DataFrame, time) -> DataFrame:
    even = F.col("event_id") % 2 == 0
    return events.select(
        "event_id",
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("customer"),
        F.col("event_type").alias("transaction_type"),
        F.when(even, F.col("value")).otherwise(0.0).alias("online_payment_amount"),
        F.when(~even, F.col("value")).otherwise(0.0).alias("in_store_payment_amount"),
        (F.lit(44.57) + ((F.col("event_id") * 37) % 341) / F.lit(1000.0)).alias("lat"),
        (F.lit(20.20) + ((F.col("event_id") * 53) % 431) / F.lit(1000.0)).alias("lon"),
        time.alias("transaction_datetime"),
    )


def transactions_raw(spark: SparkSession, directory: str) -> DataFrame:
    """``events`` as transactions at their own times, for the ten-hour windows."""
    return as_transactions(read_table(spark, directory, "events"),
                         F.col("ts").cast("timestamp"))


def squeezed_time():
    return F.expr(f"timestamp_micros({EPOCH_MICROS} + "
                  f"(unix_micros(cast(ts as timestamp)) - {EPOCH_MICROS}) div {SQUEEZE})")


def transactions(spark: SparkSession, directory: str) -> DataFrame:
    """As above with the month squeezed into an hour, so that five-minute windows fill."""
    return as_transactions(read_table(spark, directory, "events"), squeezed_time())


def transactions_as_arrived(spark: SparkSession, directory: str) -> DataFrame:
    """Transactions with an arrival offset that shuffles every 2000 neighbours."""
    e = F.col("event_id")
    return (transactions(spark, directory)
            .withColumn("arrival_offset", F.expr("event_id div 2000") * 2000 + (e * 37) % 2000))


def messages(spark: SparkSession, directory: str) -> DataFrame:
    """``documents`` as messages; the subject is the whole text."""
    doc = F.col("doc_id")
    docs = read_table(spark, directory, "documents")
    return docs.select(
        doc.cast("string").alias("message_id"),
        F.expr("timestampadd(MINUTE, cast((doc_id * 97) % 40320 as int), "
               "timestamp'2024-01-01 00:00:00')").alias("message_date"),
        F.when(doc % 4 != 0, (doc - 1).cast("string")).alias("message_in_reply_to"),
        F.when(doc % 50 == 3, F.lit("")).otherwise(F.col("source")).alias("message_from_name"),
        F.concat("source", F.lit("@example.org")).alias("message_from_email"),
        F.col("text").alias("message_subject"),
        F.col("source").alias("author_group"),
    )


def spread_messages(spark: SparkSession, directory: str) -> DataFrame:
    """Messages in enough partitions for the text work."""
    return spread(messages(spark, directory), "message_id")
