"""Declared schemas, and the checks that keep rows within them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

TRANSACTIONS = T.StructType([
    T.StructField("customer", T.StringType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("online_payment_amount", T.DoubleType()),
    T.StructField("in_store_payment_amount", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("transaction_datetime", T.TimestampType()),
])

TRANSACTION_RESULTS = T.StructType([
    T.StructField("customer", T.StringType()),
    T.StructField("count_transactions", T.DoubleType()),
    T.StructField("total_online_payment_amount", T.DoubleType()),
    T.StructField("total_in_store_payment_amount", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("last_transaction_time", T.TimestampType()),
])

MESSAGES = T.StructType([
    T.StructField("message_date", T.TimestampType()),
    T.StructField("message_id", T.StringType(), False),
    T.StructField("message_in_reply_to", T.StringType()),
    T.StructField("message_from_name", T.StringType()),
    T.StructField("message_from_email", T.StringType()),
    T.StructField("message_subject", T.StringType()),
])

DIM_TOPICS = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("topic", T.StringType()),
    T.StructField("topic_weigh", T.StringType()),
])

MESSAGE_TOPICS = T.StructType([
    T.StructField("message_id", T.StringType(), False),
    T.StructField("message_date", T.TimestampType()),
    T.StructField("message_from_name", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("topic_description", T.StringType()),
])

# Declared VARCHAR lengths of the topic tables.
DIM_TOPICS_LENGTHS = {"id": 2, "topic": 50, "topic_weigh": 100}
MESSAGE_TOPICS_LENGTHS = {"topic": 2, "topic_description": 50}


def key_violations(df: DataFrame, *key: str) -> DataFrame:
    """Keys held by more than one row, or NULL, with their number of rows."""
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) | has_null))


def length_violations(df: DataFrame, lengths: dict[str, int], *key: str) -> DataFrame:
    """One row per value longer than its declared length."""
    checks = F.array(*[
        F.when(F.length(c) > n,
               F.struct(F.lit(c).alias("column_name"), F.length(c).alias("actual_length"),
                        F.lit(n).alias("declared_length")))
        for c, n in lengths.items()
    ])
    return (df.select(*key, F.inline(F.filter(checks, lambda v: v.isNotNull()))))


def enforce_lengths(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Fail the job on the first value a VARCHAR(n) column could not hold."""
    def guarded(c: str, n: int):
        message = F.concat(F.lit(f"value too long for {c} VARCHAR({n}): "), F.col(c))
        return F.when(F.length(c) > n, F.raise_error(message).cast("string")).otherwise(F.col(c))
    return df.withColumns({c: guarded(c, n) for c, n in lengths.items()})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def describe_table(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, nullable) rows of a table's schema."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string, nullable boolean")
