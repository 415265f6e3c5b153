"""Reading named tables, and spreading inputs that arrive in too few pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

SCHEMAS = {"events": EVENTS, "documents": DOCUMENTS}


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """A parquet table by name, with its declared schema (no footer is read to infer one)."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{directory.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Hash ``df`` over the cores if its scan has fewer partitions than there are cores.

    A single small file is read by one task, which would then do all the text
    work alone. A large table has more splits than cores and is left as it is:
    no shuffle of the raw rows. Hashing by key keeps a retried task's rows the same.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *key)
