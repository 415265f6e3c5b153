"""Readers and writers by format: record streams, JDBC tables, CSV files, keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlens.functions.records import encode
from eventlens.operators.upsert import latest_per_key

# --- record streams: one text value per row ---------------------------------


def kafka_source_options(servers: str, topic: str, group_id: str | None = None,
                         start: str = "latest", max_per_trigger: int | None = None) -> dict:
    """Options of a Kafka source; ``start`` only counts until a checkpoint exists."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": start, "failOnDataLoss": "true"}
    if group_id:
        options["kafka.group.id"] = group_id
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_sink_options(servers: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_record_stream(spark: SparkSession, fmt: str, options: dict,
                       path: str | None = None) -> DataFrame:
    """A streaming frame with the record text in ``value``.

    Kafka delivers bytes, files of text deliver lines; the rest of a job is the
    same. Files must be ordered in time, or the watermark drops later ones' rows.
    """
    stream = spark.readStream.format(fmt).options(**options).load(path)
    return stream.select(F.col("value").cast("string").alias("value"))


def write_record_stream(df: DataFrame, fmt: str, options: dict, checkpoint: str,
                        trigger: dict, path: str | None = None, key: str | None = None):
    """Write each row as a JSON record; ``key`` becomes the Kafka message key."""
    columns = [F.col(key).cast("string").alias("key")] if key and fmt == "kafka" else []
    writer = (df.select(*columns, encode(*df.columns).alias("value")).writeStream
              .format(fmt).options(**options).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(**trigger))
    return writer.start(path) if path else writer.start()


# --- JDBC tables ------------------------------------------------------------


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    user: str = ""
    password: str = ""
    driver: str = ""

    def options(self) -> dict:
        given = {"url": self.url, "dbtable": self.table, "user": self.user,
                 "password": self.password, "driver": self.driver}
        return {k: v for k, v in given.items() if v}


def jdbc_read_options(table: JdbcTable, column: str | None = None, lower=None, upper=None,
                      partitions: int = 1, fetch: int = 10_000) -> dict:
    """Options of a JDBC scan, split by ranges of a number, date or timestamp column.

    Without a column the whole table comes through one connection, which only
    suits a dimension. The bounds set the stride; rows outside them are read too.
    """
    options = {**table.options(), "fetchsize": str(fetch)}
    if column is not None:
        if lower is None or upper is None or partitions < 2:
            raise ValueError("a split scan needs lower, upper and partitions >= 2")
        options |= {"partitionColumn": column, "lowerBound": str(lower),
                    "upperBound": str(upper), "numPartitions": str(partitions)}
    return options


def read_jdbc(spark: SparkSession, table: JdbcTable, **split) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_read_options(table, **split)).load()


def merge_statement(target: str, staging: str, columns: Sequence[str],
                    key: Sequence[str]) -> str:
    """One SQL MERGE that makes ``target`` hold the staging rows, by key."""
    rest = [c for c in columns if c not in key]
    on = " AND ".join(f"t.{k} = s.{k}" for k in key)
    update = (f"WHEN MATCHED THEN UPDATE SET {', '.join(f'{c} = s.{c}' for c in rest)} "
              if rest else "")
    return (f"MERGE INTO {target} t USING {staging} s ON {on} {update}"
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) "
            f"VALUES ({', '.join(f's.{c}' for c in columns)})")


def upsert_jdbc(df: DataFrame, target: JdbcTable, staging: str, key: Sequence[str],
                order: Sequence[str], execute: Callable[[str], None]) -> None:
    """Executors write the batch's last rows to a staging table, then one MERGE applies it.

    ``execute`` runs a statement in the target's database. A replay overwrites
    the staging table and merges the same rows again.
    """
    rows = latest_per_key(df, key, order)
    options = {**target.options(), "dbtable": staging, "truncate": "true"}
    rows.write.format("jdbc").options(**options).mode("overwrite").save()
    execute(merge_statement(target.table, staging, rows.columns, key))


# --- keyed table of files ---------------------------------------------------


def upsert_files(df: DataFrame, batch_id: int, path: str, key: Sequence[str],
                 order: Sequence[str]) -> None:
    """Write a batch's last rows into the batch's own folder.

    The cost is the batch's, not the table's, and a replayed batch replaces
    itself. :func:`read_upserted` gives each key's row of its latest batch.
    """
    (latest_per_key(df, key, order).write.mode("overwrite")
        .parquet(f"{path}/batch_id={batch_id}"))


def read_upserted(spark: SparkSession, path: str, schema: T.StructType,
                  key: Sequence[str]) -> DataFrame:
    stored = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(stored).parquet(path)
    return latest_per_key(rows, key, ["batch_id"]).drop("batch_id")


# --- CSV files --------------------------------------------------------------

CSV = {"header": "true", "escape": '"', "quote": '"'}


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with header in a folder, replacing an older one."""
    df.write.mode("overwrite").options(**CSV).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with header; quoted values may hold line ends. The schema is declared, not inferred.

    An unquoted nothing is NULL, a quoted one is empty text: the marker keeps Spark
    from taking both for NULL. Values with line ends make a file one task here:
    :func:`eventlens.sources.csv_split.read_csv_split` reads a large one by blocks.
    """
    return (spark.read.schema(schema)
            .options(**CSV, multiLine="true", emptyValue="", nullValue=r"\N").csv(path))
