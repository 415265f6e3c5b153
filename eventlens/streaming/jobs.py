"""Transaction rules and message classification as Structured Streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from eventlens.functions.records import decode_or_quarantine, decode_strict
from eventlens.operators.versions import lookup_as_of
from eventlens.operators.windows import TIME
from eventlens.plans import transactions as rules
from eventlens.plans.classify import classified_messages, keyword_scores, to_message_topics, with_tokens
from eventlens.schemas import (MESSAGE_TOPICS_LENGTHS, TRANSACTION_RESULTS, TRANSACTIONS,
                               enforce_lengths)

# Fixed value: how often the job commits its progress.
CHECKPOINT_EVERY = {"processingTime": "3 seconds"}


def with_watermark(transactions: DataFrame, delay: str = rules.WATERMARK_DELAY,
                   time: str = TIME) -> DataFrame:
    """Event time with a bounded delay: a row whose window has closed is dropped.

    Spark tests a row against the watermark with which the batch before began to
    emit, so a late row may still count when it comes in the very next batch.
    """
    return transactions.withWatermark(time, delay)


def transactions_from_records(records: DataFrame) -> DataFrame:
    """JSON records to transactions with event time; a bad record fails the query."""
    return with_watermark(decode_strict(records, TRANSACTIONS))


def split_each_batch(schema: T.StructType, good_path: str, bad_path: str) -> Callable:
    """A foreachBatch function that decodes records and sets the bad ones aside.

    Good rows go to one folder, rejected text and its reason to the other, each under the
    batch's number: a batch that runs again replaces its own rows on both sides, so together
    they hold every record once. The batch is kept while both are written, and read once.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for rows, path in zip(decode_or_quarantine(kept, schema), (good_path, bad_path)):
                rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            kept.unpersist()
    return run


def start_decoding(records: DataFrame, schema: T.StructType, good_path: str, bad_path: str, checkpoint: str,
                   trigger: dict = CHECKPOINT_EVERY):
    """Decode a stream of records; it goes on whatever a record looks like."""
    return (records.writeStream.foreachBatch(split_each_batch(schema, good_path, bad_path))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def write_table_stream(df: DataFrame, path: str, checkpoint: str, trigger: dict = CHECKPOINT_EVERY):
    """Append to a parquet folder; each window is written once, when the watermark passes it."""
    return (df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", path)
            .trigger(**trigger).start())


# --- documented rule: the last point of the window before -------------------

_STATE = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])


def _with_doubles(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])


# the rows of the first query, rules.windows_with_point, and of the second
WINDOW_POINTS = _with_doubles(TRANSACTION_RESULTS, "point_lat", "point_lon")
TRACKED = _with_doubles(WINDOW_POINTS, "previous_lat", "previous_lon")


def with_previous_point(windows: DataFrame) -> DataFrame:
    """Second query: add each window's previous point from keyed state.

    The state is one point per customer. The rows of a batch are the customer's
    windows that closed since the last one, in the order of their ends; a window
    never closes after a later one, so batches come in order too.
    """
    def carry(key: tuple, parts: Iterator[pd.DataFrame],
              state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values("last_transaction_time")
        known = state.get if state.exists else (None, None)
        before = pd.DataFrame([known], columns=["point_lat", "point_lon"], dtype="float64")
        points = pd.concat([before, rows[["point_lat", "point_lon"]]]).ffill()
        rows["previous_lat"] = points["point_lat"].to_numpy()[:-1]
        rows["previous_lon"] = points["point_lon"].to_numpy()[:-1]
        lat, lon = points["point_lat"].iloc[-1], points["point_lon"].iloc[-1]
        if pd.notna(lat):
            state.update((float(lat), float(lon)))
        yield rows

    tracked = windows.groupBy("customer").applyInPandasWithState(
        carry, TRACKED, _STATE, "append", GroupStateTimeout.NoTimeout)
    # a missing number comes back from pandas as NaN
    points = TRACKED.names[len(TRANSACTION_RESULTS):]
    return tracked.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in points})


def documented_rule(windows: DataFrame) -> DataFrame:
    """The documented rule over the stream of windows."""
    return rules.moved(rules.documented_counts(with_previous_point(windows)))


# one customer's state, and the rows of the step that keeps it: its times are whole microseconds
_LAST = T.StructType([*_STATE, T.StructField("until", T.LongType())])
_STEP = T.StructType([*(T.StructField("_end", T.LongType()) if f.name == "last_transaction_time" else f for f in TRACKED)])


class LastPoint(StatefulProcessor):
    """A customer's last point as value state, forgotten ``keep`` after the last window.

    Windows of a batch are handled in the order of their ends. A timer in event time
    clears the state of a customer who has gone silent. The state holds the time itself, moved
    with every window; a timer that fires before it is set anew, so that a window costs no timer.
    """

    def __init__(self, keep_seconds: float):
        self.keep = int(keep_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.point = handle.getValueState("point", _LAST)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known, step = self.point.get(), Row(*_STEP.names)
        lat, lon, _ = known or (None, None, None)
        found = []
        for row in sorted(rows, key=lambda r: r["_end"]):
            found.append(step(*(row[n] for n in _STEP.names[:-2]), lat, lon))
            # a missing number may also come as NaN
            lat, lon = (was if p is None or p != p else p for p, was in ((row["point_lat"], lat), (row["point_lon"], lon)))
            end = row["_end"]
        if lat is not None:
            until = end // 1000 + self.keep
            self.point.update((lat, lon, until))
            if known is None:
                self.handle.registerTimer(until)
        return iter(found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.point.get()
        if known and known[2] > timerValues.getCurrentWatermarkInMs():
            self.handle.registerTimer(known[2])
        else:
            self.point.clear()
        return iter([])

    def close(self) -> None:
        pass


def documented_rule_stream(transactions: DataFrame, tie_break: str | None = None, width: str = rules.SHORT_WINDOW,
                           keep_seconds: float = 7 * 86400) -> DataFrame:
    """The documented rule in one streaming query: windows, then keyed state after them.

    ``transactions`` has a watermark. State of a customer without windows for
    ``keep_seconds`` of event time is dropped; the next window then has no previous point.
    """
    windows = rules.windows_with_point(transactions, tie_break, width, keep_time="closed_at")
    rows = windows.withColumn("_end", F.unix_micros("last_transaction_time")).drop("last_transaction_time")
    tracked = (rows.groupBy("customer").transformWithState(LastPoint(keep_seconds), _STEP, "append", "eventTime")
               .withColumnRenamed("_end", "last_transaction_time")
               .withColumn("last_transaction_time", F.timestamp_micros("last_transaction_time")))
    points = TRACKED.names[len(TRANSACTION_RESULTS):]
    clean = tracked.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in points})
    return rules.moved(rules.documented_counts(clean))


# --- classification with a changing dimension -------------------------------

Table = Callable[[SparkSession], DataFrame]


def classify_each_batch(weights: Table, dim_topics: Table,
                        sink: Callable[[DataFrame, int], None]) -> Callable:
    """A foreachBatch function: classify, look up, upsert.

    The dimension is read anew for every batch, so a message sees the labels of
    its processing time; a stream-static join would keep its first list of files.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        classified = classified_messages(batch, weights(spark), dim_topics(spark))
        sink(enforce_lengths(classified, MESSAGE_TOPICS_LENGTHS), batch_id)
    return run


def recorded_time(spark: SparkSession, path: str, batch_id: int) -> datetime:
    """The processing time of a micro-batch: now at its first run, the same when it is replayed.

    The first run writes it below ``path`` before anything else of the batch. A run that
    ended while writing left no row, and the next one writes anew.
    """
    own = f"{path.rstrip('/')}/batch-{batch_id}"
    written = spark.range(1).select(F.current_timestamp().alias("proc_time"))
    written.write.mode("ignore").parquet(own)
    known = spark.read.schema(written.schema).parquet(own).first()
    if known is None:
        written.write.mode("overwrite").parquet(own)
        known = spark.read.schema(written.schema).parquet(own).first()
    return known.proc_time


def classify_as_of(messages: DataFrame, weights: DataFrame, versions: DataFrame, at: str = "proc_time") -> DataFrame:
    """Topics of the messages with the labels that were valid at the time in column ``at``.

    ``versions`` is (id, topic, valid_from); a version without label says that the id is gone.
    The sink's columns, and ``at``.
    """
    topics = keyword_scores(with_tokens(messages), weights, "message_date", "message_from_name", at)
    labels = versions.select(F.col("id").alias("topic_id"), F.col("topic").alias("topic_name"), "valid_from")
    found = lookup_as_of(topics, labels, ["topic_id"], at, ["message_id"]).where(F.col("topic_name").isNotNull())
    return to_message_topics(found.withColumn("proc_time", F.col(at)), "proc_time")


def classify_each_batch_as_of(weights: Table, versions: Table, sink: Callable[[DataFrame, int], None],
                              times: str) -> Callable:
    """A foreachBatch function whose rows carry their processing time and the labels of that time.

    Times are kept in the folder ``times``, so a replayed batch finds the labels it first
    saw, whatever the dimension has become since.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = F.lit(recorded_time(spark, times, batch_id)).cast("timestamp")
        classified = classify_as_of(batch.withColumn("proc_time", now), weights(spark), versions(spark))
        sink(enforce_lengths(classified, MESSAGE_TOPICS_LENGTHS), batch_id)
    return run


def start_classification_as_of(messages: DataFrame, weights: Table, versions: Table,
                               sink: Callable[[DataFrame, int], None], times: str, checkpoint: str,
                               trigger: dict = CHECKPOINT_EVERY):
    return (messages.writeStream
            .foreachBatch(classify_each_batch_as_of(weights, versions, sink, times))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def start_classification(messages: DataFrame, weights: Table, dim_topics: Table,
                         sink: Callable[[DataFrame, int], None], checkpoint: str,
                         trigger: dict = CHECKPOINT_EVERY):
    return (messages.writeStream
            .foreachBatch(classify_each_batch(weights, dim_topics, sink))
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())
