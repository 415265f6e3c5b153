"""Streaming twins: the same tables read as a stream, checked against the same SQL.

A window is emitted once the watermark has passed its end. The queries get the events as
files in order of time, a micro-batch each, and a closing row later than all windows; they
return every window and are checked against the batch SQL as it is.
"""

import math

from pyspark.sql import functions as F, types as T

from checks.records import PROPS
from checks.registry import query, rounded
from checks.transactions import BOX, CODE, DOCUMENTED, RAW, RESULT, SQUEEZED, _cents, _totals
from eventlens import schemas
from eventlens.functions import records
from eventlens.plans import transactions as rules
from eventlens.session import scratch_path
from eventlens.sources import connectors, standin
from eventlens.sources.tables import EVENTS, read_table
from eventlens.streaming import jobs

ONCE = {"availableNow": True}
SLICES = 5


def closed_transactions(spark, sf, raw=False):
    """The events table as a stream of transactions with a watermark, from slices in order of
    time, one for each micro-batch, and a closing row.

    A slice is as many files as the table has splits, so that no task writes or reads it alone;
    files without rows make up the number if some splits have none of it. The closing row is ten days later, twenty minutes where event times are squeezed: later
    than all windows. The watermark never passes its own window, so that does not come out.
    """
    events = read_table(spark, sf, "events").select(*EVENTS.names)
    path = scratch_path(spark, "slices")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    lo, hi = events.agg(F.min(micros), F.max(micros)).first()
    number = F.floor((micros - F.lit(lo)) * SLICES / F.lit(hi - lo + 1))
    files = max(events.rdd.getNumPartitions(), 1)
    for i in range(SLICES):     # written one after the other, as their times of change give the order
        events.where(number == i).repartition(files).write.mode("append").parquet(path)
        while len(spark.read.schema(EVENTS).parquet(path).inputFiles()) < (i + 1) * files:
            spark.createDataFrame([], EVENTS).coalesce(1).write.mode("append").parquet(path)
    values = {"ts": F.expr(f"timestamp_micros({hi}) + interval 10 days"), "event_id": F.lit(-1), "user_id": F.lit(-1)}
    (spark.range(1).select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENTS])
     .coalesce(1).write.mode("append").parquet(path))
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", str(files)).parquet(path)
    time = F.col("ts").cast("timestamp") if raw else standin.squeezed_time()
    return jobs.with_watermark(standin.as_transactions(stream, time))


def finished(spark, df, name):
    """Run a streaming query over all there is; its output folder."""
    path = scratch_path(spark, name)
    jobs.write_table_stream(df, path, scratch_path(spark, f"{name}-progress"),
                            ONCE).awaitTermination()
    return path


DISTANCE = T.StructType([*schemas.TRANSACTION_RESULTS, T.StructField("miles_moved", T.DoubleType())])


@query(_totals(SQUEEZED, "5 minutes") + DOCUMENTED)
def stream_rule_documented(spark, sf):
    """One stream: windows, then the last point held as value state with a timer."""
    df = jobs.documented_rule_stream(closed_transactions(spark, sf), "event_id")
    path = finished(spark, df, "rule_documented")
    return rounded(_cents(spark.read.schema(DISTANCE).parquet(path)), miles_moved=3)


@query(_totals(RAW, "10 hours") + RESULT + CODE + BOX)
def stream_rule_sql_10h(spark, sf):
    """The ten-hour rule as SQL over a streaming view, written and read back as records."""
    closed_transactions(spark, sf, raw=True).createOrReplaceTempView("customer_stream")
    path = scratch_path(spark, "rule-records")
    connectors.write_record_stream(
        spark.sql(rules.rule_sql("customer_stream")), "text", {}, scratch_path(spark, "rule-progress"), ONCE, path).awaitTermination()
    return _cents(records.decode_strict(spark.read.schema("value string").text(path), schemas.TRANSACTION_RESULTS))


@query(_totals(SQUEEZED, "5 minutes") + RESULT + CODE)
def stream_rule_code_whole(spark, sf):
    """The windowed rule as a stream of several micro-batches, every window."""
    path = finished(spark, rules.rule_code(closed_transactions(spark, sf)), "rule_code")
    return _cents(spark.read.schema(schemas.TRANSACTION_RESULTS).parquet(path))


@query(_totals(SQUEEZED, "5 minutes") + DOCUMENTED)
def stream_rule_documented_whole(spark, sf):
    """The chained streams over several micro-batches, every window."""
    points = finished(spark, rules.windows_with_point(closed_transactions(spark, sf), "event_id"),
                      "points")
    windows = spark.readStream.schema(jobs.WINDOW_POINTS).parquet(points)
    path = finished(spark, jobs.documented_rule(windows), "rule_documented")
    return rounded(_cents(spark.read.schema(DISTANCE).parquet(path)), miles_moved=3)


@query("""
with wire as (select props as value from events union all select text from documents),
read as (select case when json_valid(value) then json_extract_string(value, '$.k') end as k
         from wire)
select k is null as rejected, count(*) as n,
       cast(coalesce(sum(cast(k as bigint)), 0) as bigint) as total
from read group by 1""")
def stream_quarantine(spark, sf):
    """Records and prose in one stream: it goes on, and both sides together hold every row."""
    wire = scratch_path(spark, "wire")
    values = (read_table(spark, sf, "events").select(F.col("props").alias("value"))
              .unionByName(read_table(spark, sf, "documents").select(F.col("text").alias("value"))))
    values.write.parquet(wire)      # a file for each split of the tables, half of them in a micro-batch
    half = str(max(math.ceil(values.rdd.getNumPartitions() / 2), 1))
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", half).parquet(wire)
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    jobs.start_decoding(stream, PROPS, good, bad, scratch_path(spark, "decoding-progress"), ONCE).awaitTermination()
    number = T.StructField("batch_id", T.LongType())
    kept = spark.read.schema(T.StructType([*PROPS, number])).parquet(good).select(F.lit(False).alias("rejected"), "k")
    rejected = spark.read.schema(T.StructType([T.StructField("value", T.StringType()), number])).parquet(bad).select(
        F.lit(True).alias("rejected"), F.lit(None).cast("long").alias("k"))
    return kept.unionByName(rejected).groupBy("rejected").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).cast("long").alias("total"))
