"""Tumbling aggregates by customer, their last location, and a distributed running maximum."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

TIME = "transaction_datetime"


def tumbling_totals(transactions: DataFrame, width: str, *extra: Column,
                    time: str = TIME, keep_time: str | None = None) -> DataFrame:
    """One row per customer and epoch-aligned window of ``width``.

    Every aggregate has a partial form, so a customer who holds most of the rows
    is reduced to one row per window in each task before the shuffle. Works on
    batch and streaming frames alike. ``last_transaction_time`` is the window's
    end; ``lat`` and ``lon`` are independent maxima; the count skips NULL types.
    ``keep_time`` names a column for the window's event time, which a stateful step
    after this one needs for its watermark.
    """
    totals = (transactions
            .groupBy("customer", F.window(time, width).alias("w"))
            .agg(F.count("transaction_type").cast("double").alias("count_transactions"),
                 F.sum("online_payment_amount").alias("total_online_payment_amount"),
                 F.sum("in_store_payment_amount").alias("total_in_store_payment_amount"),
                 F.max("lat").alias("lat"),
                 F.max("lon").alias("lon"),
                 *extra)
            .withColumn("last_transaction_time", F.col("w.end")))
    if keep_time:
        totals = totals.withColumn(keep_time, F.window_time("w"))
    return totals.drop("w")


def last_in_store_point(width: str, tie_break: str | None = None,
                        time: str = TIME) -> tuple[Column, Column]:
    """Aggregates ``point_lat``, ``point_lon``: the true position of the window's latest
    in-store row, NULL if there is none.

    The order within a window is one whole number, time since the window's start
    and then all 64 bits of ``tie_break`` (or of a hash of the position).
    Both columns follow the same order, so they come from the same row. With a
    number to order by, Spark aggregates in a hash table; an order by a struct
    would sort all transactions first, which took three times as long.
    """
    span = int(pd.Timedelta(width) / pd.Timedelta(microseconds=1))
    tie = F.col(tie_break) if tie_break else F.xxhash64("lat", "lon")
    since_start = F.pmod(F.unix_micros(time), F.lit(span))
    order = F.when(F.col("in_store_payment_amount") > 0,
                   since_start.cast("decimal(13,0)") * F.expr(f"{1 << 64}BD") + tie.cast("decimal(20,0)"))
    return (F.max_by("lat", order).alias("point_lat"),
            F.max_by("lon", order).alias("point_lon"))


def previous_point(windows: DataFrame) -> DataFrame:
    """Add ``previous_lat``, ``previous_lon``: the customer's latest in-store point of any
    earlier window.

    The frame holds one row per customer and window, so a partition here is as
    long as the customer's windows, whatever the number of transactions.
    """
    before = (Window.partitionBy("customer").orderBy("last_transaction_time")
              .rowsBetween(Window.unboundedPreceding, -1))
    return windows.withColumns({
        "previous_lat": F.last("point_lat", ignorenulls=True).over(before),
        "previous_lon": F.last("point_lon", ignorenulls=True).over(before)})


def running_max_before(df: DataFrame, value: str, order: str, alias: str,
                       block: int = 1_000_000, partition: Sequence[str] = ()) -> DataFrame:
    """Add ``alias``: the maximum of ``value`` over all rows before this one in ``order``.

    ``order`` is a whole number that is unique within ``partition`` (an offset),
    so a block of ``block`` consecutive numbers holds at most ``block`` rows.
    Each block is scanned by itself; only one maximum per block is scanned in
    sequence, which is a millionth of the rows.
    """
    keys = [*partition, "_block"]
    blocked = df.withColumn("_block", F.floor(F.col(order) / block))
    in_order = [F.col(c) for c in partition]
    earlier_blocks = (Window.partitionBy(*in_order).orderBy("_block")
                      .rowsBetween(Window.unboundedPreceding, -1))
    per_block = (blocked.groupBy(*keys).agg(F.max(value).alias("_max"))
                 .select(*keys, F.max("_max").over(earlier_blocks).alias("_before")))
    in_block = (Window.partitionBy(*keys).orderBy(order)
                .rowsBetween(Window.unboundedPreceding, -1))
    return (blocked.withColumn("_inner", F.max(value).over(in_block))
            .join(per_block, keys)
            .withColumn(alias, F.greatest("_inner", "_before"))
            .drop("_block", "_inner", "_before"))
