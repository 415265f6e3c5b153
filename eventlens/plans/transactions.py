"""Rules over windows of card transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from eventlens.functions.geo import RULE_BOX, haversine_miles, inside_box
from eventlens.operators.windows import (TIME, last_in_store_point, previous_point,
                                         running_max_before, tumbling_totals)

# Window widths, watermark delay and thresholds of the rules.
SHORT_WINDOW = "5 minutes"
LONG_WINDOW = "10 hours"
WATERMARK_DELAY = "1 minute"
CODE_MIN_COUNT = 3          # at least
DOCUMENTED_MIN_COUNT = 5    # more than
DOCUMENTED_MILES = 2        # more than

RESULT = ["customer", "count_transactions", "total_online_payment_amount",
          "total_in_store_payment_amount", "lat", "lon", "last_transaction_time"]


def less_online_than_in_store() -> Column:
    return F.col("total_online_payment_amount") < F.col("total_in_store_payment_amount")


def rule_code(transactions: DataFrame, width: str = SHORT_WINDOW,
              min_count: int = CODE_MIN_COUNT) -> DataFrame:
    """Windows with at least ``min_count`` transactions and less paid online than in store."""
    return (tumbling_totals(transactions, width).select(*RESULT)
            .where(less_online_than_in_store())
            .where(F.col("count_transactions") >= min_count))


def geo_box_prefilter(transactions: DataFrame, width: str = LONG_WINDOW,
                      box: dict = RULE_BOX) -> DataFrame:
    """The box read as a row filter: only transactions inside it are aggregated."""
    inside = transactions.where(inside_box(F.col("lat"), F.col("lon"), **box))
    return rule_code(inside, width)


def geo_box_having(transactions: DataFrame, width: str = LONG_WINDOW,
                   box: dict = RULE_BOX) -> DataFrame:
    """The box read as a condition on the window's maxima."""
    return rule_code(transactions, width).where(inside_box(F.col("lat"), F.col("lon"), **box))


def rule_sql(table: str, width: str = LONG_WINDOW, min_count: int = CODE_MIN_COUNT,
             box: dict = RULE_BOX) -> str:
    """The rule with its box on the maxima, as one SQL statement over a named table.

    The table may be a view of a stream. Conditions on aggregates are a HAVING.
    """
    return f"""
        select customer,
               cast(count(transaction_type) as double) as count_transactions,
               sum(online_payment_amount) as total_online_payment_amount,
               sum(in_store_payment_amount) as total_in_store_payment_amount,
               max(lat) as lat,
               max(lon) as lon,
               window.end as last_transaction_time
        from {table}
        group by window(transaction_datetime, '{width}'), customer
        having sum(online_payment_amount) < sum(in_store_payment_amount)
           and count(transaction_type) >= {min_count}
           and max({table}.lat) > {box["lat_min"]} and max({table}.lat) < {box["lat_max"]}
           and max({table}.lon) > {box["lon_min"]} and max({table}.lon) < {box["lon_max"]}"""


def documented_counts(windows: DataFrame) -> DataFrame:
    """More than five transactions, and more paid online than in store."""
    return windows.where((F.col("count_transactions") > DOCUMENTED_MIN_COUNT)
                         & (F.col("total_online_payment_amount")
                            > F.col("total_in_store_payment_amount")))


def rule_documented_basic(transactions: DataFrame, width: str = SHORT_WINDOW) -> DataFrame:
    return documented_counts(tumbling_totals(transactions, width).select(*RESULT))


def windows_with_point(transactions: DataFrame, tie_break: str | None = None,
                       width: str = SHORT_WINDOW, time: str = TIME,
                       keep_time: str | None = None) -> DataFrame:
    """Window totals plus the last in-store position inside the window."""
    point = last_in_store_point(width, tie_break, time)
    kept = [keep_time] if keep_time else []
    return (tumbling_totals(transactions, width, *point, time=time, keep_time=keep_time)
            .select(*RESULT, "point_lat", "point_lon", *kept))


def moved(windows: DataFrame, miles: float = DOCUMENTED_MILES) -> DataFrame:
    """Keep windows whose point lies more than ``miles`` from the previous one.

    The result's ``lat`` and ``lon`` are the point itself. A window without a
    point, or without an earlier one, is no hit: its distance is NULL.
    """
    distance = haversine_miles(*[F.col(c) for c in ("previous_lat", "previous_lon",
                                                    "point_lat", "point_lon")])
    return (windows.withColumn("miles_moved", distance)
            .where(F.col("miles_moved") > miles)
            .withColumns({"lat": F.col("point_lat"), "lon": F.col("point_lon")})
            .select(*RESULT, "miles_moved"))


def rule_documented(transactions: DataFrame, tie_break: str | None = None,
                    width: str = SHORT_WINDOW) -> DataFrame:
    """Documented rule: counts and amounts as above, and the customer moved since the
    last in-store point of an earlier window."""
    windows = previous_point(windows_with_point(transactions, tie_break, width))
    return moved(documented_counts(windows))


@dataclass(frozen=True)
class LateAudit:
    """How the audit orders arrivals and when it calls a row late."""
    offset: str = "arrival_offset"
    delay: str = WATERMARK_DELAY
    width: str = SHORT_WINDOW
    block: int = 1_000_000
    partition: tuple[str, ...] = ()


def late_rows_audit(transactions: DataFrame, audit: LateAudit = LateAudit(),
                    time: str = TIME) -> DataFrame:
    """Rows behind the watermark at their arrival, and whether their window had closed.

    The watermark of a row is the highest event time that arrived before it, less
    the delay. A late row is only lost when its whole window is behind as well. Offsets
    that count by topic partition need ``partition``: each partition has its own watermark.
    """
    seen = running_max_before(transactions, time, audit.offset, "seen", block=audit.block,
                              partition=audit.partition)
    return (seen.withColumn("watermark", F.col("seen") - F.expr(f"interval {audit.delay}"))
            .where(F.col(time) < F.col("watermark"))
            .withColumn("window_end", F.window(time, audit.width)["end"])
            .withColumn("dropped", F.col("window_end") <= F.col("watermark"))
            .drop("seen"))
