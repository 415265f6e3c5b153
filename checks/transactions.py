"""Windowed transaction rules."""

from pyspark.sql import functions as F

from checks.registry import query, rounded
from eventlens.functions.geo import haversine_miles
from eventlens.operators.windows import tumbling_totals
from eventlens.plans import transactions as rules
from eventlens.sources import standin

# Beside standin.transactions: the same view for DuckDB.
_VIEW = """
select event_id,
       'c' || cast(user_id as varchar) as customer,
       event_type as transaction_type,
       case when event_id % 2 = 0 then value else 0.0 end as online_payment_amount,
       case when event_id % 2 = 1 then value else 0.0 end as in_store_payment_amount,
       cast(44.57 as double) + ((event_id * 37) % 341) / cast(1000 as double) as lat,
       cast(20.20 as double) + ((event_id * 53) % 431) / cast(1000 as double) as lon,
       {time} as transaction_datetime
from events"""
RAW = _VIEW.format(time="ts")
SQUEEZED = _VIEW.format(
    time="make_timestamp(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 720)")

TIME_TEXT = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"

TOTALS = """
tot as (
  select customer,
         time_bucket(interval '{width}', transaction_datetime, timestamp '1970-01-01')
           + interval '{width}' as w_end,
         cast(count(transaction_type) as double) as n,
         sum(online_payment_amount) as online,
         sum(in_store_payment_amount) as store,
         max(lat) as max_lat, max(lon) as max_lon,
         arg_max(struct_pack(lat := lat, lon := lon),
                 struct_pack(a := transaction_datetime, b := event_id))
           filter (where in_store_payment_amount > 0) as point
  from tx {where}
  group by 1, 2)"""


def _totals(view, width, where=""):
    return f"with tx as ({view}), {TOTALS.format(width=width, where=where)}"


RESULT = f"""
select customer, n as count_transactions,
       round(online, 2) as total_online_payment_amount,
       round(store, 2) as total_in_store_payment_amount,
       round(max_lat, 3) as lat, round(max_lon, 3) as lon,
       {TIME_TEXT.format('w_end')} as last_transaction_time
from tot"""
CODE = " where online < store and n >= 3"


def _cents(df):
    return rounded(df, total_online_payment_amount=2, total_in_store_payment_amount=2,
                   lat=3, lon=3)


@query(_totals(SQUEEZED, "5 minutes") + RESULT)
def tumble_5min(spark, sf):
    """Grouped window aggregate: count, two sums, two maxima, window end."""
    return _cents(tumbling_totals(standin.transactions(spark, sf), "5 minutes"))


@query(_totals(RAW, "10 hours") + RESULT)
def tumble_10h(spark, sf):
    return _cents(tumbling_totals(standin.transactions_raw(spark, sf), "10 hours"))


@query(_totals(SQUEEZED, "5 minutes") + RESULT + CODE)
def rule_code(spark, sf):
    return _cents(rules.rule_code(standin.transactions(spark, sf)))


@query(_totals(RAW, "10 hours", "where lat > 44.57 and lat < 44.91 and lon > 20.20 "
                                "and lon < 20.62") + RESULT + CODE)
def geo_box_prefilter(spark, sf):
    return _cents(rules.geo_box_prefilter(standin.transactions_raw(spark, sf)))


BOX = " and max_lat > 44.57 and max_lat < 44.91 and max_lon > 20.20 and max_lon < 20.62"


@query(_totals(RAW, "10 hours") + RESULT + CODE + BOX)
def geo_box_having(spark, sf):
    return _cents(rules.geo_box_having(standin.transactions_raw(spark, sf)))


@query(_totals(RAW, "10 hours") + RESULT + CODE + BOX)
def rule_sql_10h(spark, sf):
    """The ten-hour rule as SQL over a named table."""
    standin.transactions_raw(spark, sf).createOrReplaceTempView("customer_table")
    return _cents(spark.sql(rules.rule_sql("customer_table")))


@query(_totals(SQUEEZED, "5 minutes") + RESULT + " where n > 5 and online > store")
def rule_documented_basic(spark, sf):
    return _cents(rules.rule_documented_basic(standin.transactions(spark, sf)))


@query(_totals(SQUEEZED, "5 minutes") + f"""
select customer, {TIME_TEXT.format('w_end')} as last_transaction_time,
       round(point.lat, 3) as last_lat, round(point.lon, 3) as last_lon
from tot""")
def last_location(spark, sf):
    """The last in-store position of each window, NULL if there is none."""
    windows = rules.windows_with_point(standin.transactions(spark, sf), "event_id")
    return windows.select("customer", "last_transaction_time",
                          F.round("point_lat", 3).alias("last_lat"),
                          F.round("point_lon", 3).alias("last_lon"))


MILES = ("2 * 3958.8 * asin(sqrt(least(1.0, pow(sin(radians({b}lat - {a}lat) / 2), 2)"
         " + cos(radians({a}lat)) * cos(radians({b}lat))"
         " * pow(sin(radians({b}lon - {a}lon) / 2), 2))))")

DOCUMENTED = f""",
prev as (
  select *, last_value(point ignore nulls) over (
              partition by customer order by w_end
              rows between unbounded preceding and 1 preceding) as previous
  from tot),
moved as (
  select *, {MILES.format(a='previous.', b='point.')} as miles from prev
  where n > 5 and online > store and point is not null and previous is not null)
select customer, n as count_transactions,
       round(online, 2) as total_online_payment_amount,
       round(store, 2) as total_in_store_payment_amount,
       round(point.lat, 3) as lat, round(point.lon, 3) as lon,
       {TIME_TEXT.format('w_end')} as last_transaction_time,
       round(miles, 3) as miles_moved
from moved where miles > 2"""


@query(_totals(SQUEEZED, "5 minutes") + DOCUMENTED)
def rule_documented(spark, sf):
    return rounded(_cents(rules.rule_documented(standin.transactions(spark, sf), "event_id")),
                   miles_moved=3)


@query(name="haversine_miles", sql=f"with tx as ({RAW}), c as (select *, cast(44.8125 as double) as clat, "
       "cast(20.4612 as double) as clon from tx) "
       "select event_id, round(2 * 3958.8 * asin(sqrt(least(1.0, "
       "pow(sin(radians(lat - clat) / 2), 2) + cos(radians(clat)) * cos(radians(lat)) "
       "* pow(sin(radians(lon - clon) / 2), 2)))), 3) as miles from c")
def haversine_miles_query(spark, sf):
    """Great-circle distance of every transaction from one fixed point."""
    tx = standin.transactions_raw(spark, sf)
    return tx.select("event_id", F.round(haversine_miles(
        F.lit(44.8125), F.lit(20.4612), F.col("lat"), F.col("lon")), 3).alias("miles"))


@query(f"""
with tx as (select *, (event_id // 2000) * 2000 + (event_id * 37) % 2000 as arrival_offset
            from ({SQUEEZED})),
seen as (
  select *, max(transaction_datetime) over (
              order by arrival_offset rows between unbounded preceding and 1 preceding)
            - interval '1 minute' as watermark
  from tx),
late as (
  select *, time_bucket(interval '5 minutes', transaction_datetime, timestamp '1970-01-01')
            + interval '5 minutes' as window_end
  from seen where transaction_datetime < watermark)
select event_id, customer, arrival_offset,
       {TIME_TEXT.format('transaction_datetime')} as transaction_datetime,
       {TIME_TEXT.format('watermark')} as watermark,
       {TIME_TEXT.format('window_end')} as window_end,
       window_end <= watermark as dropped
from late""")
def late_rows_audit(spark, sf):
    """Rows behind the watermark when they arrive; scanned in blocks, not in one task."""
    late = rules.late_rows_audit(standin.transactions_as_arrived(spark, sf))
    return late.select("event_id", "customer", "arrival_offset", "transaction_datetime",
                       "watermark", "window_end", "dropped")


@query(f"""
with tx as (select *, event_id % 2 as topic_partition,
                  ((event_id // 2000) * 2000 + (event_id * 37) % 2000) // 2 as arrival_offset
            from ({SQUEEZED})),
seen as (
  select *, max(transaction_datetime) over (
              partition by topic_partition order by arrival_offset rows between unbounded preceding and 1 preceding)
            - interval '1 minute' as watermark
  from tx),
late as (
  select *, time_bucket(interval '5 minutes', transaction_datetime, timestamp '1970-01-01')
            + interval '5 minutes' as window_end
  from seen where transaction_datetime < watermark)
select event_id, customer, topic_partition, arrival_offset,
       {TIME_TEXT.format('transaction_datetime')} as transaction_datetime,
       {TIME_TEXT.format('watermark')} as watermark,
       {TIME_TEXT.format('window_end')} as window_end,
       window_end <= watermark as dropped
from late""")
def late_rows_audit_partitions(spark, sf):
    """The same for two topic partitions whose offsets coincide, each with its own watermark."""
    arrived = standin.transactions_as_arrived(spark, sf)
    arrived = (arrived.withColumn("topic_partition", F.col("event_id") % 2)
               .withColumn("arrival_offset", F.expr("arrival_offset div 2")))
    late = rules.late_rows_audit(arrived, rules.LateAudit(block=1000, partition=("topic_partition",)))
    return late.select("event_id", "customer", "topic_partition", "arrival_offset", "transaction_datetime",
                       "watermark", "window_end", "dropped")
