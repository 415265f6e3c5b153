"""JSON records, literal tables, schema checks, time text."""

from pyspark.sql import functions as F, types as T

from checks.registry import query
from checks.transactions import RAW, TIME_TEXT
from eventlens import schemas
from eventlens.functions import records, times
from eventlens.session import scratch_path
from eventlens.sources import connectors, standin
from eventlens.sources.csv_split import read_csv_split
from eventlens.sources.tables import DOCUMENTS, read_table, spread

PROPS = T.StructType([T.StructField("k", T.LongType())])


@query("""select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""")
def json_decode(spark, sf):
    """Strict decode of the JSON column: a missing field or malformed text fails the job."""
    events = read_table(spark, sf, "events").select("event_id", "props")
    return records.decode_strict(events, PROPS, "props", ("event_id",))


@query("""
with wire as (select props as value from events union all select text from documents),
read as (select case when json_valid(value) then json_extract_string(value, '$.k') end as k
         from wire)
select k is null as rejected, count(*) as n,
       cast(coalesce(sum(cast(k as bigint)), 0) as bigint) as total
from read group by 1""")
def json_quarantine(spark, sf):
    """Decode that sets bad records aside. The events' records are mixed with plain prose,
    which is no JSON; both sides together hold every row."""
    wire = (read_table(spark, sf, "events").select(F.col("props").alias("value"))
            .unionByName(read_table(spark, sf, "documents").select(F.col("text").alias("value"))))
    good, bad = records.decode_or_quarantine(wire, PROPS)
    sides = good.select(F.lit(False).alias("rejected"), "k").unionByName(
        bad.select(F.lit(True).alias("rejected"), F.lit(0).cast("long").alias("k")))
    return sides.groupBy("rejected").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"))


@query(f"""select event_id,
  '{{"customer":"' || customer || '","transaction_type":"' || transaction_type
  || '","online_payment_cents":' || cast(cast(round(online_payment_amount * 100) as bigint) as varchar)
  || ',"transaction_datetime":"' || strftime(transaction_datetime, '%Y-%m-%dT%H:%M:%S.%fZ')
  || '"}}' as value
  from ({RAW})""")
def json_encode(spark, sf):
    """Records as JSON text. Amounts go out as cents here: engines print doubles differently."""
    tx = standin.transactions_raw(spark, sf).withColumn(
        "online_payment_cents", F.round(F.col("online_payment_amount") * 100).cast("long"))
    return tx.select("event_id", records.encode(
        "customer", "transaction_type", "online_payment_cents",
        "transaction_datetime").alias("value"))


@query(f"""select event_id, customer, transaction_type,
                  round(online_payment_amount, 2) as online_payment_amount,
                  round(in_store_payment_amount, 2) as in_store_payment_amount,
                  round(lat, 3) as lat, round(lon, 3) as lon,
                  {TIME_TEXT.format('transaction_datetime')} as transaction_datetime
           from ({RAW})""")
def json_record_roundtrip(spark, sf):
    """Whole transaction records written as JSON text and read back strictly."""
    tx = spread(standin.transactions_raw(spark, sf), "event_id")
    wire = tx.select("event_id", records.encode(*schemas.TRANSACTIONS.fieldNames()).alias("value"))
    back = records.decode_strict(wire, schemas.TRANSACTIONS, carry=("event_id",))
    return back.withColumns({"online_payment_amount": F.round("online_payment_amount", 2),
                             "in_store_payment_amount": F.round("in_store_payment_amount", 2),
                             "lat": F.round("lat", 3), "lon": F.round("lon", 3)})


@query("""
with kinds(event_type, kind) as (
  values ('view', 'browse'), ('click', 'browse'), ('purchase', 'buy'), ('signup', 'account'))
select k.event_type, k.kind, count(*) as n
from events e join kinds k on e.event_type = k.event_type group by 1, 2""")
def values_table(spark, sf):
    """A table of literal rows, joined to the events."""
    kinds = spark.createDataFrame(
        [("view", "browse"), ("click", "browse"), ("purchase", "buy"), ("signup", "account")],
        "event_type string, kind string")
    events = read_table(spark, sf, "events").select("event_type")
    return (events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
            .join(kinds, "event_type"))


@query("""select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as iso,
                 strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') as back
          from events""")
def iso_roundtrip(spark, sf):
    """ISO text with a literal Z, and back."""
    events = read_table(spark, sf, "events")
    return (events.select("event_id", times.iso_z(F.col("ts").cast("timestamp")).alias("iso"))
            .withColumn("back", times.from_iso_z(F.col("iso"))))


@query("""select cast(user_id as varchar) as message_id, count(*) as n
          from events group by 1 having count(*) > 1""")
def key_violations(spark, sf):
    """Keys that are not unique: here the user, taken for the key of the events."""
    events = read_table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("message_id"))
    return schemas.key_violations(events, "message_id")


@query("select doc_id, text, lang from documents")
def csv_split(spark, sf):
    """Texts with line ends through CSV files, one for each split of the table, which are read by blocks."""
    schema = T.StructType([f for f in DOCUMENTS if f.name in ("doc_id", "text", "lang")])
    path = scratch_path(spark, "csv")
    connectors.write_csv(read_table(spark, sf, "documents").select(*schema.names), path)
    return read_csv_split(spark, path, schema)
