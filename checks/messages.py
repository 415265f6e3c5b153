"""Messages: scans, filters, upserts and time reports that need no topic."""

from pyspark.sql import functions as F, types as T

from checks.registry import query
from checks.transactions import TIME_TEXT
from eventlens import schemas
from eventlens.operators.ranking import number_rows
from eventlens.operators.upsert import merge_by_key
from eventlens.plans import reports
from eventlens.plans.classify import with_processing_time
from eventlens.session import cut_lineage, scratch_path
from eventlens.sources import standin
from eventlens.sources.keyed_table import KeyedTable

# Beside standin.messages: the same view for DuckDB.
MESSAGES = """
select cast(doc_id as varchar) as message_id,
       timestamp '2024-01-01 00:00:00'
         + to_minutes(cast((doc_id * 97) % 40320 as int)) as message_date,
       case when doc_id % 4 <> 0 then cast(doc_id - 1 as varchar) end as message_in_reply_to,
       case when doc_id % 50 = 3 then '' else source end as message_from_name,
       source || '@example.org' as message_from_email,
       text as message_subject,
       source as author_group
from documents"""

DATE = TIME_TEXT.format("message_date") + " as message_date"


@query(f"""select message_id, {DATE}, message_in_reply_to, message_from_name,
                  message_from_email, message_subject from ({MESSAGES})""")
def scan_messages(spark, sf):
    return schemas.conform(standin.messages(spark, sf), schemas.MESSAGES)


@query(f"""select message_id, {DATE}, message_from_name, length(message_subject) as n
           from ({MESSAGES}) where message_subject is not null""")
def messages_not_null(spark, sf):
    """Only NULL is filtered; empty text passes."""
    return (standin.messages(spark, sf).where(F.col("message_subject").isNotNull())
            .select("message_id", "message_date", "message_from_name",
                    F.length("message_subject").cast("long").alias("n")))


@query(f"""select message_id, message_in_reply_to, message_from_name
           from ({MESSAGES}) where message_in_reply_to is not null""")
def replies_not_null(spark, sf):
    return (standin.messages(spark, sf).where(F.col("message_in_reply_to").isNotNull())
            .select("message_id", "message_in_reply_to", "message_from_name"))


@query("select * from (values " + ", ".join(
    f"('{c}', {i}, '{t}', true, (select count({c}) from ({MESSAGES})))" for i, (c, t) in enumerate([
        ("message_id", "string"), ("message_date", "timestamp"), ("message_in_reply_to", "string"),
        ("message_from_name", "string"), ("message_from_email", "string"),
        ("message_subject", "string"), ("author_group", "string")]))
    + ") as t(column_name, position, data_type, nullable, non_null_rows)")
def describe_messages(spark, sf):
    """The table's schema as rows, with the number of rows that fill each column."""
    df = standin.messages(spark, sf)
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    long = filled.unpivot([], df.columns, "column_name", "non_null_rows")
    return schemas.describe_table(df).join(long, "column_name")


@query(f"select message_id, true as later from ({MESSAGES})")
def processing_time(spark, sf):
    """Computed column: the time at which the message is processed."""
    df = with_processing_time(standin.messages(spark, sf))
    return df.select("message_id", (F.col("proc_time") > F.col("message_date")).alias("later"))


@query(f"""
select message_id, 'message_from_email' as column_name,
       cast(length(message_from_email) as integer) as actual_length, 16 as declared_length
from ({MESSAGES}) where length(message_from_email) > 16
union all
select message_id, 'message_subject', cast(length(message_subject) as integer), 5000
from ({MESSAGES}) where length(message_subject) > 5000""")
def length_violations(spark, sf):
    return schemas.length_violations(standin.messages(spark, sf),
                                     {"message_from_email": 16, "message_subject": 5000},
                                     "message_id")


@query(f"""
with m as ({MESSAGES}),
updates as (
  select message_in_reply_to as message_id, message_date, message_from_name, 1 as version
  from m where message_in_reply_to is not null
  union all
  select 'new-' || message_id, message_date, message_from_name, 1 from m),
latest as (
  select message_id, message_date, message_from_name, version from (
    select *, row_number() over (partition by message_id
                                 order by message_date desc, message_from_name desc) as r
    from updates) where r = 1)
select message_id, {DATE}, message_from_name, version from latest
union all
select message_id, {DATE}, message_from_name, 0 from m
where message_id not in (select message_id from latest)""")
def upsert_topics(spark, sf):
    """Keyed merge: known keys replaced, new ones added, last wins; applied twice."""
    m = standin.messages(spark, sf)
    columns = ["message_id", "message_date", "message_from_name"]
    existing = m.select(*columns, F.lit(0).alias("version"))
    replies = (m.where(F.col("message_in_reply_to").isNotNull())
                .select(F.col("message_in_reply_to").alias("message_id"), *columns[1:]))
    fresh = m.select(F.concat(F.lit("new-"), "message_id").alias("message_id"), *columns[1:])
    updates = replies.unionByName(fresh).withColumn("version", F.lit(1))
    order = ["message_date", "message_from_name"]
    once = cut_lineage(merge_by_key(existing, updates, ["message_id"], order))
    return merge_by_key(once, updates, ["message_id"], order)


KEYED = T.StructType([T.StructField("message_id", T.StringType()), T.StructField("message_date", T.TimestampType()),
                      T.StructField("message_from_name", T.StringType()), T.StructField("batch", T.IntegerType())])


@query(f"""
with m as ({MESSAGES}),
sent as (
  select message_id, message_date, message_from_name, cast(message_id as bigint) % 3 as batch from m
  union all
  select message_in_reply_to, message_date, message_from_name, 3 from m where message_in_reply_to is not null
  union all
  select message_id, message_date, message_from_name, 4 from m where message_id like '%7')
select message_id, {DATE}, message_from_name, cast(batch as integer) as batch from (
  select *, row_number() over (partition by message_id
                               order by batch desc, message_date desc, message_from_name desc) as r
  from sent) where r = 1""")
def keyed_table_compacted(spark, sf):
    """Five batches into a keyed table, folded after the second and the fourth; the last one
    waits. The one taken in first comes once more and changes nothing."""
    m = standin.messages(spark, sf).select("message_id", "message_in_reply_to", "message_date", "message_from_name")
    table = KeyedTable(spark, scratch_path(spark, "keyed"), KEYED, ["message_id"], ["message_date", "message_from_name"], buckets=8)

    def send(rows, batch):
        table.write_batch(rows.withColumn("batch", F.lit(batch)), batch)
    for i in range(3):
        send(m.where(F.col("message_id").cast("long") % 3 == i), i)
        if i == 1:
            table.compact()
    send(m.where(F.col("message_in_reply_to").isNotNull()).withColumn("message_id", F.col("message_in_reply_to")), 3)
    table.compact()
    send(m.where("message_id = '-1'"), 0)
    send(m.where(F.col("message_id").endswith("7")), 4)
    return table.read()


@query(f"""select message_id,
                  row_number() over (order by message_id) - 1 as document_no
           from ({MESSAGES})""")
def document_no(spark, sf):
    """0-based number in key order, from range partitions instead of one sorted task."""
    return number_rows(standin.messages(spark, sf).select("message_id"),
                       ["message_id"], "document_no")


WEEK = TIME_TEXT.format("date_trunc('week', message_date)") + " as week"


@query(f"select {WEEK}, count(*) as n from ({MESSAGES}) group by 1")
def weekly_activity(spark, sf):
    return reports.weekly_activity(standin.messages(spark, sf))


@query(f"""select {WEEK}, count(*) as n from ({MESSAGES})
           where message_date >= timestamp '2024-01-03 12:00:00'
             and message_date < timestamp '2024-01-17 00:00:00' group by 1""")
def activity_in_range(spark, sf):
    """Half-open range: the start counts, the end does not."""
    return reports.activity_in_range(standin.messages(spark, sf),
                                     "2024-01-03 12:00:00", "2024-01-17 00:00:00")


@query(f"""select {WEEK}, count(*) as n from ({MESSAGES}) group by 1
           order by 1 desc limit 5000""")
def limited_activity(spark, sf):
    """Latest weeks first, within the row limits of the chart and the server."""
    return reports.limited_activity(reports.weekly_activity(standin.messages(spark, sf)))
