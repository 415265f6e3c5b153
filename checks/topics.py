"""Topic words, keyword classification, lookup of labels, reports over the result."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.transactions import TIME_TEXT
from checks.words import ROWS, tokens
from eventlens import schemas
from eventlens.operators import coherence, corpus
from eventlens.operators.ranking import number_rows
from eventlens.plans import classify, reports, topic_report
from eventlens.session import cut_lineage, scratch_path
from eventlens.sources import standin
from eventlens.streaming import jobs

_stored: dict[tuple[str, str], str] = {}


def group_words(docs, k):
    """Each author group is a topic; its words are the group's most frequent tokens."""
    top = corpus.top_tokens(docs, "author_group", k)
    return topic_report.topic_words(top, F.expr("replace(author_group, 'src', '')"))


def topic_table(words):
    """A topic dimension with a label that two ids share."""
    label = F.when(F.col("id").isin("1", "3"), "shared label").otherwise(
        F.concat(F.lit("topic "), "id"))
    return (topic_report.weight_text(words).withColumnRenamed("topic_id", "id")
            .withColumn("topic", label))


def dim_topics(spark, sf):
    """The dimension as a stored table, which the classification job reads: written once
    per session, like any table a job is given."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        path = scratch_path(spark, "dim_topics")
        table = topic_table(group_words(tokens(spark, sf), topic_report.WEIGHT_WORDS))
        schemas.conform(table, schemas.DIM_TOPICS).coalesce(1).write.parquet(path)
        _stored[key] = path
    return spark.read.schema(schemas.DIM_TOPICS).parquet(_stored[key])


def known_topics(spark, sf):
    """The dimension without id 19, so that the inner lookup drops some messages."""
    return dim_topics(spark, sf).where("id <> '19'")


def weights(spark, sf):
    return classify.topic_weights(dim_topics(spark, sf))


WORDS = ROWS + """,
top as materialized (
  select replace(author_group, 'src', '') as topic_id, token as word, n, r,
         (n * 2000 + total) // (total * 2) as thousandths
  from (select author_group, token, count(*) as n,
               row_number() over (partition by author_group order by count(*) desc, token) as r
        from rows_ group by 1, 2)
  join (select author_group, count(*) as total from rows_ group by 1) using (author_group)
  where r <= 10),
weight as (select * from top where r <= 5),
dim as (
  select topic_id as id,
         case when topic_id in ('1', '3') then 'shared label' else 'topic ' || topic_id end as topic,
         string_agg(printf('%.3f*"%s"', thousandths / 1000.0, word), ' + ' order by r) as topic_weigh
  from weight group by 1, 2)"""


@query(f"with {WORDS} select id, topic, topic_weigh from dim")
def topic_weight_text(spark, sf):
    """Top five words per topic as weighted-word text."""
    return topic_table(group_words(tokens(spark, sf), topic_report.WEIGHT_WORDS))


@query(f"with {WORDS} select topic_id, word, cast(thousandths as bigint) as thousandths from weight")
def topic_weights_parsed(spark, sf):
    """The weighted-word text taken apart again."""
    return weights(spark, sf)


@query(f"""with {WORDS}
select id, 'id' as column_name, cast(length(id) as integer) as actual_length,
       1 as declared_length from dim where length(id) > 1
union all
select id, 'topic_weigh', cast(length(topic_weigh) as integer), 75
from dim where length(topic_weigh) > 75""")
def topic_length_violations(spark, sf):
    """Values longer than a declared length, here shorter than the topic table's own."""
    return schemas.length_violations(dim_topics(spark, sf), {"id": 1, "topic_weigh": 75}, "id")


SCORED = WORDS + """,
per_topic as (
  select message_id, topic_id, sum(thousandths) as s
  from rows_ join weight on word = token group by 1, 2),
ranked as (
  select *, sum(s) over (partition by message_id) as total,
         row_number() over (partition by message_id order by s desc, cast(topic_id as int)) as r
  from per_topic),
scored as materialized (
  select m.message_id, m.message_date, m.message_from_name,
         coalesce(topic_id, '0') as topic_id,
         cast(coalesce(s, 0) as bigint) as score, cast(coalesce(total, 0) as bigint) as total
  from msg m left join (select * from ranked where r = 1) using (message_id))"""


def scored(spark, sf, *carry):
    messages = classify.with_tokens(standin.spread_messages(spark, sf))
    return classify.keyword_scores(messages, weights(spark, sf), *carry)


@query(f"with {SCORED} select message_id, topic_id, score, total from scored")
def classify_keywords(spark, sf):
    """Highest sum of word weights; the lower id on a tie."""
    return scored(spark, sf)


@query(f"""with {SCORED} select message_id, topic_id, topic as topic_name
           from scored join dim on topic_id = id where id <> '19'""")
def topic_lookup(spark, sf):
    """Inner lookup: messages of the id that the dimension lacks are dropped."""
    return (classify.topic_lookup(scored(spark, sf), known_topics(spark, sf))
            .select("message_id", "topic_id", "topic_name"))


CLASSIFIED = SCORED + """,
classified as materialized (
  select message_id, message_date, message_from_name, topic_id as topic,
         dim.topic as topic_description
  from scored join dim on topic_id = id)"""


def classified(spark, sf):
    return classify.classified_messages(standin.spread_messages(spark, sf), weights(spark, sf),
                                        dim_topics(spark, sf))


@query(f"""with {CLASSIFIED} select message_id, {TIME_TEXT.format('message_date')} as message_date,
                  message_from_name, topic, topic_description from classified""")
def classified_messages(spark, sf):
    """The classification job's output rows."""
    return classified(spark, sf)


@query(f"""with {CLASSIFIED} select message_id, {TIME_TEXT.format('message_date')} as message_date,
                  message_from_name, topic, topic_description from classified""")
def class_topic_sql(spark, sf):
    """The job with the classifier as a named SQL function."""
    classify.register_class_topic(spark, weights(spark, sf))
    return classify.classified_by_function(standin.spread_messages(spark, sf),
                                           dim_topics(spark, sf), "CLASS_TOPIC")


SERIES_WEEK = TIME_TEXT.format("date_trunc('week', message_date)") + " as week"


@query(f"""with {CLASSIFIED} select {SERIES_WEEK}, topic_description, count(*) as n
           from classified group by 1, 2""")
def weekly_topic_counts(spark, sf):
    return reports.weekly_topic_counts(classified(spark, sf))


@query(f"""with {CLASSIFIED},
best as (select topic_description from classified group by 1
         order by count(*) desc, topic_description limit 5)
select {SERIES_WEEK}, topic_description, count(*) as n
from classified where topic_description in (select topic_description from best) group by 1, 2""")
def weekly_top5_topics(spark, sf):
    """The five largest labels over all time, by week."""
    return reports.weekly_top_topics(classified(spark, sf))


@query(f"""with {CLASSIFIED},
weekly as (select {SERIES_WEEK}, topic_description, count(*) as n from classified group by 1, 2)
select * from (select *, cast(row_number() over (partition by week order by n desc, topic_description)
                         as integer) as rank from weekly) where rank <= 5""")
def top5_within_week(spark, sf):
    """The five largest labels inside each week."""
    return reports.top_within_week(classified(spark, sf))


KEYWORDS = """,
kw as (select topic_id, string_agg(word, ', ' order by r) as keywords from top group by 1),
report as materialized (
  select message_id, cast(topic_id as integer) as dominant_topic,
         case when total > 0 then ((score * 20000 + total) // (total * 2)) / 10000.0
              else 0.0 end as topic_perc_contrib,
         keywords
  from scored join kw using (topic_id))"""
REPORT = SCORED + KEYWORDS


def report(spark, sf):
    named = topic_report.keywords(group_words(tokens(spark, sf), topic_report.REPORT_WORDS))
    return topic_report.dominant_topics(scored(spark, sf), cut_lineage(named))


@query(f"""with {REPORT} select message_id, dominant_topic,
                  cast(topic_perc_contrib as double) as topic_perc_contrib, keywords from report""")
def dominant_topic(spark, sf):
    """Topic with the highest share, its share to four digits, its ten words."""
    return report(spark, sf)


@query(f"""with {REPORT}
select row_number() over (order by message_id) - 1 as document_no, dominant_topic,
       cast(topic_perc_contrib as double) as topic_perc_contrib, keywords,
       array_to_string(tokens, ' ') as text
from report join tok using (message_id)""")
def dominant_topic_with_text(spark, sf):
    """The report's five columns, numbered in key order."""
    joined = topic_report.with_text(report(spark, sf), tokens(spark, sf))
    numbered = number_rows(joined, ["message_id"], "document_no")
    return numbered.select("document_no", "dominant_topic", "topic_perc_contrib", "keywords",
                           F.array_join("text", " ").alias("text"))


@query(f"with {REPORT} select dominant_topic, count(*) as n from report group by 1")
def topic_sizes(spark, sf):
    return topic_report.topic_sizes(report(spark, sf))


NPMI = WORDS + """,
len_ as (select message_id, len(tokens) as l from tok),
occ as (select message_id, token, pos - 1 as p from rows_
        where token in (select word from weight)),
held as materialized (
  select distinct message_id, token,
         unnest(range(greatest(p - 109, 0), least(p, greatest(l - 110, 0)) + 1)) as start
  from occ join len_ using (message_id)),
total as (select cast(sum(greatest(l - 110, 0) + 1) as double) as t from len_),
one as (select token, cast(count(*) as double) as n from held group by 1),
pair as (select distinct x.word as a, y.word as b from weight x join weight y using (topic_id)),
both_ as (select a, b, count(*) as n from held ha
          join pair on ha.token = a
          join held hb on hb.message_id = ha.message_id and hb.start = ha.start and hb.token = b
          group by 1, 2),
npmi as (
  select x.topic_id as topic, x.word, y.word as other, coalesce(both_.n, 0) as n_both,
         coalesce(ln((coalesce(both_.n, 0) / t + 1e-12) / ((oa.n / t) * (ob.n / t)))
           / -ln(coalesce(both_.n, 0) / t + 1e-12), 0) as v
  from weight x join weight y using (topic_id)
  left join one oa on oa.token = x.word left join one ob on ob.token = y.word
  left join both_ on both_.a = x.word and both_.b = y.word
  cross join total)"""


def coherence_words(spark, sf):
    return weights(spark, sf).select(F.col("topic_id").alias("topic"), "word")


@query(f"with {NPMI} select topic, word, other, n_both, round(v, 6) as npmi from npmi")
def npmi_pairs(spark, sf):
    """NPMI of every pair of a topic's words over sliding windows of 110 tokens."""
    words = coherence_words(spark, sf)
    counts = coherence.window_counts(tokens(spark, sf), words)
    return coherence.npmi_pairs(words, counts).withColumn("npmi", F.round("npmi", 6))


@query(f"""with {NPMI},
whole as (select topic, other, sum(v) as t from npmi group by 1, 2),
cosine as (select topic, word, sum(v * t) / (sqrt(sum(v * v)) * sqrt(sum(t * t))) as c
           from npmi join whole using (topic, other) group by 1, 2)
select topic, round(avg(c), 6) as c_v from cosine group by 1""")
def coherence_by_topic(spark, sf):
    """c_v of each keyword topic."""
    words = coherence_words(spark, sf)
    pairs = coherence.npmi_pairs(words, coherence.window_counts(tokens(spark, sf), words))
    return coherence.coherence_by_topic(pairs).withColumn("c_v", F.round("c_v", 6))


#: Days after the first message at which the dimension changes.
CHANGES = (7, 14, 21)
VERSIONS = f"""
versions as (
  select id, v, case when v = 2 and id = '19' then null else 'topic ' || id || ' v' || v end as topic,
         timestamp '2024-01-01 00:00:00' + to_days(d) as valid_from
  from (select unnest(range(24))::varchar as id),
       (values (0, 0), {", ".join(f"({v}, {d})" for v, d in enumerate(CHANGES, 1))}) as changes(v, d)
  where id <> '3' or v > 0)"""


def label_versions(spark, sf):
    """The dimension's labels with three changes: id 19 is gone for a week, id 3 begins late."""
    rows = [(v, d) for v, d in enumerate((0, *CHANGES))]
    changes = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(d).alias("d")) for v, d in rows])
    ids = spark.range(24).select(F.col("id").cast("string").alias("id"), F.inline(changes))
    label = F.when(~((F.col("v") == 2) & (F.col("id") == "19")), F.concat(F.lit("topic "), "id", F.lit(" v"), "v"))
    start = F.expr("timestampadd(DAY, d, timestamp'2024-01-01 00:00:00')")
    return (ids.where("id <> '3' or v > 0")
            .select("id", label.alias("topic"), start.alias("valid_from")))


@query(f"""with {SCORED}, {VERSIONS}
select message_id, topic_id as topic, topic as topic_description, {TIME_TEXT.format("message_date")} as proc_time
from (select message_id, message_date, topic_id, arg_max({{'t': topic}}, valid_from).t as topic
      from scored join versions on topic_id = id and valid_from <= message_date group by all)
where topic is not null""")
def lookup_as_of_time(spark, sf):
    """Each message gets the label that its topic had when the message was processed; its own
    date stands for that time."""
    messages = standin.spread_messages(spark, sf).withColumn("proc_time", F.col("message_date"))
    found = jobs.classify_as_of(messages, weights(spark, sf), label_versions(spark, sf))
    return found.select("message_id", "topic", "topic_description", "proc_time")
