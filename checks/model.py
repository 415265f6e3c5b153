"""LDA: training, listing, inference, report, coherence, perplexity.

The model is random by nature, so these have no SQL twin. What any seed must hold has one, in
the queries whose names end in _rows. Every document takes part once in each pass, with all its words.
"""

import math

from pyspark.sql import functions as F

from checks.messages import DATE, MESSAGES
from checks.registry import query
from checks.words import LEMMA_SQL, MERGED, POS_SQL, lexicon, training_tokens
from eventlens import schemas
from eventlens.operators import coherence
from eventlens.operators.ranking import number_rows
from eventlens.plans import artefact, classify, shipped, topic_model
from eventlens.session import cut_lineage, passing_tables, scratch_path
from eventlens.sources import standin

#: The training job's own: ten passes, an update every 1000 documents, learned prior, all words.
SETTINGS = topic_model.Training()
_models: dict[tuple[str, str], str] = {}
_docs: dict[tuple[str, str], object] = {}


def prepared(spark, sf):
    """Training tokens, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _docs:
        with passing_tables() as keep:
            _docs[key] = keep(cut_lineage(training_tokens(spark, sf)))
    return _docs[key]


def saved_model(spark, sf):
    """The trained model as an artefact: trained once per session, then loaded."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        path = scratch_path(spark, "lda")
        topic_model.save(topic_model.train(prepared(spark, sf), "message_id", SETTINGS), path)
        _models[key] = path
    return topic_model.load(_models[key])


@query()
def train_lda(spark, sf):
    """Train, and return each topic's ten heaviest words."""
    model = topic_model.train(prepared(spark, sf), "message_id", SETTINGS)
    described = topic_model.describe_topics(spark, model)
    return described.withColumn("weight", F.round("weight", 6))


@query()
def topic_listing(spark, sf):
    """The trained topics as weighted-word text, five words each."""
    return topic_model.topic_listing(
        topic_model.describe_topics(spark, saved_model(spark, sf), words=5))


@query()
def classify_lda(spark, sf):
    """Most probable topic of every message."""
    topics = topic_model.classify(prepared(spark, sf), saved_model(spark, sf), "message_id")
    return topics.withColumn("share", F.round("share", 4))


@query()
def document_topics(spark, sf):
    """Every topic of a message with a share of at least 0.01."""
    return (topic_model.document_topics(prepared(spark, sf), saved_model(spark, sf), "message_id")
            .withColumn("share", F.round("share", 4)))


@query()
def lda_report(spark, sf):
    """Document number, dominant topic, its share, its words, the document's tokens."""
    report = topic_model.report(prepared(spark, sf), saved_model(spark, sf), "message_id")
    numbered = number_rows(report, ["message_id"], "document_no")
    return numbered.select("document_no", "dominant_topic", "topic_perc_contrib", "keywords",
                           F.array_join("text", " ").alias("text"))


@query()
def coherence_cv(spark, sf):
    """c_v of the trained topics, twenty words each."""
    words = topic_model.describe_topics(spark, saved_model(spark, sf), words=20)
    return coherence.coherence(prepared(spark, sf), words.select("topic", "word"))


@query()
def perplexity(spark, sf):
    bound = topic_model.log_perplexity(prepared(spark, sf), saved_model(spark, sf))
    documents = prepared(spark, sf).agg(F.count(F.lit(1)).alias("documents"))
    return documents.withColumn("log_perplexity", F.round(F.lit(bound), 6))


TOPICS = topic_model.Training.topics


@query(f"""select message_id, {TOPICS} as topics, true as sums_to_one, true as best_is_largest
           from ({MESSAGES}) where message_subject is not null""")
def document_topics_rows(spark, sf):
    """What any seed must hold: a share of each topic, together one; the best one is the largest."""
    model = saved_model(spark, sf)
    known = topic_model.distributions(prepared(spark, sf), model)
    best = topic_model.classify(prepared(spark, sf), model, "message_id")
    total = F.aggregate("shares", F.lit(0.0), lambda a, b: a + b)
    return known.join(best, "message_id").select(
        "message_id", F.size("shares").alias("topics"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.get("shares", F.col("topic_id").cast("int")) == F.array_max("shares")).alias("best_is_largest"))


@query(f"""select topic::integer as topic, 5 as words, true as descending
           from (select unnest(range({TOPICS})) as topic)""")
def topic_listing_rows(spark, sf):
    """Every topic has five different words with weights that do not rise."""
    described = topic_model.describe_topics(spark, saved_model(spark, sf), words=5)
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col("weight"))))
    rows = described.groupBy("topic").agg(F.countDistinct("word").cast("int").alias("words"), ordered.alias("w"))
    falls = F.forall(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.get("w", i)["weight"] <= F.get("w", i - 1)["weight"])
    return rows.select("topic", "words", falls.alias("descending"))


@query(f"""with {MERGED},
kept as (select message_id, pos, {LEMMA_SQL.format('token')} as lemma from merged
         where {POS_SQL.format('token')} in ('NOUN', 'VERB', 'ADJ', 'ADV')),
spelled as (select m.message_id, coalesce(string_agg(lemma, ' ' order by pos), '') as text
            from tok m left join kept using (message_id) group by 1)
select row_number() over (order by message_id) - 1 as document_no, text,
       true as in_range, 10 as keywords, true as a_share from spelled""")
def lda_report_rows(spark, sf):
    """The report's numbers and texts, and bounds of what the model adds."""
    report = cut_lineage(topic_model.report(prepared(spark, sf), saved_model(spark, sf), "message_id"))   # read twice
    numbered = number_rows(report.select("message_id"), ["message_id"], "document_no")
    return numbered.join(report, "message_id").select(
        "document_no", F.array_join("text", " ").alias("text"), F.col("dominant_topic").between(0, TOPICS - 1).alias("in_range"),
        F.size(F.split("keywords", ", ")).alias("keywords"), F.col("topic_perc_contrib").between(round(1 / TOPICS, 4), 1).alias("a_share"))


@query(f"select count(*) as documents, true as positive from ({MESSAGES}) where message_subject is not null")
def perplexity_rows(spark, sf):
    """All documents count, and the bound is a positive number."""
    bound = topic_model.log_perplexity(prepared(spark, sf), saved_model(spark, sf))
    return prepared(spark, sf).agg(F.count(F.lit(1)).alias("documents")).withColumn(
        "positive", F.lit(math.isfinite(bound) and bound > 0))


def trained_artefact(spark, sf):
    """(messages, the artefact saved and loaded again, its dimension with a label for each topic)"""
    messages = standin.spread_messages(spark, sf)
    spelled = classify.with_tokens(messages, stop=False).select("message_id", "tokens")
    path = scratch_path(spark, "artefact")
    with passing_tables():      # the saved artefact has its own tables
        topic_model.save(artefact.train(messages, lambda docs: lexicon(docs.select("message_id", "tokens").unionByName(spelled)),
                                         settings=SETTINGS), path)
    model = topic_model.load(path)
    labelled = artefact.dimension(spark, model).withColumn("topic", F.concat(F.lit("topic "), "id"))
    return messages, model, cut_lineage(schemas.conform(labelled, schemas.DIM_TOPICS))


def by_shipped_model(spark, sf):
    messages, model, dim = trained_artefact(spark, sf)
    archive = scratch_path(spark, "model") + ".zip"
    shipped.export(model, archive)
    shipped.register(spark, archive, archive.rsplit("/", 1)[-1].removesuffix(".zip"))
    return cut_lineage(classify.classified_by_function(messages, dim, "CLASS_TOPIC_MODEL"))


@query()
def classified_by_model(spark, sf):
    """The whole job: train, save, load, ship to the workers, classify in SQL, look up labels."""
    return by_shipped_model(spark, sf)


@query(f"""select message_id, {DATE}, message_from_name, true as in_range, true as labelled
           from ({MESSAGES}) where message_subject is not null""")
def classified_by_model_rows(spark, sf):
    """What any seed must hold: each message with a subject once, a topic, that topic's label."""
    return by_shipped_model(spark, sf).select(
        "message_id", "message_date", "message_from_name",
        F.col("topic").cast("int").between(0, topic_model.Training.topics - 1).alias("in_range"),
        (F.col("topic_description") == F.concat(F.lit("topic "), "topic")).alias("labelled"))


@query(f"""select message_id, {DATE}, message_from_name, true as in_range, true as labelled
           from ({MESSAGES}) where message_subject is not null""")
def classified_by_pipeline_rows(spark, sf):
    """The same by the loaded pipeline in serving order, without Python."""
    messages, model, dim = trained_artefact(spark, sf)
    return artefact.classified_messages(messages, model, dim).select(
        "message_id", "message_date", "message_from_name",
        F.col("topic").cast("int").between(0, topic_model.Training.topics - 1).alias("in_range"),
        (F.col("topic_description") == F.concat(F.lit("topic "), "topic")).alias("labelled"))
