"""What the physical plans must and must not hold, so that they carry over to large tables."""

import zipfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import words
from eventlens import session
from eventlens.operators import corpus
from eventlens.plans import classify, reports, transactions as rules
from eventlens.sources import standin
from tests.conftest import SF

LONG = {"train_lda", "topic_listing", "classify_lda", "document_topics", "lda_report",
        "coherence_cv", "perplexity"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Table scans that ran: those of the final plans, without what a reused exchange hides."""
    df.collect()
    n, skip = 0, None
    for line in plan(df).splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        n += "FileScan" in line
    return n


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in LONG])
def test_no_cross_join(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_only_needed_columns_are_read(spark):
    text = plan(reports.weekly_activity(standin.messages(spark, SF)))
    assert "ReadSchema: struct<doc_id:bigint>" in text
    text = plan(standin.transactions(spark, SF).select("customer"))
    assert "ReadSchema: struct<user_id:bigint>" in text


def test_null_filter_reaches_the_scan(spark):
    text = plan(classify.with_tokens(standin.messages(spark, SF)).select("tokens"))
    assert "PushedFilters: [IsNotNull(text)]" in text


def test_windows_aggregate_in_hash_tables_before_the_shuffle(spark):
    for df in (rules.rule_code(standin.transactions(spark, SF)),
               rules.windows_with_point(standin.transactions(spark, SF), "event_id")):
        text = plan(df)
        assert "SortAggregate" not in text
        assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("partial_sum")


def test_top_k_is_limited_before_the_shuffle(spark):
    docs = words.tokens(spark, SF)
    text = plan(corpus.top_tokens(docs, "author_group", 5))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_bag_of_words_does_not_shuffle(spark):
    docs = classify.with_tokens(standin.messages(spark, SF)).select("message_id", "tokens")
    assert "Exchange" not in plan(corpus.bag_of_words(docs, "message_id"))


def test_text_is_made_into_tokens_once(spark):
    docs = classify.with_tokens(standin.messages(spark, SF)).select("message_id", "tokens")
    text = plan(corpus.spell(docs, "message_id"))
    assert text.count("regexp_extract_all") == 1


def test_collocations_read_the_text_once(spark):
    docs = classify.with_tokens(standin.messages(spark, SF))
    assert scans(corpus.bigram_counts(docs)) == 1
    scores = corpus.bigram_scores(docs, threshold=0)    # works on the written pair counts
    assert scores.count() > 0 and "documents.parquet" not in plan(scores)


def test_series_limit_classifies_once(spark):
    df = (standin.messages(spark, SF)
          .select("message_date", F.col("author_group").alias("topic_description")))
    assert scans(reports.weekly_top_topics(df)) == 1


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    assert session.shared_dir(spark) == session.shared_dir(spark)
    class Configured:       # a cluster that names the folder
        sparkContext, conf = spark.sparkContext, {"spark.checkpoint.dir": str(tmp_path)}
    assert session.shared_dir(Configured) == str(tmp_path)
    assert session.scratch_path(Configured, "x").startswith(f"{tmp_path}/x-")
    rows = session.cut_lineage(spark.range(5))
    assert rows.count() == 5
    assert f"{session.shared_dir(spark)}/cut-" in rows.inputFiles()[0]


def test_a_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "spark://host"

        def getCheckpointDir(self):
            return None

    class Unconfigured:
        sparkContext, conf = Context(), {}
    with pytest.raises(ValueError):
        session.shared_dir(Unconfigured)


def test_shipped_code_is_found_by_workers(spark, tmp_path):
    archive = tmp_path / "shipped.zip"
    with zipfile.ZipFile(archive, "w") as z:
        z.writestr("shipped_model.py", "def predict(batch):\n    return batch.str.upper()\n")
    session.ship_package(spark, str(archive))

    def load():
        import shipped_model
        return shipped_model.predict
    df = spark.createDataFrame([("a",)], "s string")
    assert df.select(classify.topic_udf(load)("s").alias("t")).first().t == "A"
