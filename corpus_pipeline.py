"""From raw documents to token ids: five stages, each an operator of ``eventlens.llm``.

A stage gets the documents that the one before kept, as a Parquet table, and returns a
DataFrame; all but the last return the columns of ``documents``.

    quality          rows that the weakly supervised rules reject, or the base test fails, go
    near_duplicates  one row of each class of near-duplicates stays
    secrets          found secrets are replaced by a mark in the text
    mixing           each row comes as often as the mix of sources takes it, perhaps never
    encoding         (doc_id, n_tokens, ids) of each row

Stages rely on no order of rows, and on no column but doc_id, text and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventlens.llm import codec, mixing, near_dups, quality, secrets
from eventlens.session import prepare, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dups.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs, scratch_path(spark, "secret-ledger"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ids = codec.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage), ("secrets", secret_stage),
          ("mixing", mixing_stage), ("encoding", encoding_stage)]

#: Merging by ranks and similarity by signatures have no SQL form; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
