"""Lookup joins whose small side is checked before it is broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from eventlens.session import cut_lineage

# About a hundred megabytes of (token, lemma, part of speech) rows.
MAX_BROADCAST_ROWS = 1_000_000
# A key with more than one in HOT_SHARE of all facts is hot: there are fewer than HOT_SHARE such.
HOT_SHARE = 1_000
SALTS = 256


def fits(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than one row beyond."""
    return df.limit(max_rows + 1).count() <= max_rows


def lookup_join(facts: DataFrame, lookup: DataFrame, on: list[str], spread_by: list[str],
                how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join ``facts`` to a lookup table with unique keys, exact for any distribution of keys.

    A lookup of checked size is broadcast and ``facts`` does not move. For a
    larger one the facts are counted per key first, which is one row per key and
    task in the shuffle. Rows of hot keys then get a salt, a hash of
    ``spread_by`` (columns that tell the facts of one key apart, so a retried
    task salts alike), and only the hot keys' lookup rows are repeated per salt.
    Keep ``lookup`` cheap to read: it is read twice.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"how={how!r}: a repeated lookup side would duplicate its own rows")
    if fits(lookup, max_rows):
        return facts.join(F.broadcast(lookup), on, how)
    hot = F.broadcast(hot_keys(facts, on).withColumn("_hot", F.lit(True)))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(SALTS))
    cold = F.lit(0).cast("long")
    salted_facts = (facts.join(hot, on, "left")
                    .withColumn("_salt", F.when(F.col("_hot") | no_key, salt).otherwise(cold))
                    .drop("_hot"))
    every = F.sequence(cold, F.lit(SALTS - 1).cast("long"))
    salted_lookup = (lookup.join(hot, on, "left")
                     .withColumn("_salt", F.explode(F.when(F.col("_hot"), every)
                                                     .otherwise(F.array(cold))))
                     .drop("_hot"))
    return salted_facts.join(salted_lookup, [*on, "_salt"], how).drop("_salt")


def hot_keys(facts: DataFrame, on: list[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys that hold more than one in ``share`` of the rows: fewer than ``share`` of them."""
    counts = cut_lineage(facts.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col("_n") * share > total).select(*on)
