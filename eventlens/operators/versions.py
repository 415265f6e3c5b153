"""Tables that keep their history: versions by key, and lookups as of a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from eventlens.operators.joins import lookup_join


def with_valid_to(versions: DataFrame, key: Sequence[str], valid_from: str = "valid_from") -> DataFrame:
    """Each version with ``valid_to``, the start of the key's next one; null for the current."""
    later = Window.partitionBy(*key).orderBy(valid_from)
    return versions.withColumn("valid_to", F.lead(valid_from).over(later))


def lookup_as_of(facts: DataFrame, versions: DataFrame, on: Sequence[str], at: str, spread_by: Sequence[str],
                 valid_from: str = "valid_from", how: str = "inner", **sizes) -> DataFrame:
    """``facts`` with the columns of their key's version at the time ``at``.

    A version is valid from its own time on, until the key's next. Of versions of one key and
    time the greatest row is taken. A fact without key or time, before its key's first version,
    or of an unknown key has no version: ``inner`` drops it, ``left`` keeps it with nulls.

    The versions of a key become one sorted array, so the join is a lookup by unique key with
    its size check and salted hot keys, and the version is picked inside the fact's row: a key
    with a third of all facts is no group in one task. Arrays suit dimensions, whose keys change
    now and then; facts are never collected.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how={how!r}")
    carried = [c for c in versions.columns if c not in on and c != valid_from]
    known = versions.where(F.col(valid_from).isNotNull()).groupBy(*on).agg(
        F.array_sort(F.collect_list(F.struct(F.col(valid_from).alias("_from"), *carried))).alias("_versions"))
    joined = lookup_join(facts, known, list(on), list(spread_by), how="left", **sizes)
    earlier = F.filter("_versions", lambda v: v["_from"] <= F.col(at))
    picked = joined.withColumn("_version", F.get(earlier, F.size(earlier) - 1)).drop("_versions")
    if how == "inner":
        picked = picked.where(F.col("_version").isNotNull())
    return picked.select(*facts.columns, F.col("_version._from").alias(valid_from), *[f"_version.{c}" for c in carried])
