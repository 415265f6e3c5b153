"""Last-wins merge by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventlens.session import cut_lineage


def latest_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``, whole; the remaining columns close the order,
    so ties have one outcome. Copies of a hot key are reduced in each task before the shuffle."""
    columns = df.columns
    rest = [c for c in columns if c not in order]
    last = F.max_by(F.struct(*columns), F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*key).agg(last).select("_row.*")


def merge_by_key(existing: DataFrame, updates: DataFrame, key: Sequence[str],
                 order: Sequence[str]) -> DataFrame:
    """``existing`` with the updates' keys replaced; replaying the updates changes nothing.

    ``existing`` must have unique keys. The last updates are written once, so that
    Spark knows their size: a small batch is broadcast and the large table then
    stays in place.
    """
    last = cut_lineage(latest_per_key(updates, key, order).select(*existing.columns))
    return existing.join(last, list(key), "left_anti").unionByName(last)
