"""Timestamps: ISO text, week starts, half-open ranges."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def iso_z(ts: Column) -> Column:
    """ISO text with a literal Z, whole seconds (session time zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def from_iso_z(text: Column) -> Column:
    """Parse ISO text with Z; a fraction of a second is optional."""
    return F.to_timestamp(text, "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]X")


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the timestamp's week."""
    return F.date_trunc("week", ts)


def in_range(ts: Column, start=None, end=None) -> Column:
    """start <= ts < end; an open side is None."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (ts >= F.lit(start).cast("timestamp"))
    if end is not None:
        keep = keep & (ts < F.lit(end).cast("timestamp"))
    return keep
