"""Registration of queries and their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlens.session import prepare

AREAS = ("transactions", "records", "messages", "words", "topics", "model", "streams")

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function, with the SQL that must equal it."""
    def register(fn):
        key = name or fn.__name__

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(prepare(spark), sf_dir))
        _queries[key] = run
        if sql is not None:
            _oracles[key] = sql
        return fn
    return register


def plain(df: DataFrame) -> DataFrame:
    """Timestamps as text with microseconds, so that both engines print the same."""
    return df.select(*[
        F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
        for f in df.schema.fields])


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in digits.items()})


def _load() -> None:
    for area in AREAS:
        importlib.import_module(f"checks.{area}")


def queries():
    _load()
    return dict(_queries)


def oracle_sql():
    _load()
    return dict(_oracles)
