"""The queries of this subpackage, by name, and the SQL of those that SQL can express.

A module brings its queries as functions called ``op<N>_<name>`` and, where there is one,
the SQL as ``ORACLE``.
"""

from __future__ import annotations

from functools import wraps

from eventlens.session import prepare
from eventlens.llm import (alignment, codec, collocations, decontaminate, merkle, mixing, near_dups, passages, quality, secrets,
                           token_counts, token_store, warc)

MODULES = (token_counts, quality, warc, near_dups, token_store, merkle, codec, passages, secrets, mixing,
           decontaminate, collocations, alignment)


def queries():
    found = {}
    for module in MODULES:
        for name, fn in vars(module).items():
            if name.startswith("op") and name[2].isdigit():
                found[name] = _prepared(fn)
    return found


def _prepared(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        return fn(prepare(spark), sf_dir)
    return run


def oracle_sql():
    return {name: module.ORACLE for module in MODULES if getattr(module, "ORACLE", None)
            for name in vars(module) if name.startswith("op") and name[2].isdigit()}
