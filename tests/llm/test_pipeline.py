"""The whole pipeline against a brute-force version: SQL of the operators where there is one,
all pairs of documents for near-duplicates, the library for the ids."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import duckdb
import pyarrow as pa
import pytest

import corpus_pipeline
from eventlens.llm import mixing, quality, secrets

SCHEMA = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()),
                    ("source", pa.string()), ("n_chars", pa.int64())])
COLUMNS = ["doc_id", "text", "source"]
VOCABULARY = [f"{a}{b}" for a in "barn coal drum fern gold hill iris jade kite lamp".split()
              for b in "a er ing ly s".split()]


def sentence(rng, n):
    return " ".join(rng.choices(VOCABULARY, k=n)).capitalize() + "."


def fixture_rows():
    rng = random.Random(8)
    texts = [" ".join(sentence(rng, 12) for _ in range(rng.randint(5, 9))) for _ in range(60)]
    texts += [t + " " + sentence(rng, 3) for t in texts[:12]]            # near copies
    texts += [t.replace(".", ". ", 1) for t in texts[12:18]]              # copies but for a blank
    texts += texts[18:22] + [texts[18]] * 3                               # exact copies
    texts += [" ".join(sentence(rng, 12) for _ in range(7)) + ' password = "hunter2hunter2" and AKIA' + "Q7" * 10
              for _ in range(6)]
    texts += ["", None, "too short", "# * $ % " * 40, "same words here " * 80]
    sources = ["hot"] * 5 + ["rare", None, "b"]
    return [(i * 3 + 1, t, "en", sources[i % len(sources)], len(t or "")) for i, t in enumerate(texts)]


def sql(rows, statement):
    con = duckdb.connect()
    con.register("documents", pa.table(list(map(list, zip(*rows))) if rows else [[]] * 5, schema=SCHEMA))
    cursor = con.execute(statement)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, r)) for r in cursor.fetchall()]


def bag(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    size = min(5, len(words))
    return Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def brute_classes(rows):
    """The first row of each class of near-duplicates, and rows without words."""
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    bags = [bag(r[1]) for r in rows]
    for i, j in combinations(range(len(rows)), 2):
        either = (bags[i] | bags[j]).total()
        if either and bags[i] and bags[j] and (bags[i] & bags[j]).total() / either >= 0.8:
            up[max(top(i), top(j))] = min(top(i), top(j))
    return [r for i, r in enumerate(rows) if top(i) == i or not bags[i]]


def brute_redact(text, spans):
    pieces = [tuple(map(int, s.rsplit(":", 2)[1:])) for s in spans.split(",") if s]
    out, at = [], 0
    for start, end in sorted(pieces):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = end
    return "".join(out) + text[at:]


def brute(rows):
    import public_tokenizers
    import tiktoken
    from tiktoken.load import load_tiktoken_bpe

    kept = {r["doc_id"] for r in sql(rows, quality.ORACLE) if r["kept"]}
    stages = [[r for r in rows if r[0] in kept]]
    stages.append(brute_classes(stages[-1]))
    spans = {r["doc_id"]: r["spans"] for r in sql(stages[-1], secrets.ORACLE)}
    stages.append([(r[0], brute_redact(r[1], spans[r[0]]), *r[2:]) for r in stages[-1]])
    times = {r["doc_id"]: r["repetitions"] for r in sql(stages[-1], mixing.ORACLE)}
    stages.append([r for r in stages[-1] for _ in range(times[r[0]])])
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    stages.append([(r[0], library.encode_ordinary(r[1])) for r in stages[-1]])
    return stages


@pytest.fixture(scope="module")
def rows():
    return fixture_rows()


def test_every_stage_equals_brute_force(spark, rows, tmp_path):
    want = brute(rows)
    assert len(rows) > len(want[0]) > len(want[1]) > 40        # each decision takes effect
    assert any("[secret]" in r[1] for r in want[2]) and len(want[3]) != len(want[2])
    (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
     .repartition(4).write.parquet(f"{tmp_path}/documents.parquet"))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        assert sorted(map(tuple, docs.collect()), key=repr) == sorted(want[i], key=repr), name
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids"]
    got = sorted((r.doc_id, list(r.ids)) for r in out.collect())
    assert got == sorted(want[-1])


def test_no_rows_and_no_good_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows in (("none", []), ("bad", [(1, None, "en", "a", 0), (None, "", None, None, None)])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{name}").count() == 0
