"""Benchmark passages in documents against plain loops."""

import random
import re
from collections import Counter
from hashlib import sha256

import pytest

from eventlens.llm import decontaminate

LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG, "x"), (1, "Short ITEM", "x"), (2, LONG, "x"), (3, None, "x"), (4, "", "x"), (5, "?!", "x"), (None, "nameless words here are six now", "x"),
         (10, "naïve 東京 straße", "x"), (11, "a b a b a b a b a b a b", "x"), (12, "one", "x"), (12, "one", "x")]
DOCS = [(1, "before " + " ".join(f"W{i}," for i in range(5, 22)) + " after", 0), (2, "w0 w1 w2 w3 w4 w5 w6 w7 w8", 0), (3, None, 0), (4, "", 0),
        (5, "a short item; short. item short\nITEM", 0), (None, "nameless words here are six now", 0), (6, "a b " * 40, 0), (6, "a b " * 40, 0),
        (7, "NAÏVE naïve 東京 straße", 0), (8, "one " * 3 + LONG * 300 + " one", 0), (9, "clean text", 0), (10, LONG, 0), (10, LONG, 0)]


def words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(len(w), 10)
        for s in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[s:s + m]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in sizes:
            for s in range(len(w) - m + 1):
                if tuple(w[s:s + m]) in windows:
                    hit.update(range(s, s + m))
                    found |= windows[tuple(w[s:s + m])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return Counter(out)


def rows(df):
    return Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect())


@pytest.mark.parametrize("broadcast", [decontaminate.BROADCAST_BYTES, -1])
def test_odd_rows_equal_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, row int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string, shingle string")
    assert rows(decontaminate.report(docs, items)) == brute([d[:2] for d in DOCS], [i[:2] for i in ITEMS])


def test_random_texts_equal_brute_force(spark):
    draw = random.Random(5)
    docs = [(i, " ".join(draw.choice("abc") for _ in range(draw.randrange(60)))) for i in range(80)]
    items = [(i % 20, " ".join(draw.choice("abc") for _ in range(draw.randrange(14)))) for i in range(30)]
    found = decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"))
    assert rows(found) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame(DOCS[:2], "doc_id long, text string, row int"), spark.createDataFrame([], "item_id long, text string")
    assert rows(decontaminate.report(docs, items)) == brute([d[:2] for d in DOCS[:2]], [])
    assert decontaminate.report(docs.limit(0), items).collect() == []


def test_passages_say_where(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, row int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string, shingle string")
    found = {(r.start, r.end, r.item_id) for r in decontaminate.passages(docs, items).where("doc_id = 1").collect()}
    assert found == {(s, s + 10, i) for s in range(1, 9) for i in ("1", "2")}
