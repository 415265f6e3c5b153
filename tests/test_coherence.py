import math
import random

import pytest

from eventlens.operators import coherence

random.seed(3)
VOCAB = list("abcdefgh")
DOCS = [[random.choice(VOCAB) for _ in range(n)] for n in (0, 1, 4, 5, 6, 9, 30, 57)] * 3
TOPICS = {0: ["a", "b", "c"], 1: ["c", "d"], 2: ["e", "f", "g", "h"]}


def windows(window):
    for d in DOCS:
        for s in range(max(len(d) - window, 0) + 1):
            yield set(d[s:s + window])


@pytest.fixture(scope="module")
def inputs(spark):
    docs = spark.createDataFrame([(d,) for d in DOCS], "tokens array<string>").repartition(4)
    words = spark.createDataFrame([(t, w) for t, ws in TOPICS.items() for w in ws],
                                  "topic int, word string")
    return docs, words


@pytest.mark.parametrize("window, block", [(5, 4096), (5, 3), (1, 7), (100, 4096)])
def test_window_counts_equal_brute_force(inputs, monkeypatch, window, block):
    monkeypatch.setattr(coherence, "BLOCK", block)
    # the task function is shipped by value; bind the block size it sees
    got = {(r.a, r.b): r.n for r in coherence.window_counts(*inputs, window=window).collect()}
    seen = list(windows(window))
    expected = {(None, None): len(seen)}
    for ws in TOPICS.values():
        for a in ws:
            for b in ws:
                n = sum(a in w and b in w for w in seen)
                if a <= b and n:
                    expected[a, b] = n
    assert got == expected


def test_coherence_equals_brute_force(inputs):
    seen = list(windows(5))
    total = len(seen)

    def p(*ws):
        return sum(all(w in s for w in ws) for s in seen) / total

    def npmi(a, b):
        both = p(a, b)
        return math.log((both + 1e-12) / (p(a) * p(b))) / -math.log(both + 1e-12)
    scores = []
    for ws in TOPICS.values():
        vectors = [[npmi(a, b) for b in ws] for a in ws]
        whole = [sum(col) for col in zip(*vectors)]
        def cos(x, y):
            return sum(i * j for i, j in zip(x, y)) / (math.hypot(*x) * math.hypot(*y))
        scores.append(sum(cos(v, whole) for v in vectors) / len(ws))
    r = coherence.coherence(*inputs, window=5).first()
    assert r.topics == 3
    assert r.c_v == pytest.approx(sum(scores) / 3, abs=1e-9)
