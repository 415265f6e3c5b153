"""Phrases and their scores against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from eventlens.llm import collocations
from eventlens.llm.double_array import Trie


def brute(docs, least, top):
    grams, total = Counter(), Counter()
    for lang, text in docs:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", text):
            w = re.findall(r"[^ \t]+", piece)
            total[lang] += len(w)
            grams.update((lang, *w[s:s + k]) for k in range(1, 6) for s in range(len(w) - k + 1))
    some = {p: n for p, n in grams.items() if len(p) > 2 and n >= least}
    inside = {(p[0], *p[1 + s:1 + s + k]) for p, n in some.items() for k in range(2, len(p) - 1)
              for s in range(len(p) - k) if some.get((p[0], *p[1 + s:1 + s + k])) == n}
    rows = []
    for p, a in some.items():
        if p not in inside:
            n = total[p[0]]
            cuts = [(1000 * a * n // (grams[p[:k + 1]] * grams[(p[0], *p[k + 1:])]), k) for k in range(1, len(p) - 1)]
            score, k = min(cuts)
            rows.append((p[0], " ".join(p[1:]), a, grams[p[:k + 1]], grams[(p[0], *p[k + 1:])], n, score))
    rows.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank = Counter()
    out = []
    for r in rows:
        rank[r[0]] += 1
        if rank[r[0]] <= top:
            out.append((r[0], rank[r[0]], *r[1:]))
    return out


def rows(df):
    return sorted((tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect()),
                  key=lambda r: r[:2])


def corpus():
    draw = random.Random(2)
    words = ["New", "york", "the", "of", "Straße", "naïve", "x" * 90, "x" * 89 + "y", "a\x0bb", "ça", "tokyo東京"]
    docs = [(draw.choice(["en", "en", "en", "fr", None, "und", ""]),
             "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ", ", ".", "\n"]) for _ in range(draw.randrange(200))))
            for _ in range(150)]
    docs += [("en", "New York City hall is big. " * 40), ("en", "x x x x x x " * 30), ("en", None), ("fr", ""), (None, " , . "), ("de", "alone")]
    return docs + docs[:5]


@pytest.mark.parametrize("dictionary, most", [(collocations.DICTIONARY, collocations.PHRASES), (0, 250)])
def test_phrases_equal_brute_force(spark, dictionary, most):
    docs = corpus()
    frame = spark.createDataFrame([(i, t, n, 1) for i, (n, t) in enumerate(docs)], "code long, text string, lang string, n int").repartition(5)
    want = brute(docs, 8, 60)
    assert rows(collocations.phrases(frame, 8, 5, 60, dictionary=dictionary, most=most)) == sorted(want, key=lambda r: r[:2])
    assert {r[0] for r in want} >= {"en", "fr", "und", ""}


def test_no_phrases(spark):
    frame = spark.createDataFrame([("en", "a b c"), (None, None)], "lang string, text string")
    assert collocations.phrases(frame).collect() == []
    assert collocations.phrases(frame.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**14
    counts = spark.createDataFrame([([1, 2], big - 1)], "codes array<int>, n long")
    words = spark.createDataFrame([("en", "a", 1, big + 7), ("en", "b", 2, big + 1)], "lang string, word string, code int, n long")
    totals = spark.createDataFrame([("en", 9 * 10**17)], "lang string, n long")
    row = collocations.score(counts, words, totals, 100).first()
    assert row.score == 1000 * (big - 1) * 9 * 10**17 // ((big + 7) * (big + 1))


def test_trie_finds_all_sequences():
    draw = np.random.default_rng(1)
    codes = np.minimum(draw.zipf(1.4, (9000, 5)), 400)
    sequences = [np.unique(codes[:2000 // k, :k], axis=0) for k in range(2, 6)]
    trie = Trie(sequences, 400)
    known = {tuple(r[:j]) for s in sequences for r in s.tolist() for j in range(2, len(r) + 1)}
    text = codes.ravel()[:20000].astype(np.int32)
    text[::17] = 0
    for d, (at, state) in enumerate(trie.advance(text, 5), 1):
        here = [tuple(text[i:i + d].tolist()) for i in at]
        if d > 1:
            assert at.tolist() == [i for i in range(len(text) - d + 1) if tuple(text[i:i + d].tolist()) in known]
            assert len(set(here)) == len(set(zip(here, state.tolist()))) == len(set(state.tolist()))
