import math
import random

import numpy as np
import pytest

from checks import model as registered
from eventlens.plans import online, topic_model

rng = random.Random(3)
WORDS = [f"w{i:02}" for i in range(40)]
DOCS = [(f"d{i:03}", rng.choices(WORDS[i % 3 * 10:i % 3 * 10 + 20], k=rng.choice([0, 1, 5, 60]))) for i in range(110)]
TOPICS, PASSES, CHUNK, SEED = 4, 3, 30, 7


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id string, tokens array<string>").repartition(5)


def psi(x):
    x = float(x)
    h = 1e-3    # a difference of the fourth order
    return (math.lgamma(x - 2 * h * x) - 8 * math.lgamma(x - h * x) + 8 * math.lgamma(x + h * x) - math.lgamma(x + 2 * h * x)) / (12 * h * x)


def plainly(words):
    """(topics, prior) by the method's steps as published, one document after the other."""
    place = {w: i for i, w in enumerate(words)}
    eta, prior = 1 / TOPICS, np.full(TOPICS, 1 / TOPICS)
    counts = np.random.default_rng(SEED).gamma(100.0, 0.01, (len(words), TOPICS))
    log = lambda p: np.array([psi(x) for x in p]) - psi(p.sum())
    rows, seen = sorted(DOCS), 0
    for turn in range(PASSES):
        for low in range(0, len(rows), CHUNK):
            chunk = rows[low:low + CHUNK]
            topics = np.exp(np.column_stack([log(c) for c in (counts + eta).T]))
            found, logs = np.zeros_like(counts), []
            parts = [[d for i, d in enumerate(chunk) if i * online.PARTS // CHUNK == p] for p in range(online.PARTS)]
            for p, part in enumerate(parts):
                if not part:
                    continue
                starts = np.random.default_rng([SEED, turn, low // CHUNK * online.PARTS + p]).gamma(100.0, 0.01, (len(part), TOPICS))
                for (_, tokens), gamma in zip(part, starts):
                    ids = sorted({place[t] for t in tokens})
                    n = np.array([tokens.count(words[i]) for i in ids], float)
                    beta = topics[ids]
                    theta = np.exp(log(gamma))
                    for _ in range(50):
                        last, gamma = gamma, prior + theta * ((n / (beta @ theta)) @ beta)
                        theta = np.exp(log(gamma))
                        if np.abs(gamma - last).mean() < 1e-3:
                            break
                    found[ids] += np.outer(n / (beta @ theta), theta) * beta
                    logs.append(log(gamma))
            weight = (1 + turn + seen / CHUNK) ** -0.5
            prior = online.learned_prior(prior, np.mean(logs, axis=0), weight)
            counts = (1 - weight) * counts + weight * len(rows) / len(chunk) * found
            seen += len(chunk)
    return counts + eta, prior


def test_every_document_counts_once_in_each_pass(docs):
    """Chunks in order, all words, the prior learnt: as a plain loop has it."""
    model = topic_model.train(docs, "id", topic_model.Training(topics=TOPICS, passes=PASSES, chunk=CHUNK, seed=SEED))
    topics, prior = plainly(model.stages[0].vocabulary)
    np.testing.assert_allclose(model.stages[1].topicsMatrix().toArray(), topics, rtol=1e-4)
    np.testing.assert_allclose(model.stages[1].estimatedDocConcentration().toArray(), prior, rtol=1e-4)
    assert len(set(prior.round(6))) > 1


def test_the_registered_training_leaves_nothing_out():
    settings = registered.SETTINGS
    assert (settings.topics, settings.passes, settings.chunk, settings.optimizer) == (22, 10, 1000, "online")
    assert settings.least(10**9) == 1       # every word is in the dictionary


def test_the_common_factor_changes_nothing():
    few = online.Topics(5, 3, 0.5, 1)
    want = few.matrix().copy() - 0.5
    r = np.random.default_rng(2)
    for i in range(400):
        weight, words = (1.0, 0.9, 0.3)[min(i, 2)], r.choice(5, 2, replace=False)
        counts = r.random((2, 3)).astype(np.float32)
        few.blend(weight, [(words, counts)])
        want *= 1 - weight
        want[words] += weight * counts
    np.testing.assert_allclose(few.sums, want.sum(axis=0))
    np.testing.assert_allclose(few.matrix(), want + 0.5)


def test_learned_prior_is_the_maximum():
    """With full weight Newton's steps end where the expectation of E[log p] is met."""
    mean, prior = np.array([-2.0, -1.0, -3.0]), np.full(3, 1 / 3)
    for _ in range(30):
        prior = online.learned_prior(prior, mean, 1.0)
    np.testing.assert_allclose([psi(x) - psi(prior.sum()) for x in prior], mean, atol=1e-6)
    assert online.learned_prior(np.array([1e-3, 1.0]), np.array([-1e6, -1.0]), 1.0).min() > 0


def test_one_text_as_dictionary(spark):
    for words in (["b", "a b", "ä"], ["x\0y", "z"]):
        assert topic_model._bagger(spark, words, "tokens").vocabulary == words
