"""Topic coherence c_v (Röder, Both, Hinneburg 2015) over boolean sliding windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from eventlens.session import cut_lineage

# Window size and smoothing of the measure.
WINDOW = 110
EPSILON = 1e-12

BLOCK = 4_096           # windows looked at together


def window_counts(docs: DataFrame, topic_words: DataFrame, tokens: str = "tokens",
                  window: int = WINDOW) -> DataFrame:
    """(a, b, n): windows that hold both words, for words of a common topic, a <= b.

    a = b counts the windows that hold the word; the row with NULL words counts
    all windows. A document of fewer tokens than ``window`` is one window.

    Each task slides over its own documents and emits one partial count per pair of
    words of a common topic, so task memory and the shuffle are bounded by the
    listed words of each topic squared, not by the text. Only the topic words'
    positions leave the JVM. The counts are written once, since Spark would run
    the Python part again for each of their uses.
    """
    by_topic: dict = {}
    for row in topic_words.select("topic", "word").collect():
        by_topic.setdefault(row.topic, set()).add(row.word)
    words = sorted(set().union(*by_topic.values()))
    number = {w: i for i, w in enumerate(words)}
    # words of a common topic as one sorted number per pair, the smaller word first
    codes = [np.zeros(0, dtype=np.int64)]
    for members in by_topic.values():
        ids = np.array(sorted(number[w] for w in members), dtype=np.int64)
        first, second = np.triu_indices(len(ids))
        codes.append(ids[first] * len(words) + ids[second])
    pairs = np.unique(np.concatenate(codes))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both = np.zeros(len(pairs), dtype=np.int64)
        windows = 0
        for batch in batches:
            for length, at, found in zip(batch["length"], batch["at"], batch["found"]):
                last = max(length - window, 0)          # start of the last window
                windows += last + 1
                if len(at) == 0:
                    continue
                at = np.asarray(at)
                present, column = np.unique([number[w] for w in found], return_inverse=True)
                first, second = np.triu_indices(len(present))
                code = present[first] * len(words) + present[second]
                place = np.searchsorted(pairs, code)
                known = pairs[np.minimum(place, len(pairs) - 1)] == code
                first, second, place = first[known], second[known], place[known]
                for start in range(0, last + 1, BLOCK):
                    stop = min(start + BLOCK, last + 1)
                    # tokens seen by any window that starts in [start, stop)
                    some = slice(*np.searchsorted(at, [start, stop - 1 + window]))
                    edges = np.zeros((stop - start + 1, len(present)), dtype=np.int32)
                    enter = np.clip(at[some] - window + 1, start, stop - 1) - start
                    leave = np.clip(at[some] + 1, start, stop) - start
                    # a document shorter than the window is seen whole
                    leave = np.maximum(leave, enter + 1)
                    np.add.at(edges, (enter, column[some]), 1)
                    np.add.at(edges, (leave, column[some]), -1)
                    held = (np.cumsum(edges, axis=0)[:-1] > 0).astype(np.float64)
                    both[place] += (held.T @ held).astype(np.int64)[first, second]
        seen = np.flatnonzero(both)
        a, b = np.divmod(pairs[seen], len(words))
        yield pd.DataFrame({"a": [None, *(words[i] for i in a)],
                            "b": [None, *(words[i] for i in b)],
                            "n": [windows, *both[seen]]})

    placed = F.filter(F.transform(F.col(tokens), lambda t, i: F.struct(
        t.alias("word"), i.alias("at"))), lambda p: p["word"].isin(*words))
    found = docs.select(F.size(tokens).alias("length"), placed.alias("_p")).select(
        "length", F.col("_p.at").alias("at"), F.col("_p.word").alias("found"))
    partial = found.mapInPandas(count, "a string, b string, n long")
    return cut_lineage(partial.groupBy("a", "b").agg(F.sum("n").alias("n")))


def npmi(pair: Column, a: Column, b: Column) -> Column:
    """Normalised pointwise mutual information of three probabilities."""
    return F.log((pair + EPSILON) / (a * b)) / -F.log(pair + EPSILON)


def npmi_pairs(topic_words: DataFrame, counts: DataFrame) -> DataFrame:
    """(topic, word, other, n_both, npmi) for every ordered pair of a topic's words.

    A word that no window holds has an NPMI of 0 with every word.
    Both inputs are as small as the topics: words per topic squared, times topics.
    """
    total = counts.where(F.col("a").isNull()).select("n").scalar()
    seen = counts.where(F.col("a").isNotNull())
    single = seen.where(F.col("a") == F.col("b")).select(F.col("a").alias("w"),
                                                         F.col("n").alias("n_w"))
    x = topic_words.select("topic", "word")
    y = topic_words.select("topic", F.col("word").alias("other"))
    pairs = (x.join(y, "topic")
             .withColumn("a", F.least("word", "other"))
             .withColumn("b", F.greatest("word", "other"))
             .join(seen, ["a", "b"], "left")
             .join(single.select(F.col("w").alias("word"), F.col("n_w").alias("n_word")), "word", "left")
             .join(single.select(F.col("w").alias("other"), F.col("n_w").alias("n_other")),
                   "other", "left")
             .withColumn("n_both", F.coalesce("n", F.lit(0).cast("long"))))
    p = [F.col(c) / total for c in ("n_both", "n_word", "n_other")]
    return pairs.select("topic", "word", "other", "n_both",
                        F.coalesce(npmi(*p), F.lit(0.0)).alias("npmi"))


def coherence_by_topic(pairs: DataFrame) -> DataFrame:
    """(topic, c_v): mean cosine between each word's NPMI vector and the topic's summed one."""
    whole = pairs.groupBy("topic", "other").agg(F.sum("npmi").alias("topic_npmi"))
    v, t = F.col("npmi"), F.col("topic_npmi")
    cosine = (pairs.join(whole, ["topic", "other"]).groupBy("topic", "word")
              .agg(F.coalesce(F.try_divide(F.sum(v * t), F.sqrt(F.sum(v * v)) * F.sqrt(F.sum(t * t))),
                              F.lit(0.0)).alias("c")))
    return cosine.groupBy("topic").agg(F.avg("c").alias("c_v"))


def coherence(docs: DataFrame, topic_words: DataFrame, tokens: str = "tokens",
              window: int = WINDOW) -> DataFrame:
    """One row: the mean c_v over topics."""
    pairs = npmi_pairs(topic_words, window_counts(docs, topic_words, tokens, window))
    return coherence_by_topic(pairs).agg(F.avg("c_v").alias("c_v"),
                                         F.count(F.lit(1)).alias("topics"))
