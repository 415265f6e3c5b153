"""Bags of words, vocabulary, collocations and lexicon lemmas over token arrays.

Input frames hold one row per document with an array column of tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlens.operators.joins import MAX_BROADCAST_ROWS, fits, lookup_join
from eventlens.operators.ranking import number_rows, top_k_per_group
from eventlens.session import cut_lineage

# Collocation and part-of-speech settings of the training job.
MIN_PAIR_COUNT = 5
SCORE_THRESHOLD = 100
CONTENT_POS = ("NOUN", "VERB", "ADJ", "ADV")

#: Tokens of one block, whose distinct ones are looked up together; a longer document is a block of its own.
BLOCK_TOKENS = 1 << 19


def spell(docs: DataFrame, *keep: str | Column, tokens: str = "tokens") -> DataFrame:
    """(keep…, token): one row per token.

    The outer form keeps Spark from adding a size test below the generator, which
    would make every document's tokens a second time, and before a shuffle.
    """
    return (docs.select(*keep, F.explode_outer(tokens).alias("token"))
                .where(F.col("token").isNotNull()))


def bag_of_words(docs: DataFrame, key: str, tokens: str = "tokens") -> DataFrame:
    """(key, token, n) rows, counted inside each document's row: nothing is shuffled.

    In the sorted array equal tokens are neighbours; the distance from one run's
    start to the next is the run's count.
    """
    s, starts = F.col("_sorted"), F.col("_starts")
    return (docs.select(key, F.sort_array(tokens).alias("_sorted"))
            .select(key, "_sorted", F.filter(
                F.sequence(F.lit(0), F.greatest(F.size("_sorted") - 1, F.lit(0))),
                lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))).alias("_starts"))
            .select(key, F.inline_outer(F.transform(starts, lambda at, j: F.struct(
                F.get(s, at).alias("token"),
                (F.coalesce(F.get(starts, j + 1), F.size(s)) - at).cast("long").alias("n")))))
            .where(F.col("token").isNotNull()))


def _sizes(lists: pa.Array) -> np.ndarray:
    """Tokens of each list; a null list has none. ``lists.flatten()`` holds as many."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _codes(flat: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct tokens, place of each token among them, -1 for null)"""
    coded = flat.dictionary_encode()
    return coded.dictionary, pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (tokens) to (token, doc_freq, term_freq), one row for a batch's equal tokens."""
    for batch in batches:
        lists = batch.column(0)
        words, code = _codes(lists.flatten())
        owner = np.repeat(np.arange(len(lists)), _sizes(lists))[code >= 0]
        code = code[code >= 0]
        once = np.unique(owner * max(len(words), 1) + code) % max(len(words), 1)
        once = once[once != pc.index(words, "").as_py()]    # what a lemma may leave is no word of a document
        yield pa.RecordBatch.from_arrays(
            [words, *(pa.array(np.bincount(c, minlength=len(words)), pa.int64()) for c in (once, code))],
            ["token", "doc_freq", "term_freq"])


def vocabulary(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(token, doc_freq, term_freq).

    Both frequencies are counted by batch in the task, and are plain sums from
    there: a frequent token is one row per task in the shuffle. The empty token, which
    a lemma may leave, is in no document, so no dictionary has it.
    """
    counted = docs.select(tokens).mapInArrow(_count_tokens, "token string, doc_freq long, term_freq long")
    return counted.groupBy("token").agg(F.sum("doc_freq").alias("doc_freq"), F.sum("term_freq").alias("term_freq"))


def number_vocabulary(vocab: DataFrame) -> DataFrame:
    """Add ``token_id``: 0-based, in token order."""
    return number_rows(vocab, ["token"], "token_id")


def encode_bag(bag: DataFrame, key: str, numbered: DataFrame) -> DataFrame:
    """(key, token_id, n); tokens the vocabulary lacks are dropped."""
    ids = numbered.select("token", "token_id")
    return lookup_join(bag, ids, ["token"], [key]).select(key, "token_id", "n")


def corpus_stats(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """One row: documents, tokens, distinct tokens. The text is read once."""
    counts = (docs.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), F.col(tokens)))
                           .alias("token"))
                  .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    # the NULL that leads every document counts the documents
    is_doc = F.col("token").isNull()
    return counts.agg(F.sum(F.when(is_doc, F.col("n"))).alias("documents"),
                      F.sum(F.when(~is_doc, F.col("n"))).alias("tokens"),
                      F.count("token").alias("distinct_tokens"))


def _adjacent(docs: DataFrame, *keep: str, tokens: str = "tokens") -> DataFrame:
    """(keep…, pos, a, b): each token with its right neighbour, the empty string after the
    last; pos is 0-based."""
    t = F.col(tokens)
    right = F.concat(F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))), F.array(F.lit("")))
    return (docs.select(*keep, F.posexplode_outer(
                F.arrays_zip(t.alias("a"), right.alias("b"))).alias("pos", "_p"))
            .select(*keep, "pos", "_p.a", F.coalesce("_p.b", F.lit("")).alias("b"))
            .where(F.col("a").isNotNull()))


def _right(code: np.ndarray, sizes: np.ndarray, none: int) -> np.ndarray:
    """The code to the right of each; ``none`` where its document ends, or for a null."""
    right = np.full(len(code), none, np.int64)
    right[:-1] = code[1:]
    right[np.cumsum(sizes[sizes > 0]) - 1] = none
    right[right < 0] = none
    return right


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (tokens) to (a, b, n), one row for a batch's equal pairs; b is empty at an end."""
    for batch in batches:
        lists = batch.column(0)
        words, code = _codes(lists.flatten())
        words = pa.concat_arrays([words, pa.array([""], words.type)])
        pair = (code * len(words) + _right(code, _sizes(lists), len(words) - 1))[code >= 0]
        pair, n = np.unique(pair, return_counts=True)
        yield pa.RecordBatch.from_arrays([words.take(pa.array(pair // len(words))), words.take(pa.array(pair % len(words))),
                                          pa.array(n, pa.int64())], ["a", "b", "n"])


def _pair_counts(docs: DataFrame, tokens: str) -> DataFrame:
    """(a, b, n_ab), with b empty for tokens that end a document."""
    counted = docs.select(tokens).mapInArrow(_count_pairs, "a string, b string, n long")
    return counted.groupBy("a", "b").agg(F.sum("n").alias("n_ab"))


def bigram_counts(docs: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(a, b, n_ab) for every pair of neighbours."""
    return _pair_counts(docs, tokens).where(F.col("b") != "")


def bigram_scores(docs: DataFrame, tokens: str = "tokens", min_count: int = MIN_PAIR_COUNT,
                  threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """Collocations: (a, b, n_a, n_b, n_ab, score) with score above the threshold.

    score = (n_ab - min_count) * V / (n_a * n_b), after Mikolov et al. 2013.
    V counts distinct tokens and distinct pairs together. A positive threshold
    can only be passed by n_ab > min_count, and both tokens of such a pair occur
    more than min_count times, so the joins see counted, filtered tables only.

    The text is read and shuffled once: every occurrence of a token starts one
    pair or ends a document, so its count is the sum over its right neighbours.
    The pair counts are written once, as four steps below read them.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    pairs = cut_lineage(_pair_counts(docs, tokens))
    words = pairs.groupBy("a").agg(F.sum("n_ab").alias("n"))
    size = (words.agg(F.count(F.lit(1))).scalar()
            + pairs.where(F.col("b") != "").agg(F.count(F.lit(1))).scalar())
    common = words.where(F.col("n") > min_count)
    real = lambda c: F.col(c).cast("double")  # noqa: E731  products of counts outgrow a long
    score = (real("n_ab") - min_count) * size.cast("double") / (real("n_a") * real("n_b"))
    # no token is empty, so the join on b drops the document ends
    return (pairs.where(F.col("n_ab") > min_count)
            .join(common.select("a", F.col("n").alias("n_a")), "a")
            .join(common.select(F.col("a").alias("b"), F.col("n").alias("n_b")), "b")
            .withColumn("score", score)
            .where(F.col("score") > threshold)
            .select("a", "b", "n_a", "n_b", "n_ab", "score"))


def apply_bigrams(docs: DataFrame, phrases: DataFrame, key: str,
                  tokens: str = "tokens") -> DataFrame:
    """Replace ``tokens`` by the array in which each phrase is one token ``a_b``.

    Left to right, a merged token takes no part in the next pair: of a run of
    neighbouring matches every other one is taken, starting with its first.
    Phrases of checked size are broadcast, and each document changes in its own row:
    nothing is shuffled, and keys may repeat. A document with a null key is left alone.
    """
    change = bigram_change(phrases)
    if change is None:
        return _apply_bigrams_by_join(docs, phrases, key, tokens)
    changed = docs.withColumn("_changed", change_tokens(tokens, change))
    return changed.withColumn(tokens, F.when(F.col(key).isNotNull(), F.col("_changed")).otherwise(F.col(tokens))).select(*docs.columns)


def _apply_bigrams_by_join(docs: DataFrame, phrases: DataFrame, key: str, tokens: str) -> DataFrame:
    """The same for more phrases. Only matched positions are shuffled to find the runs, one row each."""
    matches = lookup_join(_adjacent(docs, key, tokens=tokens), phrases.select("a", "b"),
                          ["a", "b"], [key, "pos"], how="left_semi").select(key, "pos")
    in_doc = Window.partitionBy(key).orderBy("pos")
    in_run = Window.partitionBy(key, "_run")
    taken = (matches.withColumn("_run", F.col("pos") - F.row_number().over(in_doc))
             .withColumn("_from", F.min("pos").over(in_run))
             .where((F.col("pos") - F.col("_from")) % 2 == 0)
             .groupBy(key).agg(F.sort_array(F.collect_list("pos")).alias("_at")))
    return (docs.join(taken, key, "left")
            .withColumn(tokens, _merge_pairs(F.col(tokens), F.coalesce("_at", F.array())))
            .drop("_at"))


def _merge_pairs(tokens: Column, at: Column) -> Column:
    """Splice ``a_b`` in at each position of ``at``: the plain stretches between, kept whole."""
    end = F.size(tokens)
    starts = F.concat(F.array(F.lit(0)), F.transform(at, lambda p: p + 2))
    stops = F.concat(at, F.array(end))
    return F.flatten(F.zip_with(starts, stops, lambda s, e: F.concat(
        F.slice(tokens, s + 1, e - s),
        F.when(e < end, F.array(F.concat_ws("_", F.get(tokens, e), F.get(tokens, e + 1))))
         .otherwise(F.array().cast("array<string>")))))


Change = Callable[[pa.Array], pa.Array]


def change_tokens(tokens: str | Column, change: Change) -> Column:
    """The token lists changed, each in its row; ``change`` sees those of a batch."""
    return F.arrow_udf(change, "array<string>")(tokens)


def _lists(values: pa.Array, kept: np.ndarray, sizes: np.ndarray, null: pa.Array | None = None) -> pa.Array:
    """Lists of ``sizes`` tokens, less those not ``kept``; ``values`` has the kept ones only."""
    ends = np.cumsum(sizes)
    before = np.concatenate([[0], np.cumsum(kept)])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], before[ends]]), pa.int32()), values, mask=null)


def bigram_change(phrases: DataFrame, max_rows: int | None = None) -> Change | None:
    """What :func:`apply_bigrams` does to token lists, with the phrases as a broadcast; None
    if there are more than ``max_rows``."""
    if not fits(phrases, max_rows or MAX_BROADCAST_ROWS):
        return None
    known = phrases.select("a", "b").dropna().distinct().toArrow()
    a, b = known["a"].combine_chunks(), known["b"].combine_chunks()
    words = pa.concat_arrays([a, b]).unique()
    place = [pc.index_in(c, words).to_numpy(zero_copy_only=False).astype(np.int64) for c in (a, b)]
    pair = place[0] * len(words) + place[1]
    order = np.argsort(pair)
    joined = pc.binary_join_element_wise(a, b, "_").take(pa.array(order))
    shared = phrases.sparkSession.sparkContext.broadcast((words, pair[order], joined))

    def change(lists: pa.Array) -> pa.Array:
        words, pairs, joined = shared.value
        flat, sizes = lists.flatten(), _sizes(lists)
        if not len(pairs) or not len(flat):
            return lists
        code = pc.fill_null(pc.index_in(flat, words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        right = _right(code, sizes, -1)
        pair = np.where((code >= 0) & (right >= 0), code * len(words) + right, -1)
        found = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
        at = np.flatnonzero(pairs[found] == pair)
        # places in a run of neighbouring matches, which is within one document
        starts = np.diff(at, prepend=-2) > 1
        run = np.maximum.accumulate(np.where(starts, np.arange(len(at)), 0))
        taken = at[(np.arange(len(at)) - run) % 2 == 0]
        source = np.arange(len(flat))
        source[taken] = len(flat) + found[taken]
        kept = np.ones(len(flat), bool)
        kept[taken + 1] = False
        values = pa.concat_arrays([flat, joined.cast(flat.type)]).take(pa.array(source[kept]))
        return _lists(values, kept, sizes, lists.is_null())
    return change


def lemma_change(lexicon: DataFrame, allowed_pos: tuple[str, ...] | None = CONTENT_POS,
                 max_rows: int | None = None) -> Change | None:
    """What :func:`lemmas` does to token lists, with the lexicon as a broadcast; None if it has
    more than ``max_rows`` rows, or a surface twice. A null list loses its tokens, and is empty."""
    if not fits(lexicon, max_rows or MAX_BROADCAST_ROWS):
        return None
    table = lexicon.select("surface", F.coalesce("lemma", "surface").alias("lemma"), "pos").where("surface IS NOT NULL").toArrow()
    surface, lemma, pos = (table[n].combine_chunks() for n in ("surface", "lemma", "pos"))
    if len(surface.unique()) < len(surface):
        return None
    right = np.ones(len(pos), bool) if allowed_pos is None else pc.is_in(
        pos, pa.array(allowed_pos, pos.type)).to_numpy(zero_copy_only=False)
    shared = lexicon.sparkSession.sparkContext.broadcast((surface, lemma, right))

    return lambda lists: _lemmatised(lists, *shared.value, allowed_pos is None)


def _lemmatised(lists: pa.Array, surface: pa.Array, lemma: pa.Array, right: np.ndarray, unknown: bool) -> pa.Array:
    """Token lists with the lemmas of the surfaces whose part of speech is right; with ``unknown``
    every token stays, those without a surface as they are."""
    flat, sizes = lists.flatten(), _sizes(lists)
    found = pc.fill_null(pc.index_in(flat, surface), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    if unknown:
        kept = pc.is_valid(flat).to_numpy(zero_copy_only=False)
        source = np.where(found < 0, np.arange(len(flat)), len(flat) + found)
        values = pa.concat_arrays([flat, lemma.cast(flat.type)])
    else:
        kept = found >= 0
        kept[kept] = right[found[kept]]
        source, values = found, lemma.cast(flat.type)
    return _lists(values.take(pa.array(source[kept])), kept, sizes)


def lemmas(docs: DataFrame, lexicon: DataFrame, key: str, tokens: str = "tokens",
           allowed_pos: tuple[str, ...] | None = CONTENT_POS) -> DataFrame:
    """(key, tokens): each token's lemma, kept if its part of speech is allowed.

    ``lexicon`` is (surface, lemma, pos) with unique surfaces. With
    ``allowed_pos=None`` every token is kept, unknown ones as they are.
    Documents that lose all tokens keep an empty array. Those of one key are one,
    their tokens by place.

    If no key repeats, a lexicon of checked size is broadcast, and a document changes in its
    own row; of a larger one each block of documents gets the rows of its distinct tokens.
    """
    if _repeats(docs, key):
        return _lemmas_by_join(docs, lexicon, key, tokens, allowed_pos)
    change = lemma_change(lexicon, allowed_pos, MAX_BROADCAST_ROWS)
    if change is not None:
        return docs.select(key, change_tokens(tokens, change).alias(tokens))
    if _repeats(lexicon.where("surface IS NOT NULL"), "surface"):
        return _lemmas_by_join(docs, lexicon, key, tokens, allowed_pos)
    return _lemmas_by_block(docs, lexicon, key, tokens, allowed_pos)


def _repeats(df: DataFrame, key: str) -> bool:
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (key, tokens) to (block, key, tokens); a task's documents in order, BLOCK_TOKENS to a block."""
    block, room = TaskContext.get().partitionId() << 33, BLOCK_TOKENS
    for batch in batches:
        ids = np.empty(batch.num_rows, np.int64)
        for i, n in enumerate(_sizes(batch.column(1)).tolist()):
            if n > room:
                block, room = block + 1, BLOCK_TOKENS
            ids[i], room = block, room - n
        yield pa.RecordBatch.from_arrays([pa.array(ids), *batch.columns], ["_block", *batch.schema.names])


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow: (block, tokens) to (block, surface), once for a batch's equal tokens of a block."""
    for batch in batches:
        block = np.asarray(batch.column(0))
        cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            words = batch.column(1).slice(i, j - i).flatten().unique().drop_null()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), block[i])), words], ["_block", "surface"])


def _lemmas_by_block(docs: DataFrame, lexicon: DataFrame, key: str, tokens: str,
                     allowed_pos: tuple[str, ...] | None) -> DataFrame:
    """The same for any lexicon of unique surfaces, and keys that do not repeat. A token is
    shuffled once for all its occurrences in a block; the documents move by block, not by token."""
    rows = docs.select(key, tokens)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    placed = cut_lineage(rows.mapInArrow(_in_blocks, f"_block long, {kinds}"))
    known = lexicon.select("surface", F.coalesce("lemma", "surface").alias("lemma"), "pos")
    if allowed_pos is not None:     # a token that is not found is dropped
        known = known.where(F.col("pos").isin(*allowed_pos))
    found = (placed.select("_block", tokens).mapInArrow(_distinct_tokens, "_block long, surface string")
             .join(known.select("surface", "lemma"), "surface"))

    def run(own: pa.Table, words: pa.Table) -> pa.Table:
        lists, surface, lemma = (own.column(tokens), words.column("surface"), words.column("lemma"))
        lists, surface, lemma = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (lists, surface, lemma))
        changed = _lemmatised(lists, surface, lemma, np.ones(len(surface), bool), allowed_pos is None)
        return pa.table({key: own.column(key), tokens: changed})
    return placed.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(run, kinds)


def _lemmas_by_join(docs: DataFrame, lexicon: DataFrame, key: str, tokens: str,
                    allowed_pos: tuple[str, ...] | None) -> DataFrame:
    """The same for any lexicon and any keys."""
    spelled = docs.select(key, F.posexplode_outer(tokens).alias("pos_in_doc", "surface"))
    found = lookup_join(spelled, lexicon, ["surface"], [key, "pos_in_doc"], how="left")
    lemma = F.coalesce("lemma", "surface")
    kept = lemma.isNotNull() if allowed_pos is None else F.col("pos").isin(*allowed_pos)
    entry = F.when(kept, F.struct("pos_in_doc", lemma.alias("lemma")))
    return (found.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
            .select(key, F.col("_l.lemma").alias(tokens)))


def top_tokens(docs: DataFrame, group: str, k: int, tokens: str = "tokens") -> DataFrame:
    """(group, rank, token, n, total): each group's ``k`` most frequent tokens."""
    counts = (spell(docs, group, tokens=tokens)
              .groupBy(group, "token").agg(F.count(F.lit(1)).alias("n")))
    # from the counts, so that the text is read once
    totals = counts.groupBy(group).agg(F.sum("n").alias("total"))
    top = top_k_per_group(counts, [group], [F.desc("n"), F.asc("token")], k)
    return top.join(totals, group).select(group, "rank", "token", "n", "total")
