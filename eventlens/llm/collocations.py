"""Phrases of two to five words that stand together more often than their parts explain.

Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and pieces into
words at spaces and tabs. Everything is counted by language.

1. Words are counted; those with at least ``least`` occurrences get a code, frequent ones first.
2. The corpus is written once as codes, without its other words: a phrase that holds a rare
   word is rare itself. A break (0) stands wherever no phrase can go on.
3. Level by level, the candidates of k words are found: both their parts of k-1 words must be
   candidates (Apriori), and they must be seen at least ``least`` times. The candidates of
   k-1 words are broadcast as a double-array trie, through which the states of all text
   positions advance at once; pairs of neighbouring accepted positions are summed in the
   task, then over all tasks.
4. The trie of all candidates is broadcast, all positions advance through it level by level,
   the accepting states are counted by ``bincount``, and the counts of the tasks are summed.

Tries hold at most PHRASES sequences; more candidates are dealt to several tries, each of
which is run over all codes. The dictionary of words is broadcast up to DICTIONARY words;
more are joined to the words by shuffle. Words are told apart by 128 bits of hash and, where
counted, by themselves.

A phrase of k words is cut after each of its first k-1 words into parts with counts l and r;
its score is the lowest floor(1000 a n / (l r)), a being its own count and n all words of the
language. Phrases inside a longer candidate that occurs as often are dropped.

Defined results
    null language: ``und``; null or empty text, texts without words: nothing
    repeated documents: each counts; ties: see the order in :func:`phrases`
    very long texts: whole; no frequent phrase or no documents: no rows
    other columns: not read, whatever their names
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from eventlens.operators.ranking import number_rows, top_k_per_group
from eventlens.session import cut_lineage
from eventlens.llm.byte_words import Words, classes, parts
from eventlens.llm.common import table, whole
from eventlens.llm.double_array import Trie
from eventlens.llm.shingles import mix

LEAST, LONGEST, TOP = 100, 5, 2000
#: Words in a broadcast dictionary (20 bytes each) and sequences in a broadcast trie.
DICTIONARY, PHRASES = 4_000_000, 1_000_000
#: Codes whose phrases a task sums at a time.
CODES = 2_000_000
WORD = classes(gaps=" \t", breaks=".,;:!?\n\x0b\x0c\r")


def keys(words: Words, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for (language, word) of each word; ``langs`` are those of the texts."""
    first, second = words.hashes()
    seed = {lang: xxhash.xxh3_128_intdigest(lang.encode()) for lang in set(langs)}
    low = np.array([seed[x] & 0xFFFFFFFFFFFFFFFF for x in langs], np.uint64)
    high = np.array([seed[x] >> 64 for x in langs], np.uint64)
    return mix(first ^ low[words.owner]), mix(second + high[words.owner])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, word, n), and the number of all words with a null word."""
    for part in parts(batches):
        langs = part.column("lang").to_pylist()
        words = Words(part.column("text"), WORD)
        a, b = keys(words, langs)
        order = np.lexsort((b, a))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(a[order].view(np.int64)) != 0) | (np.diff(b[order].view(np.int64)) != 0)
        at = np.flatnonzero(new)
        which = order[at]
        all_words = np.bincount(words.owner, minlength=len(langs))
        yield pa.RecordBatch.from_arrays(
            [pa.array([langs[i] for i in words.owner[which].tolist()] + langs, pa.string()),
             pa.concat_arrays([words.strings(which), pa.nulls(len(langs), pa.string())]),
             pa.array(np.concatenate([np.diff(at, append=len(order)), all_words]), pa.int64())], ["lang", "word", "n"])


def _hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, code) to (a, b, code)."""
    for batch in batches:
        words = Words(batch.column("word"), WORD)
        a, b = keys(words, batch.column("lang").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), batch.column("code")],
                                         ["a", "b", "code"])


class Dictionary:
    """Codes of words by their 128 bits."""

    def __init__(self, a: np.ndarray, b: np.ndarray, code: np.ndarray):
        order = np.lexsort((b, a))
        self.a, self.b, self.code = a[order], b[order], code[order].astype(np.int32)
        self.tries = int(np.unique(a, return_counts=True)[1].max(initial=0))     # words of one a

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The codes; 0 for other words."""
        out = np.zeros(len(a), np.int32)
        at = np.searchsorted(self.a, a)
        for _ in range(self.tries):
            inside = np.minimum(at, len(self.a) - 1)
            here = (at < len(self.a)) & (self.a[inside] == a) & (self.b[inside] == b)
            out[here] = self.code[inside[here]]
            at = at + 1
        return out


def line_up(codes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Codes with a 0 before each beginning, without words that have no coded neighbour."""
    at = np.arange(len(codes)) + np.cumsum(begins)
    out = np.zeros(len(codes) + int(begins.sum()) + 1, np.int32)
    out[at] = codes
    held = out > 0
    beside = np.zeros(len(out), bool)
    beside[1:] = held[:-1]
    beside[:-1] |= held[1:]
    out[~beside] = 0
    ended = np.zeros(len(out), bool)
    ended[1:] = out[:-1] > 0
    return out[(out > 0) | ended]


def _encode(shared) -> Callable:
    """For mapInArrow: (lang, text) to (codes), some texts in each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            words = Words(part.column("text"), WORD)
            codes = shared.value(*keys(words, part.column("lang").to_pylist()))
            yield pa.RecordBatch.from_arrays([pa.array([line_up(codes, words.begins).tobytes()], pa.binary())], ["codes"])
    return run


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, lang, text) to (row, k, begins, lang, word)."""
    for part in parts(batches):
        words = Words(part.column("text"), WORD)
        take = pa.array(words.owner)
        yield pa.RecordBatch.from_arrays(
            [part.column("row").take(take), pa.array(np.arange(len(words))), pa.array(words.begins),
             part.column("lang").take(take), words.strings(np.arange(len(words)))], ["row", "k", "begins", "lang", "word"])


def _line_up_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words: list of k, begins, code) to (codes)."""
    for batch in batches:
        rows = []
        for words in batch.column("words"):
            codes, begins = (np.asarray(words.values.field(n).to_numpy(zero_copy_only=False)) for n in ("code", "begins"))
            rows.append(line_up(codes.astype(np.int32), begins.astype(bool)).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["codes"])


def encode(texts: DataFrame, words: DataFrame, dictionary: int = DICTIONARY) -> DataFrame:
    """The corpus as a table of (codes), 32-bit integers of many texts in a row."""
    if words.count() <= dictionary:
        found = words.select("lang", "word", "code").mapInArrow(_hash_words, "a long, b long, code int").toArrow()
        a, b, code = (np.asarray(found[n].combine_chunks()) for n in ("a", "b", "code"))
        shared = texts.sparkSession.sparkContext.broadcast(Dictionary(a.view(np.uint64), b.view(np.uint64), code))
        return cut_lineage(texts.mapInArrow(_encode(shared), "codes binary"))
    rows = cut_lineage(texts.withColumn("row", F.monotonically_increasing_id()))
    single = cut_lineage(rows.select("row", "lang", "text").mapInArrow(
        _explode, "row long, k long, begins boolean, lang string, word string"))
    coded = single.join(words.select("lang", "word", "code"), ["lang", "word"], "left")
    # a row's words: no more than its text holds
    lists = coded.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("k", "begins", F.coalesce("code", F.lit(0)).alias("code")))).alias("words"))
    return cut_lineage(lists.select("words").mapInArrow(_line_up_rows, "codes binary"))


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Codes of the rows put together, about CODES at a time. Rows end with a break."""
    held, n = [], 0
    for batch in batches:
        for row in batch.column("codes"):
            codes = np.frombuffer(row.as_buffer(), np.int32)
            held += [codes, np.zeros(1, np.int32)]
            n += len(codes)
            if n >= CODES:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _extend(shared, k: int) -> Callable:
    """For mapInArrow: (codes) to (key, n); a key is the state of k-1 words and the next code."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, alone = shared.value
        for codes in _stretches(batches):
            *_, (at, state) = trie.advance(codes, k - 1)
            follows = np.zeros(len(codes) + 1, bool)
            if alone:       # the trie has all candidates, so the second part is known too
                follows[at] = True
            else:
                follows[:len(codes) - k + 2] = codes[k - 2:] > 0
            here = follows[at + 1]
            at, state = at[here], state[here]
            value, n = np.unique((state << 32) | codes[at + k - 1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n, pa.int64())], ["key", "n"])
    return run


def _tally(shared, depth: int) -> Callable:
    """For mapInArrow: (codes) to (key, n): how often each accepting state is reached."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, _ = shared.value
        for codes in _stretches(batches):
            counts = np.zeros(trie.size, np.int64)
            for length, (_, state) in enumerate(trie.advance(codes, depth), 1):
                if length > 1:
                    counts += np.bincount(state, minlength=trie.size)
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["key", "n"])
    return run


def _sequences(found: pa.Table, longest: int) -> list[np.ndarray]:
    lists = found["codes"].combine_chunks()
    size = np.asarray(lists.value_lengths())
    start, values = np.asarray(lists.offsets)[:-1], np.asarray(lists.values)
    return [values[start[size == k][:, None] + np.arange(k)].astype(np.int64) for k in range(2, longest + 1)]


def _tries(phrases: DataFrame, n_codes: int, longest: int, most: int):
    """(trie, whether it is the only one, sequences) of the phrases, dealt by their hash."""
    shards = -(-phrases.count() // most) or 1
    shard = F.pmod(F.xxhash64("codes"), F.lit(shards))
    for j in range(shards):
        sequences = _sequences(phrases.where(shard == j).select("codes").toArrow(), longest)
        yield Trie(sequences, n_codes), shards == 1, sequences


def _named(names: np.ndarray, rows: list[np.ndarray], extended: bool) -> Callable:
    """For mapInArrow: (key, n) to (codes, n). ``names`` are states in order, ``rows`` their codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.asarray(batch.column("key"))
            state = key >> 32 if extended else key
            lists = [rows[i] for i in np.searchsorted(names, state).tolist()]
            if extended:
                lists = [[*r, c] for r, c in zip(lists, (key & 0xFFFFFFFF).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), batch.column("n")], ["codes", "n"])
    return run


def _by_state(trie: Trie, sequences: list[np.ndarray]) -> tuple[np.ndarray, list[list[int]]]:
    names = np.concatenate(trie.states)
    rows = [r for s in sequences for r in s.tolist()]
    order = np.argsort(names)
    return names[order], [rows[i] for i in order.tolist()]


PHRASE = "codes array<int>, n long"


def candidates(corpus: DataFrame, n_codes: int, least: int, longest: int, most: int = PHRASES) -> DataFrame:
    """(codes) of the phrases of 2 to ``longest`` words with at least ``least`` occurrences."""
    sc = corpus.sparkSession.sparkContext

    def often(counted: DataFrame) -> DataFrame:
        return counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)

    pairs = often(corpus.mapInArrow(_extend(sc.broadcast((Trie([], n_codes), True)), 2), "key long, n long"))
    level = cut_lineage(pairs.select(F.array(F.shiftright("key", 32).cast("int"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).alias("codes")))
    found = level
    for k in range(3, longest + 1):
        longer = None
        for trie, alone, sequences in _tries(level, n_codes, k - 1, most):
            counted = often(corpus.mapInArrow(_extend(sc.broadcast((trie, alone)), k), "key long, n long"))
            rows = counted.mapInArrow(_named(*_by_state(trie, sequences), True), PHRASE).select("codes")
            longer = rows if longer is None else longer.unionByName(rows)
        level = cut_lineage(longer)
        found = found.unionByName(level)
    return found


def count(corpus: DataFrame, phrases: DataFrame, n_codes: int, longest: int, most: int = PHRASES) -> DataFrame:
    """(codes, n) of the phrases, counted on their tries. The result is a written table."""
    sc = corpus.sparkSession.sparkContext
    found = None
    for trie, alone, sequences in _tries(phrases, n_codes, longest, most):
        counted = corpus.mapInArrow(_tally(sc.broadcast((trie, alone)), longest), "key long, n long")
        names, rows = _by_state(trie, sequences)
        accepting = sc.broadcast(names)

        def own(batches):       # beginnings of a phrase may belong to another trie
            for batch in batches:
                yield batch.filter(pa.array(np.isin(np.asarray(batch.column("key")), accepting.value)))
        summed = counted.groupBy("key").agg(F.sum("n").alias("n"))
        rows = summed.mapInArrow(own, "key long, n long").mapInArrow(_named(names, rows, False), PHRASE)
        found = rows if found is None else found.unionByName(rows)
    return cut_lineage(found)


def score(counts: DataFrame, words: DataFrame, totals: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases that no longer one replaces."""
    parts_of = counts.select("codes", "n").unionByName(words.select(F.array("code").alias("codes"), "n"))
    some = counts.where(F.col("n") >= least).withColumnRenamed("n", "a")
    longer = some.where(F.size("codes") > 2).select(
        F.col("a").alias("longer"), F.explode(F.array(F.expr("slice(codes, 1, size(codes) - 1)"),
                                                      F.expr("slice(codes, 2, size(codes) - 1)"))).alias("inner"))
    # what stands inside a longer phrase as often also stands inside one with one word more
    kept = some.join(longer, (F.col("codes") == F.col("inner")) & (F.col("longer") >= F.col("a")), "left_anti")
    named = (kept.select("codes", F.posexplode("codes").alias("place", "code"))
             .join(words.select("code", "lang", "word"), "code").groupBy("codes")
             .agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
             .select("codes", "lang", F.array_join("words.word", " ").alias("phrase")))
    named = kept.join(named, "codes").join(totals.withColumnRenamed("n", "all_words"), "lang")
    cuts = named.select("*", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k"))
    cuts = (cuts.withColumn("left", F.expr("slice(codes, 1, k)")).withColumn("right", F.expr("slice(codes, k + 1, size(codes) - k)"))
            .join(parts_of.select(F.col("codes").alias("left"), F.col("n").alias("l")), "left")
            .join(parts_of.select(F.col("codes").alias("right"), F.col("n").alias("r")), "right"))
    number = "CAST({} AS DECIMAL(19, 0))".format
    value = F.expr(f"({number('1000 * a')} * {number('all_words')}) div ({number('l')} * {number('r')})")
    lowest = cuts.groupBy("codes", "lang", "phrase", "a", F.col("all_words").alias("n")).agg(
        F.min(F.struct(value.alias("score"), "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP,
            lang: str = "lang", text: str = "text", dictionary: int = DICTIONARY, most: int = PHRASES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases (None: all,
    without rank) by score, then count, both descending, then by the phrase's bytes."""
    if least < 1 or longest < 2:
        raise ValueError("phrases have two words at least, and occur at least once")
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), whole(text).alias("text"))
    counted = texts.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = cut_lineage(counted.where(F.col("word").isNull() | (F.col("n") >= least)))
    totals = counted.where("word IS NULL").select("lang", "n")
    words = number_rows(counted.where("word IS NOT NULL").withColumn("rarer", -F.col("n")), ["rarer", "lang", "word"], "code")
    words = cut_lineage(words.select("lang", "word", "n", (F.col("code") + 1).cast("int").alias("code")))
    n_codes = words.count()
    corpus = encode(texts, words, dictionary)
    found = candidates(corpus, n_codes, least, longest, most)
    scored = score(count(corpus, found, n_codes, longest, most), words, totals, least)
    if top is None:
        return scored
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    return top_k_per_group(scored, ["lang"], order, top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir):
    return phrases(table(spark, sf_dir, "documents", "lang", "text"))


ORACLE = f"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
grams AS (
    SELECT lang, k, array_to_string(words[s:s + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS s
          FROM pieces, range(1, {LONGEST + 1}) AS t(k) WHERE len(words) >= k)
    GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a FROM grams WHERE k >= 2 AND f >= {LEAST}),
kept AS (
    SELECT * FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM candidates x WHERE x.lang = c.lang AND x.k > c.k AND 100 * x.a >= 100 * c.a
        AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
    SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS first, array_to_string(w[j + 1:], ' ') AS rest
    FROM (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM kept)),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.j, x.f AS l, y.f AS r, t.n,
           ((1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = c.first JOIN grams y ON y.lang = c.lang AND y.phrase = c.rest
    JOIN totals t ON t.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= {TOP}
"""
