"""Repeated paragraphs and passages across documents.

Paragraphs (lines of as many words as a shingle has, five, or more) are compared by the
MinHash bands, exact Jaccard check and components of ``near_dups``, with bands tuned for
recall: 8 bands of 3 places find a pair at 0.8 with a probability of 0.997, and equal
paragraphs always. Lines are found on the bytes of whole texts and signed in the same task;
one row of equal lines goes on. ``least`` sets a greater least length; by default there is none.

A passage inside a paragraph has other neighbours in each document, so no paragraph shows it;
windows of 32 words do, and equal windows are one class. Taken are the window with the least
hash of every 20 consecutive ones (winnowing), so that equal runs of 51 words share a window
wherever they begin, and also those from each beginning of a sentence, which show some
shorter runs.

From a window both texts are followed to where they stop being equal, on both sides; the
result is that whole run of words. A run of a document and its first occurrence, which is
that of the window, are one class; runs of a class that overlap in a document are one, and a
class whose first occurrence lies within a copy of another class is a part of that.

A class counts as repeated if it occurs in at least two documents, told apart by id and
text. Its first occurrence, by document id and place, stays; the others are removals.

Defined results
    null, empty or short texts: no paragraph, no window, so no row
    repetitions inside one document only: no row
    repeated rows, equal in id and text: one document
    very long texts: whole; no rows: no rows; other columns: not read
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlens.session import cut_lineage
from eventlens.llm import byte_words
from eventlens.llm.common import table, whole
from eventlens.llm.near_dups import BLANKS, BROADCAST_ROWS, SIGNED, SIMILARITY, classes_of, fingerprint, sign
from eventlens.llm.pieces import AT_A_TIME
from eventlens.llm.shingles import SHINGLE, mix, runs_of, split_words

WINDOW = 32
#: Of so many consecutive windows one is taken: equal runs of WINDOW + EVERY - 1 words share one.
EVERY = 20
ROWS, BANDS = 3, 8
#: Lines that a worker signs at a time: their arrays stay in the processor's cache.
LINES_AT_A_TIME = 1024
#: Window keys, a number each, that may be broadcast (32 MB of keys); more are joined by shuffle.
BROADCAST_KEYS = 4_000_000
#: Odd multiplier of the rolling hash, and its inverse modulo 2 ** 64.
TURN = np.uint64(0x9E3779B97F4A7C15)
BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


#: Blanks between words, as everywhere in this subpackage; for lines, their ends are breaks.
_CLASSES = BLANKS
_LINES = byte_words.classes(gaps=" \t\x0b\x0c\r", breaks="\n")
_STOP, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".!?")] = True
_CLOSE[list(b"\"')]")] = True


def least_of(keys: np.ndarray, owner: np.ndarray, every: int) -> np.ndarray:
    """Places of the least of every ``every`` consecutive keys of an owner, or of all its keys
    if it has fewer. Of equal keys the last is taken, and stays while it is in reach.

    A key is taken if it is the greatest of the minima of the runs that hold it. Owners are
    set apart by ``every`` - 1 empty slots, so that no run goes over an owner's end."""
    n = len(keys)
    if not n:
        return np.zeros(0, np.int64)
    heads = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1))
    counts = np.diff(heads, append=n)
    slot = np.arange(n) + np.repeat(np.arange(len(counts)) * (every - 1), counts)
    low = np.full(int(slot[-1]) + every, np.iinfo(np.uint64).max, np.uint64)
    low[slot] = keys
    runs = slot[np.arange(n) <= np.repeat(np.maximum(heads, heads + counts - every), counts)]
    high = np.zeros(len(low), np.uint64)
    width = 1
    while width < every:
        step = min(width, every - width)
        low[:-step] = np.minimum(low[:-step], low[step:])
        width += step
    high[runs] = low[runs]
    width = 1
    while width < every:
        step = min(width, every - width)
        high[step:] = np.maximum(high[step:], high[:-step])
        width += step
    taken = np.flatnonzero(keys == high[slot])
    a, b = taken[:-1], taken[1:]
    tied = np.unique(owner[a[(owner[a] == owner[b]) & (keys[a] == keys[b]) & (b - a < every)]])
    if not len(tied):
        return taken
    at = np.flatnonzero(np.isin(owner, tied))
    return np.sort(np.concatenate((taken[~np.isin(owner[taken], tied)], at[last_of_least(keys[at], owner[at], every)])))


def last_of_least(keys: np.ndarray, owner: np.ndarray, every: int) -> np.ndarray:
    """As :func:`least_of`, for owners whose runs have equal least keys."""
    n = len(keys)
    ends = np.searchsorted(owner, owner, "right")
    first, last = np.arange(n), np.arange(n)     # of the least keys of the next ``width``
    width = 1
    while width < every:
        step = min(width, every - width)
        at = np.flatnonzero(np.arange(n) + step < ends)
        a, b = first[at], first[at + step]
        c, d = last[at], last[at + step]
        first[at] = np.where(keys[b] < keys[a], b, a)
        last[at] = np.where(keys[d] <= keys[c], d, c)
        width += step
    starts = np.searchsorted(owner, owner)
    full = np.arange(n) <= np.maximum(starts, ends - every)
    for i in np.flatnonzero(full & (first != last)).tolist():
        if i > starts[i] and last[i - 1] >= i and keys[last[i - 1]] == keys[last[i]]:
            last[i] = last[i - 1]
    return np.unique(last[full])


def ends_sentence(found: byte_words.Words) -> np.ndarray:
    """Whether a word ends with one of .!? and perhaps closing quotes and brackets."""
    at = found.end - 1
    if _CLOSE[found.data[at]].any():
        n = int(found.end[-1])
        at = np.maximum.accumulate(np.where(_CLOSE[found.data[:n]], -1, np.arange(n)))[at]
    return (at >= found.start) & _STOP[found.data[at]]


def windows_of(texts: pa.Array, size: int, every: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, place, hash) of the windows of ``size`` words that begin with a sentence, and of
    the least of every ``every`` consecutive ones."""
    found = byte_words.Words(texts, _CLASSES, lower=False)
    owner, n = found.owner, len(found)
    if n < size:
        return owner[:0], owner[:0], np.zeros(0, np.uint64)
    word = found.hashes()[0]
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, TURN))))
    backs = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, BACK))))
    sums = np.concatenate(([np.uint64(0)], np.cumsum(word * powers[:-1])))
    begins = np.ones(n, bool)
    begins[1:] = ends_sentence(found)[:-1] | (owner[1:] != owner[:-1])
    inside = np.flatnonzero(owner[:n - size + 1] == owner[size - 1:])
    keys = mix((sums[inside + size] - sums[inside]) * backs[inside])
    taken = begins[inside]
    if every:
        taken[least_of(keys, owner[inside], every)] = True
    at = inside[taken]
    return owner[at], at - np.searchsorted(owner, owner[at]), keys[taken]


def windows(size: int, every: int) -> Callable:
    """For mapInArrow: (id, hash, text) to (key, id, hash, place)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_words.parts(batches):
            owner, place, key = windows_of(part.column("text"), size, every)
            own = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), part.column("id").take(own), part.column("hash").take(own),
                 pa.array(place, pa.int64())], ["key", "id", "hash", "place"])
    return run


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Written, and marked for broadcast if it has at most so many rows."""
    df = cut_lineage(df)
    return F.broadcast(df) if df.count() <= rows else df


def lines_of(texts: pa.Array, least: int) -> tuple[byte_words.Words, np.ndarray, dict[str, np.ndarray]]:
    """The words of the texts, the number of the line that each is in, -1 for lines of fewer
    than ``least`` words, and by number the lines' owner, place, n_words and md5."""
    found = byte_words.Words(texts, _LINES, lower=False)
    heads = np.flatnonzero(found.begins)
    n = np.diff(heads, append=len(found))
    long = n >= least
    line = np.repeat(np.where(long, np.cumsum(long) - 1, -1), n)
    heads, n = heads[long], n[long]
    owner, cuts = found.owner[heads], found.offsets
    ends = np.flatnonzero(found.data[:cuts[-1]] == 10)
    after = np.searchsorted(ends, found.start[heads])     # the line's own end, or that of a later text's
    start = np.maximum(cuts[owner], np.append(-1, ends)[after] + 1)
    end = np.minimum(cuts[owner + 1], np.append(ends, cuts[-1])[after])
    raw = found.data.tobytes()
    fp = [hashlib.md5(raw[i:j]).hexdigest() for i, j in zip(start.tolist(), end.tolist())]
    return found, line, {"owner": owner, "place": after - np.searchsorted(ends, cuts[owner]), "n_words": n, "fp": fp}


def line_rows(least: int) -> Callable:
    """For mapInArrow: (id, hash, text) to (fp, id, hash, place, n_words) of the lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_words.parts(batches):
            _, _, lines = lines_of(part.column("text"), least)
            own = pa.array(lines["owner"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines["fp"], pa.string()), part.column("id").take(own), part.column("hash").take(own),
                 pa.array(lines["place"], pa.int64()), pa.array(lines["n_words"], pa.int64())],
                ["fp", "id", "hash", "place", "n_words"])
    return run


def signing_lines(least: int, size: int, rows: int, n_bands: int) -> Callable:
    """For mapInArrow: (text) to (fp, n_shingles, bands) of the lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_words.parts(batches):
            found, line, lines = lines_of(part.column("text"), least)
            word, fp = found.digests()[line >= 0], pa.array(lines["fp"], pa.string())
            line = line[line >= 0]
            for first in range(0, len(fp), LINES_AT_A_TIME):
                some = fp.slice(first, LINES_AT_A_TIME)
                i, j = np.searchsorted(line, (first, first + len(some)))
                yield sign(some, *runs_of(line[i:j] - first, word[i:j], len(some), size), rows, n_bands)
    return run


def repeated_paragraphs(docs: DataFrame, least: int | None, size: int, similarity: float, rows: int, n_bands: int) -> DataFrame:
    """(doc, place, n_words, class_id, first_doc, first_place) for (doc, text)."""
    least = max(size, least or 0)
    signed = docs.select("text").mapInArrow(signing_lines(least, size, rows, n_bands), SIGNED)
    every = docs.select(F.explode(F.split("text", "\n")).alias("text"))
    found = classes_of(signed, every.select(fingerprint("text").alias("fp"), "text"), size, similarity)
    units = docs.select("doc.id", F.col("doc.text").alias("hash"), "text").mapInArrow(
        line_rows(least), "fp string, id long, hash long, place long, n_words long")
    units = cut_lineage(units.select("fp", F.struct("id", F.col("hash").alias("text")).alias("doc"), "place", "n_words"))    # read twice
    by_text = units.select("fp", F.xxhash64("doc").alias("own")).groupBy("fp").agg(F.min("own").alias("lo"), F.max("own").alias("hi"))
    known = cut_lineage(by_text.join(found.select("fp", "component"), "fp"))
    again = known.groupBy("component").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("component")
    again = small(known.select("fp", "component").join(small(again), "component"))
    again = cut_lineage(units.join(again, "fp").select("doc", "place", "n_words", "component"))
    first = small(again.groupBy("component").agg(F.min(F.struct("doc", "place")).alias("first")))
    return again.join(first, "component").select("doc", "place", "n_words", F.concat(F.lit("p"), "component").alias("class_id"),
                                                 F.col("first.doc").alias("first_doc"), F.col("first.place").alias("first_place"))


def run(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal elements that ``a`` and ``b`` begin with."""
    n, at, width = min(len(a), len(b)), 0, 64
    while at < n:
        other = np.flatnonzero(a[at:min(at + width, n)] != b[at:min(at + width, n)])
        if len(other):
            return at + int(other[0])
        at, width = at + width, 2 * width
    return n


def equal_spans(a: np.ndarray, b: np.ndarray, anchors: list[tuple[int, int]], window: int) -> list[tuple[int, int, int]]:
    """(start in a, end in a, start in b) of the maximal equal runs of words around windows
    that begin at ``anchors``, pairs of places in ``a`` and in ``b``."""
    found, ends = [], {}
    for x, y in sorted(anchors):
        if x + window <= ends.get(x - y, 0):
            continue
        after = run(a[x:], b[y:])
        if after < window:      # equal hashes of different windows
            continue
        before = run(a[:x][::-1], b[:y][::-1])
        ends[x - y] = x + after
        found.append((x - before, x + after, y - before))
    return found


def along(a: np.ndarray, b: np.ndarray, shift: int, lo: int, hi: int, window: int) -> list[tuple[int, int]]:
    """The first anchors of the equal runs of ``window`` words or more that meet the places
    ``lo`` to ``hi`` of ``a`` and those ``shift`` before in ``b``."""
    equal = np.zeros(hi + window - lo + 2, np.int8)
    equal[1:-1] = a[lo:hi + window] == b[lo - shift:hi + window - shift]
    turns = np.diff(equal)
    begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    return [(lo + x, lo + x - shift) for x in begin[end - begin >= window].tolist()]


def extending(window: int) -> Callable:
    """For mapInArrow: (doc, first_doc, own, shifts, text, first_text) to (doc, first_doc,
    spans), the equal ones of the pair. In one document the window that is the first stays, also
    where spans overlap with themselves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, AT_A_TIME):
                part = batch.slice(start, AT_A_TIME)
                both = pa.concat_arrays([part.column("text"), part.column("first_text")]).dictionary_encode()
                owner, word, _ = split_words(both.dictionary)
                cuts = np.searchsorted(owner, np.arange(len(both.dictionary) + 1))
                texts = [word[i:j] for i, j in zip(cuts[:-1], cuts[1:])]
                code, rows = np.asarray(both.indices), []
                for i, (own, shifts) in enumerate(zip(part.column("own").to_pylist(), part.column("shifts").to_pylist())):
                    a, b = texts[code[i]], texts[code[part.num_rows + i]]
                    anchors = [x for s in shifts for x in along(a, b, s["shift"], s["lo"], s["hi"], window)]
                    for begin, end, first in equal_spans(a, b, anchors, window):
                        kept = max(0, first + window - begin) if own else 0
                        if begin + kept < end:
                            rows.append((i, begin + kept, end, first + kept))
                own, begin, end, first = (np.array(c, np.int64) for c in (zip(*rows) if rows else [[]] * 4))
                at, cuts = np.unique(own, return_index=True)
                spans = pa.StructArray.from_arrays([pa.array(c) for c in (begin, end, first)], ["start", "end", "first_start"])
                lists = pa.ListArray.from_arrays(pa.array(np.append(cuts, len(own)), pa.int32()), spans)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc").take(pa.array(at)), part.column("first_doc").take(pa.array(at)), lists],
                    ["doc", "first_doc", "spans"])
    return run


def joined_spans(spans: DataFrame, *by: str) -> DataFrame:
    """``by``, start, end, whole: the spans of a group, one for each start, and the start of the
    run of overlapping spans that each is a part of. Spans of one start are one before the
    shuffle, so a group has no more rows than its document has words."""
    one = spans.groupBy(*by, "start").agg(F.max("end").alias("end"))
    order = Window.partitionBy(*by).orderBy("start")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reached.isNull() | (F.col("start") >= reached), F.col("start"))
    return one.withColumn("begins", begins).select(*by, "start", "end", F.last("begins", True).over(
        order.rowsBetween(Window.unboundedPreceding, 0)).alias("whole"))


def repeated_windows(docs: DataFrame, window: int, every: int) -> DataFrame:
    """The same for passages, with start and end.

    Windows are made and written once. The keys that two documents have come from a hash
    aggregate; only their windows go on, as the least and greatest place of each document, first
    document and shift between the places, so a long copy is one row. Each pair of a document
    and the first one meets with both texts once.
    """
    made = cut_lineage(docs.select("doc.id", F.col("doc.text").alias("hash"), "text").mapInArrow(
        windows(window, every), "key long, id long, hash long, place long"))
    own = F.xxhash64("id", "hash")
    again = small(made.groupBy("key").agg(F.min(own).alias("lo"), F.max(own).alias("hi")).where("lo <> hi").select("key"),
                  BROADCAST_KEYS)
    found = cut_lineage(made.join(again, "key").select(
        "key", F.struct("id", F.col("hash").alias("text")).alias("doc"), "place"))
    first = small(found.groupBy("key").agg(F.min(F.struct("doc", "place")).alias("first")))
    shifts = found.join(first, "key").select("doc", "place", F.col("first.doc").alias("first_doc"),
                                             (F.col("place") - F.col("first.place")).alias("shift")
                                             ).where("doc <> first_doc OR shift <> 0")
    shifts = shifts.groupBy("doc", "first_doc", "shift").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
    pairs = cut_lineage(shifts.groupBy("doc", "first_doc").agg(F.collect_list(F.struct("shift", "lo", "hi")).alias("shifts")))
    needed = small(pairs.select("doc").union(pairs.select("first_doc")).distinct())
    texts = cut_lineage(docs.join(needed, "doc", "left_semi").dropDuplicates(["doc"]))
    full = (pairs.join(texts.select(F.col("doc").alias("first_doc"), F.col("text").alias("first_text")), "first_doc")
            .join(texts, "doc").select("doc", "first_doc", F.expr("doc = first_doc").alias("own"), "shifts", "text", "first_text"))
    document = "struct<id:bigint,text:bigint>"
    spans = cut_lineage(full.mapInArrow(
        extending(window), f"doc {document}, first_doc {document}, "
                           "spans array<struct<start: bigint, end: bigint, first_start: bigint>>"))

    ends = F.col("first_start") + F.col("end") - F.col("start")
    each = spans.select("first_doc", F.inline("spans"))
    parts = cut_lineage(joined_spans(each.select("first_doc", F.col("first_start").alias("start"), ends.alias("end")), "first_doc")
                        .select("first_doc", "start", "end", _class("first_doc", "whole").alias("class")))
    # a document's classes are set apart: a span is of the last one that begins at its first start or before
    of = small(parts.groupBy("first_doc").agg(F.collect_set("class.place").alias("places")))
    classed = spans.join(of, "first_doc").select("doc", "first_doc", F.inline(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.array_max(F.filter("places", lambda p: p <= s["first_start"])).alias("place")))))
    copies = cut_lineage(joined_spans(classed.withColumn("class", _class("first_doc", "place")), "doc", "class")
                         .groupBy("doc", "class", "whole").agg(F.max("end").alias("end"))
                         .select("doc", "class", F.col("whole").alias("start"), "end"))
    kept = cut_lineage(parts.groupBy("class").agg(F.max("end").alias("end")))
    earlier = small(earlier_classes(kept, copies))
    kept = kept.join(earlier, "class", "left_anti").select(
        F.col("class.doc").alias("doc"), "class", F.col("class.place").alias("start"), "end", F.lit(False).alias("removed"))
    copies = joined_spans(copies.join(earlier, "class", "left").withColumn("class", F.coalesce("earlier", "class")), "doc", "class")
    copies = copies.groupBy("doc", "class", "whole").agg(F.max("end").alias("end")).select(
        "doc", "class", F.col("whole").alias("start"), "end", F.lit(True).alias("removed"))
    name = F.concat(F.lit("w"), F.xxhash64("class.doc.id", "class.doc.text"), F.lit(":"), F.col("class.place"))
    return kept.unionByName(copies).select(
        "doc", F.col("start").alias("place"), F.expr("end - start").alias("n_words"), name.alias("class_id"),
        F.col("class.doc").alias("first_doc"), F.col("class.place").alias("first_place"), "start", "end", "removed")


def _class(doc: str, place: str) -> Column:
    """A class is named by the document and place of its first occurrence."""
    return F.struct(F.col(doc).alias("doc"), F.col(place).alias("place"))


def earlier_classes(kept: DataFrame, copies: DataFrame) -> DataFrame:
    """(class, earlier) of the classes whose first occurrence is within a copy of another class.

    Which windows are taken near the ends of a passage depends on the words around it, so a
    window may be missing in the passage's first document and have another first one. The
    copies go over to the class whose copy holds that one; its document is an earlier one, so
    there are no circles, and doubling the steps follows chains.
    """
    both = copies.where("doc <> class.doc").select("doc", "start", "end", "class", F.lit(False).alias("own")).unionByName(
        kept.select("class.doc", F.col("class.place").alias("start"), "end", "class", F.lit(True).alias("own")))
    before = Window.partitionBy("doc").orderBy("start", "own").rowsBetween(Window.unboundedPreceding, 0)
    longest = F.max(F.when(~F.col("own"), F.struct("end", F.col("class").alias("of")))).over(before)
    up = cut_lineage(both.withColumn("longest", longest).where("own AND longest.end >= end")
                     .select("class", F.col("longest.of").alias("earlier")))
    while True:
        far = up.join(up.select(F.col("class").alias("earlier"), F.col("earlier").alias("next")), "earlier", "left")
        up = cut_lineage(far.select("class", F.coalesce("next", "earlier").alias("earlier"), F.col("next").isNotNull().alias("moved")))
        if up.where("moved").isEmpty():
            return up.select("class", "earlier")
        up = up.select("class", "earlier")


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int | None = None, window: int = WINDOW,
            size: int = SHINGLE, similarity: float = SIMILARITY, rows: int = ROWS, n_bands: int = BANDS,
            every: int = EVERY) -> DataFrame:
    """(doc_id, kind, place, n_words, class_id, first_doc_id, removed, start, end): a row for each
    repeated paragraph (place: its line) and passage (place: its first word), the first ones
    included. A passage is the words from start up to end; a paragraph, a whole line, has none."""
    source = docs.select(F.struct(F.col(doc_id).cast("long").alias("id"), F.xxhash64(whole(text)).alias("text")).alias("doc"),
                         whole(text).alias("text"))
    lines = repeated_paragraphs(source, least, size, similarity, rows, n_bands)
    first = F.col("doc").eqNullSafe(F.col("first_doc")) & (F.col("place") == F.col("first_place"))
    lines = lines.withColumns({"removed": ~first, "start": F.lit(None).cast("long"), "end": F.lit(None).cast("long"),
                               "kind": F.lit("paragraph")})
    passages = repeated_windows(source, window, every).withColumn("kind", F.lit("passage"))
    return lines.unionByName(passages).select(
        F.col("doc.id").alias("doc_id"), "kind", "place", "n_words", "class_id", F.col("first_doc.id").alias("first_doc_id"),
        "removed", "start", "end")


def op8_passages(spark, sf_dir):
    return repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
