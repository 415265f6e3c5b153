"""Benchmark passages in documents, by a prefix-filtered join on rare shingles.

Every item is taken in windows of ``window`` consecutive words; an item of fewer words, but
not none, is one window. A document word inside any occurrence of a window is hit.

A window is the set of its word shingles (``shingle`` words; all words of a shorter one).
Exact containment needs all of them, so the necessary prefix of a window in any global order
is one shingle. The order is rarity: how often each item shingle occurs in the documents,
then its hash. Windows with a shingle that no document holds are out at once. Documents are
joined on the prefix shingles; a hit must leave room for the whole window before and after
the shingle (position and length bounds), and then the words themselves are compared over
the stretch of the window's size.

Two passes read the texts, one to count, one to join. Both only let through shingles whose
bit is set in a map of MAP_BITS bits, made from the items' shingles; its size does not depend on
the benchmark, and a bit that is set by chance only costs a row that the join drops. Windows
are broadcast up to BROADCAST_BYTES, counted first, and joined by shuffle beyond.

Defined results
    null or empty text, texts without words: no words, no items, the digest of nothing
    items without words: never found; null item ids hit words but are not listed or counted
    equal items or windows, repeated rows of one item id: searched once, listed by id once
    repeated documents: each row has its own result; null document ids stay null
    very long texts: whole; no documents: no rows; no items: nothing is hit
    other columns: not read, whatever their names
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from eventlens.session import cut_lineage
from eventlens.llm.byte_words import Words, classes, parts
from eventlens.llm.common import table, whole
from eventlens.llm.shingles import LENGTH, PLACES, mix

WINDOW, SHINGLE = 10, 5
#: Bits of the map of item shingles: 2 MB, and at most as many rows to the driver as it has words.
MAP_BITS = 24
#: Largest table of windows that is broadcast.
BROADCAST_BYTES = 32 << 20
WORD = classes(words="0123456789abcdefghijklmnopqrstuvwxyz")


def runs(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, hash) of every ``size`` consecutive words of a text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(words.owner[:n] == words.owner[size - 1:])
    total = np.full(len(at), np.uint64(size) * LENGTH)
    for j in range(size):
        total += hashes[at + j] * PLACES[j]
    return at, mix(total)


def _item_windows(window: int, shingle: int) -> Callable:
    """For mapInArrow: (item_id, text) to (item_id, window, m, shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            words = Words(part.column("text"), WORD)
            hashes, _ = words.hashes()
            own = words.strings(np.arange(len(words))).to_pylist()
            by_size = {}
            for size in range(1, shingle + 1):
                at, value = runs(words, hashes, size)
                by_size[size] = dict(zip(at.tolist(), value.view(np.int64).tolist()))
            begin = np.searchsorted(words.owner, np.arange(part.num_rows + 1)).tolist()
            which, text, sizes, lists = [], [], [], []
            for i, (a, b) in enumerate(zip(begin, begin[1:])):
                m = min(window, b - a)
                size = min(shingle, m)
                for s in range(a, b - m + 1 if m else a):
                    which.append(i)
                    text.append(" ".join(own[s:s + m]))
                    sizes.append(m)
                    lists.append([by_size[size][k] for k in range(s, s + m - size + 1)])
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id").take(pa.array(which, pa.int64())), pa.array(text, pa.string()),
                 pa.array(sizes, pa.int32()), pa.array(lists, pa.list_(pa.int64()))],
                ["item_id", "window", "m", "shingles"])
    return run


def item_windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                 item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(wid, window, m, shingles) of the distinct windows, and (wid, item_id) of their items."""
    if not 1 <= shingle <= min(window, len(PLACES)):
        raise ValueError(f"shingles have 1 to {len(PLACES)} words, and no more than windows")
    rows = cut_lineage(items.select(F.col(item_id).cast("string").alias("item_id"), whole(text).alias("text"))
                       .mapInArrow(_item_windows(window, shingle),
                                   "item_id string, window string, m int, shingles array<long>"))
    # the number is written with its row, so it stays
    windows = cut_lineage(rows.groupBy("window").agg(F.first("m").alias("m"), F.first("shingles").alias("shingles"))
                          .withColumn("wid", F.monotonically_increasing_id()))
    members = cut_lineage(rows.select("window", "item_id").distinct().join(windows.select("window", "wid"), "window")
                          .select("wid", "item_id"))
    return windows, members


def bit_map(shingles: DataFrame) -> np.ndarray:
    """The map of a column of shingles; at most 2^(MAP_BITS-6) rows come to the driver."""
    h = F.col(shingles.columns[0])
    slot = F.shiftrightunsigned(h, 6).bitwiseAND(F.lit((1 << MAP_BITS - 6) - 1))
    bits = shingles.select(slot.alias("slot"), F.expr(f"shiftleft(1L, int(`{shingles.columns[0]}` & 63))").alias("bit"))
    found = bits.groupBy("slot").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << MAP_BITS - 6, np.uint64)
    out[np.asarray(found["slot"])] = np.asarray(found["bits"]).view(np.uint64)
    return out


def in_map(bits: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    slot = (shingles >> np.uint64(6)) & np.uint64(len(bits) - 1)
    return (bits[slot.astype(np.int64)] >> (shingles & np.uint64(63))) & np.uint64(1) != 0


def _count(shared, sizes: list[int]) -> Callable:
    """For mapInArrow: (text) to (shingle, n), summed over the rows taken at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            words = Words(part.column("text"), WORD)
            hashes, _ = words.hashes()
            found = [value[in_map(shared.value, value)] for _, value in (runs(words, hashes, s) for s in sizes)]
            value, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n, pa.int64())], ["shingle", "n"])
    return run


def _search(shared, sizes: list[int], window: int, shingle: int) -> Callable:
    """For mapInArrow: (doc_id, text) to (doc_id, n_words, hits).

    A hit is a place whose shingle is in the map, with the words around it that a window
    could take in: ``before`` words stand in front of the place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts(batches):
            words = Words(part.column("text"), WORD)
            hashes, _ = words.hashes()
            begin = np.searchsorted(words.owner, np.arange(part.num_rows + 1))
            at, value, reach = [], [], []
            for size in sizes:
                a, v = runs(words, hashes, size)
                keep = in_map(shared.value, v)
                at.append(a[keep]), value.append(v[keep])
                # shorter shingles are whole items, which take in nothing around them
                reach.append(np.full(int(keep.sum()), size if size < shingle else window))
            at, value, reach = map(np.concatenate, (at, value, reach))
            around = reach - np.where(reach == window, shingle, reach)
            order = np.argsort(at, kind="stable")
            at, value, reach, around = at[order], value[order], reach[order], around[order]
            owner = words.owner[at]
            low = np.maximum(at - around, begin[owner])
            high = np.minimum(at + reach, begin[owner + 1])
            width = np.cumsum(np.concatenate(([0], high - low)))
            inner = np.repeat(low - width[:-1], high - low) + np.arange(width[-1])
            context = pa.ListArray.from_arrays(pa.array(width, pa.int32()), words.strings(inner))
            hits = pa.StructArray.from_arrays(
                [pa.array(at - begin[owner], pa.int32()), pa.array(value.view(np.int64)),
                 pa.array(at - low, pa.int32()), context], ["place", "shingle", "before", "context"])
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(part.num_rows + 1)), pa.int32()), hits)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(begin), pa.int64()), lists], ["doc_id", "n_words", "hits"])
    return run


HITS = "doc_id long, n_words long, hits array<struct<place int, shingle long, before int, context array<string>>>"


def prefixes(texts: DataFrame, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(wid, window, m, shingle, offset): the rarest shingle of each window that may occur."""
    sc = texts.sparkSession.sparkContext
    placed = cut_lineage(windows.select("wid", F.posexplode("shingles").alias("offset", "shingle")))
    shared = sc.broadcast(bit_map(placed.select("shingle")))
    counted = (texts.select("text").mapInArrow(_count(shared, sizes), "shingle long, n long")
               .groupBy("shingle").agg(F.sum("n").alias("n")))
    counts = cut_lineage(placed.select("shingle").distinct().join(counted, "shingle"))
    rarest = (placed.join(counts, "shingle", "left").groupBy("wid")
              .agg(F.min(F.struct("n", "shingle", "offset")).alias("least"), F.count("n").alias("held"),
                   F.count(F.lit(1)).alias("all")).where("held = all"))
    return cut_lineage(rarest.join(windows, "wid").select("wid", "window", "m", "least.shingle", "least.offset"))


def search(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
           doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(row, doc_id, n_words) of every document, (row, start, m, wid) of every occurrence of a
    window, counted in words, and (wid, item_id). All three are written tables."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    windows, members = item_windows(items, window, shingle)
    sizes = sorted(min(shingle, r.m) for r in windows.select(F.least("m", F.lit(shingle)).alias("m")).distinct().collect())
    sizes = sorted({*sizes, shingle})
    first = prefixes(texts, windows, sizes)
    shared = docs.sparkSession.sparkContext.broadcast(bit_map(first.select("shingle")))
    found = cut_lineage(texts.mapInArrow(_search(shared, sizes, window, shingle), HITS)
                        .withColumn("row", F.monotonically_increasing_id()))
    hits = found.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    size = first.agg(F.coalesce(F.sum(F.octet_length("window") + 64), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        first = F.broadcast(first)
    stretch = F.array_join(F.expr("slice(context, before - offset + 1, m)"), " ")
    spans = (hits.join(first, "shingle")
             .where("before >= offset AND size(context) - before >= m - offset")
             .where(stretch == F.col("window"))
             .select("row", (F.col("place") - F.col("offset")).alias("start"), "m", "wid"))
    return found.select("row", "doc_id", "n_words"), cut_lineage(spans), members


def passages(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, start, end, item_id): where, in words, windows of which item occur; windows that
    touch or overlap are not joined."""
    found, spans, members = search(docs, items, **options)
    return (spans.join(found, "row").join(members, "wid")
            .select("doc_id", "start", (F.col("start") + F.col("m")).alias("end"), "item_id"))


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each document."""
    found, spans, members = search(docs, items, **options)
    # spans of one row only: no more than its words
    earlier = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    longest = spans.groupBy("row", "start").agg((F.col("start") + F.max("m")).alias("end"))
    fresh = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    hit = (longest.select("row", F.greatest(fresh, F.lit(0)).alias("fresh"))
           .groupBy("row").agg(F.sum("fresh").cast("long").alias("n_hit")))
    listed = (spans.select("row", "wid").distinct().join(members.where("item_id IS NOT NULL"), "wid")
              .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("ids")))
    listed = listed.select("row", F.size("ids").cast("long").alias("n_items"),
                           F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("sha"))
    both = hit.join(listed, "row", "left")
    return (found.join(both, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def op12_decontaminate(spark, sf_dir):
    return report(table(spark, sf_dir, "documents", "doc_id", "text"),
                  table(spark, sf_dir, "benchmark", "item_id", "text"))


_SPLIT = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""
ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, {_SPLIT} AS words FROM documents),
items AS (SELECT item_id::VARCHAR AS item_id, {_SPLIT} AS words FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, least(len(words), {WINDOW}) AS m, array_to_string(words[s:s + {WINDOW} - 1], ' ') AS w
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - {WINDOW} + 1, 1) + 1)) AS s
          FROM items WHERE len(words) > 0)),
doc_windows AS (
    SELECT row, s, m, array_to_string(words[s:s + m - 1], ' ') AS w
    FROM (SELECT row, words, m, unnest(range(1, len(words) - m + 2)) AS s
          FROM docs, (SELECT DISTINCT m FROM item_windows) WHERE len(words) >= m)),
found AS (SELECT d.row, d.s, d.m, i.item_id FROM doc_windows d JOIN item_windows i ON d.w = i.w AND d.m = i.m),
hit AS (SELECT row, count(DISTINCT place) AS n_hit
        FROM (SELECT row, unnest(range(s, s + m)) AS place FROM (SELECT DISTINCT row, s, m FROM found)) GROUP BY row),
listed AS (SELECT row, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
           FROM (SELECT DISTINCT row, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN listed USING (row)
"""
