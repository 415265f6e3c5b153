"""Near-duplicate documents by BagMinHash: band, verify multiset overlap, join to classes.

Two texts are alike if the weighted Jaccard similarity of their multisets of word shingles
(five words, or all the words of a shorter text) is at least 0.8; a class is what such links
connect. Texts that are equal are one node. A signature of 336 places falls into 48 bands of
7; a pair at 0.8 shares no band with a probability of 1.3e-5, a pair at 0.85 with 1e-8.

Texts in one bucket of a band are not paired with each other. First each is compared with
one of them, the bucket's smallest, and what is alike is joined. Only buckets that still
hold more than one component are then looked into as a whole: their texts are brought
together, in blocks where there are many, and a matrix product gives all overlaps in a
block; a task puts out joined components, never pairs. So every pair that shares a bucket
is compared unless it is already connected, and no links are lost to caps.

Defined results
    null, empty or wordless texts: alike to nothing, each its own class
    texts of one to four words: one shingle, so alike only if the words are the same
    equal texts, and texts that differ in blanks only: always one class
    repeated rows, equal ids: rows are told apart by their text; the class id is the least id
    very long texts: whole; no rows: no rows; other columns: ignored or kept as they are
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventlens.session import cut_lineage
from eventlens.llm import byte_words
from eventlens.llm.bag_minhash import bands, signatures
from eventlens.llm.common import components, table, whole
from eventlens.llm.pieces import AT_A_TIME
from eventlens.llm.shingles import LENGTH, SHINGLE, bags, mix, overlap, runs_of, shingles

SIMILARITY = 0.8
ROWS, BANDS = 7, 48
#: Fingerprints (32 characters) that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Texts of a bucket that are compared in one block, and rows that a task gets at a time.
BLOCK, TOGETHER = 1024, 1024
#: Columns of the matrices whose product gives the overlaps.
WIDTH = 8192
#: Blanks between words.
BLANKS = byte_words.classes(gaps=" \t\n\x0b\x0c\r")


SIGNED = "fp string, n_shingles long, bands array<long>"


def sign(fp: pa.Array, owner: np.ndarray, value: np.ndarray, rows: int, n_bands: int) -> pa.RecordBatch:
    """(fp, n_shingles, bands) by the owner and hash of every shingle; texts without any are left out."""
    n = np.bincount(owner, minlength=len(fp))
    keys = bands(signatures(len(fp), *bags(owner, value), rows * n_bands), rows)
    has = n > 0
    flat = pa.array(np.ascontiguousarray(keys[has]).ravel(), pa.int64())
    lists = pa.ListArray.from_arrays(pa.array(np.arange(has.sum() + 1, dtype=np.int32) * n_bands), flat)
    return pa.RecordBatch.from_arrays([fp.filter(pa.array(has)), pa.array(n[has], pa.int64()), lists],
                                      ["fp", "n_shingles", "bands"])


def signing(size: int, rows: int, n_bands: int) -> Callable:
    """For mapInArrow: (fp, text) to (fp, n_shingles, bands); texts without words are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, AT_A_TIME):
                part = batch.slice(start, AT_A_TIME)
                yield sign(part.column("fp"), *shingles(part.column("text"), size), rows, n_bands)
    return run


def byte_shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``shingles``, by other hashes, which are made faster: enough where only equality counts."""
    found = byte_words.Words(texts, BLANKS, lower=False)
    return runs_of(found.owner, found.hashes()[0], len(texts), size)


def verifying(size: int, least: float) -> Callable:
    """For mapInArrow: (a, b, text_a, text_b) to the pairs (a, b) alike enough. Texts that come
    again, as that of a hub does, are split once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, AT_A_TIME):
                part = batch.slice(start, AT_A_TIME)
                both = pa.concat_arrays([part.column("text_a"), part.column("text_b")]).dictionary_encode()
                owner, value, count = bags(*byte_shingles(both.dictionary, size))
                at = np.searchsorted(owner, np.arange(len(both.dictionary) + 1))
                bag = [(value[i:j], count[i:j]) for i, j in zip(at[:-1], at[1:])]
                code = np.asarray(both.indices)
                near = [overlap(bag[x], bag[y]) >= least for x, y in zip(code[:part.num_rows], code[part.num_rows:])]
                kept = pa.array(near, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("a").filter(kept), part.column("b").filter(kept)], ["a", "b"])
    return run


def verify(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts' multisets of shingles overlap enough; written."""
    pairs = cut_lineage(pairs.select("a", "b"))
    one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return cut_lineage(two.select("a", "b", "text_a", "text_b").mapInArrow(verifying(size, least), "a long, b long"))


def overlaps(bag: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of (values, counts). The k-th occurrence of a
    shingle is a thing of its own, so common things are the product of 0/1 matrices; those
    that only one text has are left out."""
    n = np.array([c.sum() for _, c in bag], np.int64)
    value = np.concatenate([np.repeat(v, c) for v, c in bag])
    count = np.concatenate([c for _, c in bag])
    nth = np.arange(len(value)) - np.repeat(np.cumsum(count) - count, count)
    row = np.repeat(np.arange(len(bag)), n)
    _, code, df = np.unique(mix(value + nth.astype(np.uint64) * LENGTH), return_inverse=True, return_counts=True)
    number = np.cumsum(df > 1) - 1
    shared = df[code] > 1
    row, column = row[shared], number[code[shared]]
    common = np.zeros((len(bag), len(bag)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, WIDTH):
        i, j = np.searchsorted(column, (start, start + WIDTH))
        part = np.zeros((len(bag), WIDTH), np.float32)
        part[row[i:j], column[i:j] - start] = 1
        common += part @ part.T
    common = common.astype(np.int64)
    return common / np.maximum(n[:, None] + n[None, :] - common, 1)


def joined(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Those of ``pairs`` that connect what earlier ones have not."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x
    kept = []
    for a, b in pairs.tolist():
        x, y = top(a), top(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def comparing(size: int, least: float) -> Callable:
    """For applyInArrow: rows (key, node, component, text) of some buckets, or of a block of
    one, to the pairs (a, b) of components that belong together."""
    def run(rows: pa.Table) -> pa.Table:
        key, node = np.asarray(rows.column("key")), np.asarray(rows.column("node"))
        component = np.asarray(rows.column("component"))
        _, at, code = np.unique(node, return_index=True, return_inverse=True)
        owner, value, count = bags(*byte_shingles(rows.column("text").combine_chunks().take(pa.array(at)), size))
        cuts = np.searchsorted(owner, np.arange(len(at) + 1))
        bag = [(value[i:j], count[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
        found = []
        order = np.argsort(key, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
            own = component[group]
            if len(group) > 1 and (own != own[0]).any():
                a, b = np.nonzero(np.triu(overlaps([bag[c] for c in code[group]]) >= least, 1))
                links = np.stack([np.minimum(own[a], own[b]), np.maximum(own[a], own[b])], axis=1)
                found.append(links[links[:, 0] != links[:, 1]])
        links = joined(np.unique(np.concatenate(found), axis=0)) if found else []
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return run


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with their ``component``; a node without links is its own."""
    return members.join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))


def unresolved_links(members: DataFrame, labels: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Pairs (a, b) of components that have alike texts in a bucket; written.

    Buckets of more than BLOCK texts are dealt to blocks by a hash of the node, and each pair
    of blocks is a group; smaller buckets share groups of about TOGETHER rows.
    """
    rows = cut_lineage(labelled(members.select("key", "node"), labels))
    open_ = cut_lineage(rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                                F.count(F.lit(1)).alias("n")).where("lo < hi").select("key", "n"))
    total = open_.agg(F.sum("n")).first()[0] or 0
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (rows.join(open_, "key").withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "node", "component",
                     F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("key"), F.lit(total // TOGETHER + 1)))
                      .otherwise(F.col("key")).alias("g"),
                     F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    full = cut_lineage(dealt).join(texts, "node")
    return cut_lineage(full.select("g", "i", "j", "key", "node", "component", "text").groupBy("g", "i", "j")
                       .applyInArrow(comparing(size, least), "a long, b long"))


def fingerprint(text: str):
    return F.md5(F.encode(whole(text), "utf-8"))


def classes(docs: DataFrame, text: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY,
            rows: int = ROWS, n_bands: int = BANDS) -> DataFrame:
    """(fp, n_shingles, component) for each distinct text with words; written."""
    source = docs.select(fingerprint(text).alias("fp"), whole(text).alias("text"))
    return classes_of(source.mapInArrow(signing(size, rows, n_bands), SIGNED), source, size, similarity)


def classes_of(signed: DataFrame, source: DataFrame, size: int, similarity: float) -> DataFrame:
    """The same for rows (fp, n_shingles, bands) and the (fp, text) of at least these rows.

    Signatures are made in one pass and one row per distinct text is shuffled; after that
    only band keys move, and the texts of nodes that share a bucket with others.
    """
    nodes = cut_lineage(signed.dropDuplicates(["fp"]).withColumn("node", F.monotonically_increasing_id()))
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = cut_lineage(keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n"))
                         .where("n > 1").select("key", "pivot"))
    members = cut_lineage(keys.join(shared, "key"))

    needed = cut_lineage(members.select("node").distinct().join(nodes.select("node", "fp"), "node"))
    if needed.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    texts = cut_lineage(source.join(needed, "fp").select("node", "text").dropDuplicates(["node"]))

    stars = members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    edges = verify(stars, texts, size, similarity)
    more = unresolved_links(members, components(edges), texts, size, similarity)
    # links between components hold for the nodes they are named after
    labels = components(edges.unionByName(more))
    return cut_lineage(labelled(nodes.select("fp", "n_shingles", "node"), labels).select("fp", "n_shingles", "component"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    similarity: float = SIMILARITY, rows: int = ROWS, n_bands: int = BANDS) -> DataFrame:
    """(doc_id, class_id, class_size, n_shingles), one row per row of ``docs``."""
    found = classes(docs, text, size, similarity, rows, n_bands)
    own = docs.select(F.col(doc_id).alias("doc_id"), fingerprint(text).alias("fp"))
    placed = cut_lineage(own.join(found, "fp", "left").select("doc_id", "n_shingles", "component"))
    sizes = placed.where("component IS NOT NULL").groupBy("component").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return placed.join(cut_lineage(sizes), "component", "left").select(
        "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"), F.coalesce("n_shingles", F.lit(0)).alias("n_shingles"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE,
             similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` without all but one row of each class: the row with the least id (null last),
    of these the one with the least fingerprint. Wordless texts all stay.

    One small row per document is ranked; Spark cuts each class to one row in every task
    before the shuffle. Which rows go is then joined back by id and fingerprint.
    """
    found = classes(docs, text, size, similarity)
    own = docs.select(F.col(doc_id).alias("__id"), fingerprint(text).alias("fp"))
    placed = cut_lineage(own.join(found.select("fp", "component"), "fp"))
    first = placed.groupBy("component").agg(F.min(F.struct(
        F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("fp").alias("fp"))).alias("f"))
    stays = cut_lineage(first.select(F.col("f.id").alias("__first"), F.col("f.fp").alias("__fp")))
    gone = cut_lineage(placed.distinct().join(stays, placed["__id"].eqNullSafe(F.col("__first"))
                                              & (F.col("fp") == F.col("__fp")), "left_anti")
                       .select(F.col("__id").alias("__gone"), F.col("fp").alias("__fp")))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    rows = docs.select(*docs.columns, fingerprint(text).alias("__own"))
    left = rows.join(gone, (F.col("__own") == F.col("__fp")) & F.col(doc_id).eqNullSafe(F.col("__gone")), "left_anti")
    # rows alike in id and text: one of each
    again = cut_lineage(placed.groupBy("__id", "fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .select(F.col("__id").alias("__again"), F.col("fp").alias("__fp")))
    if again.isEmpty():
        return left.select(*docs.columns)
    same = (F.col("__own") == F.col("__fp")) & F.col(doc_id).eqNullSafe(F.col("__again"))
    single = left.join(again, same, "left_anti").select(*docs.columns)
    several = left.join(again, same, "left_semi").dropDuplicates([doc_id, "__own"]).select(*docs.columns)
    return single.unionByName(several)


def op4_near_dups(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
