"""Byte-level BPE encoding by overlapping chunks, and decoding.

Texts of more than ``chunk`` characters are cut into chunks that overlap. Each chunk is
split into pre-tokens by itself, wherever it begins. Two neighbours are stitched at the first
place in their overlap where both have a pre-token border: what follows a border depends on
the text after it alone, so from there on the right neighbour's borders are those of the
whole text. Each chunk then encodes its pre-tokens from its left to its right stitch, and
the ids of a text are put together in order. A border counts for the left neighbour only if
the splitting did not reach the end of its window. Where an overlap has no common border (a
word longer than the overlap) the whole text is encoded in one piece.

Decoding puts the bytes of the ids together.

Defined results
    null or empty text: no ids, no bytes
    repeated rows: each has its own row; a long text that many rows hold is encoded once
    very long texts: whole; no rows: no rows; other columns: not read
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from eventlens.session import cut_lineage
from eventlens.llm.common import table, whole
from eventlens.llm.pieces import AT_A_TIME, PATTERN, cut

CHUNK = 65_536
OVERLAP = 1024
#: Pieces and pre-tokens that a worker remembers.
PIECES, WORDS = 250_000, 100_000
#: Stitches and broken texts that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


class Codec:
    """Ids of pre-tokens by a ranks file (base64 bytes and rank in each line), remembered."""

    def __init__(self, path: str):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for data, i in ranks.items():
            self.bytes[i] = data
        self.memory: dict[str, bytes] = {}      # by pre-token
        self.pieces: dict[str, bytes] = {}      # by piece, with the space before it

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def _learn(self, memory: dict[str, bytes], words: list[list[str]], ids: Callable) -> dict[str, bytes]:
        new = set().union(*words).difference(memory)
        if len(memory) + len(new) > WORDS:
            memory.clear()
            new = set().union(*words)
        memory.update((w, ids(w)) for w in new)
        return memory

    def encode(self, words: list[list[str]]) -> list[bytes]:
        """Ids of each list of pre-tokens, as little-endian 32-bit integers."""
        memory = self._learn(self.memory, words, lambda w: np.asarray(
            self.encoding._encode_single_piece(w), "<u4").tobytes())
        return [b"".join(map(memory.__getitem__, w)) for w in words]

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; pieces between sure borders are split into pre-tokens once."""
        cuts = [cut(t) for t in texts]
        first = self.encode([self.split(c[0]) for c in cuts])
        rest = [c[1:] for c in cuts]
        new = list(set().union(*rest).difference(self.pieces))
        ids = dict(zip(new, self.encode([self.split(f" {p}") for p in new])))
        if len(self.pieces) + len(new) > PIECES:
            known = {p: self.pieces[p] for p in set().union(*rest).difference(new)}
            self.pieces.clear()
            self.pieces.update(known)
        self.pieces.update(ids)
        return [f + b"".join(map(self.pieces.__getitem__, r)) for f, r in zip(first, rest)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    return _codecs.get(path) or _codecs.setdefault(path, Codec(path))


def id_lists(rows: list[bytes]) -> pa.ListArray:
    offsets = np.cumsum([0, *(len(r) // 4 for r in rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), "<i4"), pa.int32()))


def whole_texts(path: str) -> Callable:
    """For mapInArrow: (key..., text) to (key..., ids), each text in one piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, AT_A_TIME):
                part = batch.slice(start, AT_A_TIME)
                rows = coder.encode_texts(part.column("text").to_pylist())
                keys = [n for n in part.schema.names if n != "text"]
                yield pa.RecordBatch.from_arrays([*map(part.column, keys), id_lists(rows)], [*keys, "ids"])
    return run


def borders(words: list[str]) -> np.ndarray:
    """Places between pre-tokens, the start and the end included."""
    return np.cumsum([0, *map(len, words)])


def marks(path: str, overlap: int) -> Callable:
    """For mapInArrow: chunks to their borders near both ends, counted from the places where
    their cores begin and end; only those that the window's end had no part in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            left, right = [], []
            for row in batch.select(["text", "before", "core", "after"]).to_pylist():
                at = borders(coder.split(row["text"]))
                begin, end = row["before"], row["before"] + row["core"]
                left.append((at[at <= begin + overlap] - begin).tolist() if begin else None)
                sure = at[(at >= end - overlap) & (at <= end + row["after"] - 2)]
                right.append((sure - end).tolist() if row["after"] else None)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("k"), pa.array(left, kind), pa.array(right, kind)],
                ["key", "k", "left_marks", "right_marks"])
    return run


def between(path: str) -> Callable:
    """For mapInArrow: chunks with their stitches to the ids of what lies between these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                part = batch.slice(start, 16)
                lists = []
                for row in part.select(["text", "before", "core", "left", "right"]).to_pylist():
                    words = coder.split(row["text"])
                    at = borders(words)
                    begin = 0 if row["left"] is None else row["before"] + row["left"]
                    end = at[-1] if row["right"] is None else row["before"] + row["core"] + row["right"]
                    lists.append(words[int(np.searchsorted(at, begin)):int(np.searchsorted(at, end))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("k"), id_lists(coder.encode(lists))], ["key", "k", "ids"])
    return run


def chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, k, text, before, core, after) for (key, text): the window of chunk ``k`` and the
    lengths of its left overlap, core and right overlap. One pass over each text."""
    cores = texts.select("key", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0)).alias("cores"))
    empty = F.array(F.lit(""))
    n = F.size("cores")
    earlier = F.concat(empty, F.transform(F.slice("cores", F.lit(1), n - 1), lambda c: F.right(c, F.lit(overlap))))
    later = F.concat(F.transform(F.slice("cores", F.lit(2), n - 1), lambda c: F.left(c, F.lit(overlap))), empty)
    rows = cores.select("key", F.posexplode(F.arrays_zip(earlier.alias("b"), "cores", later.alias("a"))).alias("k", "c"))
    return rows.select("key", "k", F.concat("c.b", "c.cores", "c.a").alias("text"), F.length("c.b").alias("before"),
                       F.length("c.cores").alias("core"), F.length("c.a").alias("after"))


def encode_long(texts: DataFrame, ranks: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(key, ids) of (key, text) by overlapping chunks; keys are distinct.

    Chunks, not texts, are dealt to the tasks. What a task collects for one key is one
    text's ids.
    """
    if chunk < 2 * overlap + 2:
        raise ValueError("chunks must be longer than both overlaps")
    parts = cut_lineage(chunks(texts, chunk, overlap).repartition("key", "k"))
    found = parts.mapInArrow(marks(ranks, overlap), "key string, k int, left_marks array<int>, right_marks array<int>")
    found = cut_lineage(found)
    joints = found.select("key", (F.col("k") + 1).alias("k"), "right_marks").where("right_marks IS NOT NULL").join(
        found.select("key", "k", "left_marks"), ["key", "k"]).select(
        "key", "k", F.array_min(F.array_intersect("right_marks", "left_marks")).alias("at"))
    joints = cut_lineage(joints)
    apart = cut_lineage(joints.where("at IS NULL").select("key").distinct())
    if joints.count() <= BROADCAST_ROWS:        # the chunks then stay where they are
        joints, apart = F.broadcast(joints), F.broadcast(apart)
    stitched = (parts.join(apart, "key", "left_anti")
                .join(joints.select("key", "k", F.col("at").alias("left")), ["key", "k"], "left")
                .join(joints.select("key", (F.col("k") - 1).alias("k"), F.col("at").alias("right")), ["key", "k"], "left"))
    ids = stitched.select("key", "k", "text", "before", "core", "left", "right").mapInArrow(
        between(ranks), "key string, k int, ids array<int>")
    joined = ids.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts")).select(
        "key", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
    unbroken = texts.join(apart, "key", "left_semi").select("key", "text").mapInArrow(
        whole_texts(ranks), "key string, ids array<int>")
    return joined.unionByName(unbroken)


def encode(docs: DataFrame, ranks: str, doc_id: str = "doc_id", text: str = "text",
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids) for each row. Texts of one chunk are not shuffled."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    short = rows.where(F.length("text") <= chunk).mapInArrow(whole_texts(ranks), "doc_id long, ids array<int>")
    long_rows = rows.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    texts = cut_lineage(long_rows.select("key", "text").dropDuplicates(["key"]))
    ids = cut_lineage(encode_long(texts, ranks, chunk, overlap))
    return short.unionByName(long_rows.select("doc_id", "key").join(ids, "key").select("doc_id", "ids"))


def decoded_parts(batches: Iterator[pa.RecordBatch], ranks: str):
    """(part of a batch, ids of each row, bytes of each row)"""
    coder = codec(ranks)
    for batch in batches:
        for start in range(0, batch.num_rows, AT_A_TIME):
            part = batch.slice(start, AT_A_TIME)
            lists = [np.asarray(x.values, "<i4") for x in part.column("ids")]
            yield part, lists, [coder.decode(ids.tolist()) for ids in lists]


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids``."""
    names = [c for c in encoded.columns if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, texts in decoded_parts(batches, ranks):
            yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(texts, pa.binary())], [*names, "decoded"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*names).schema)
    return encoded.select(*names).mapInArrow(run, f"{kinds}, decoded binary")


def digests(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of (doc_id, ids): decoded where they are,
    only the hashes come back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lists, texts in decoded_parts(batches, ranks):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(x) for x in lists], pa.int64()),
                 pa.array([sha256(x.tobytes()).hexdigest() for x in lists]),
                 pa.array([sha256(t).hexdigest() for t in texts])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark, sf_dir):
    import public_tokenizers
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return digests(encode(docs, ranks), ranks)
