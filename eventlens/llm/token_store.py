"""Token ids of whole texts, kept in ORC.

Ids are a list column, so ORC run-length encodes them as integers; each stripe has row
indexes, and the document ids have Bloom filters. Rows are in ascending document order over
all files, so a lookup of documents skips files, stripes and row groups by their metadata,
and a scan reads stripes in parallel. ``seq`` is the place of a row: the file's number in the
high bits and the row within the file in the low 33.

Texts are cut at single spaces between two non-blank characters, and where ASCII letters, marks
and line feeds meet. There the tokenizer always starts a new token, so the pieces have the ids
that they have in the whole text. Arrow numbers the distinct pieces of some texts at a time, only
these are looked up, and each worker encodes a piece once as long as it remembers it.

Defined results
    null or empty text: no ids but the end id
    null document ids come first; rows of one id are ordered by text
    repeated rows: each is encoded and written
    very long texts: encoded whole
    no rows: a folder without rows
    other columns: not read
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from eventlens.session import cut_lineage, scratch_path
from eventlens.llm.byte_words import parts
from eventlens.llm.common import table, whole
from eventlens.llm.pieces import PATTERN, REMEMBERED, ranges
from eventlens.llm.token_counts import byte_symbols

END_ID = 2
STORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("seq", T.LongType()),
                       T.StructField("ids", T.ArrayType(T.IntegerType()))])
#: Marks that end words; a run of them is a pre-token of its own.
MARKS = ".,;:!?"
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_KIND = np.zeros(256, np.uint8)         # 0: no cut beside it but at a space
for _number, _characters in enumerate((_LETTERS, MARKS, "\n"), 1):
    _KIND[[ord(c) for c in _characters]] = _number
_ENDS = np.array([not chr(b).isspace() for b in range(128)] + [False] * 128)
# blanks outside ASCII begin with one of these bytes
_FOLLOWS = np.array([not chr(b).isspace() for b in range(128)] + [b not in (0xC2, 0xE1, 0xE2, 0xE3) for b in range(128, 256)])
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of strings by a byte-level tokenizer, and of many pieces at once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)     # ids that begin with a space
        self.blank[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(c.isspace() or c in MARKS for t in added for c in t):
            raise ValueError("added tokens with blanks or marks are not supported")
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern = regex.compile(PATTERN)
        self.shown = "".join(byte_symbols())
        self.known: dict[str, bytes] = {}       # ids of pieces and of pre-tokens

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(e.ids, "<u4") for e in
                self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece with a space before it, as bytes. Pieces without a space inside
        are encoded as one text, in which they are what begins with a space."""
        plain = [p for p in pieces if p and " " not in p]
        found = {}
        for first in range(0, len(plain), 512):
            part = plain[first:first + 512]
            ids = self([" " + " ".join(part)])[0]
            at = [*(np.flatnonzero(self.blank[ids]) * 4).tolist(), ids.nbytes]
            raw = ids.tobytes()
            for piece, start, end in zip(part, at, at[1:]):
                found[piece] = raw[start:end]
        rest = [p for p in pieces if p not in found]
        found.update(zip(rest, (i.tobytes() for i in self([f" {p}" for p in rest]))))
        return [found[p] for p in pieces]

    def remembered(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces as bytes. What is new is cut into pre-tokens, and each new one
        of these goes once through the tokenizer's own model; pieces with added tokens go through
        the whole tokenizer."""
        known = self.known
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = pieces
        if self.added and self.added.search("\n".join(new)):
            special = [p for p in new if self.added.search(p)]
            known.update(zip(special, (i.tobytes() for i in self(special))))
            new = [p for p in new if p not in known]
        single = [p for p in new if p.isascii() and (p.isalpha() or p[0] == " " and p[1:].isalpha())]
        several = list(set(new).difference(single))
        split = [self.pattern.findall(p) for p in several]
        tokenize, shown = self.model.tokenize, self.shown
        for word in {*single, *chain.from_iterable(split)}:
            if word not in known:
                tokens = tokenize(word.encode().decode("latin-1").translate(shown))
                known[word] = array("I", [t.id for t in tokens]).tobytes()
        known.update([(p, b"".join([known[w] for w in words])) for p, words in zip(several, split) if len(words) > 1])
        return [known[p] for p in pieces]


def encoder(path: str) -> Encoder:
    """That of this worker, with what it remembers."""
    return _encoders.get(path) or _encoders.setdefault(path, Encoder(path))


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pieces, borders): what the bytes of the texts are cut into, and where those of each text
    begin. Cuts are at single spaces between two characters that are surely no blanks, and where
    ASCII letters, MARKS and line feeds meet; a pre-token begins at each of them."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    offsets, skipped = offsets - offsets[0], int(offsets[0])
    n = int(offsets[-1])
    data = np.frombuffer(texts.buffers()[2], np.uint8, n, skipped) if n else np.zeros(0, np.uint8)
    begins = np.zeros(n + 1, bool)
    kind = _KIND[data]
    begins[1:-1] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
    space = np.flatnonzero(data[1:-1] == 32) + 1
    last, following = data[space - 1], data[space + 1]
    before = _ENDS[last]
    wide = np.flatnonzero(last >= 0x80)     # the first byte of a character tells whether it may be a blank
    at = space[wide]
    two, three, four = (data[np.maximum(at - k, 0)] for k in (2, 3, 4))
    before[wide] = ((two >= 0xC3) & (two < 0xE0)) | ((two < 0xC0) & (
        ((three >= 0xE4) & (three < 0xF0)) | ((three < 0xC0) & (four >= 0xF0))))
    begins[space[before & _FOLLOWS[following]]] = True
    begins[offsets] = True
    starts = np.flatnonzero(begins)         # the end of the last text included
    borders = np.searchsorted(starts, offsets)
    pieces = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data))
    return pieces, borders


def encode(texts: pa.Array, encoder: Encoder, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(borders, ids) of texts that are not null, each with the end id. Only the distinct pieces
    are looked up; their ids are then taken by number."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, "<u4")
    pieces, borders = pieces_of(texts)
    coded = pieces.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    found = [*encoder.remembered(distinct), int(end_id).to_bytes(4, "little")]
    code = np.insert(np.asarray(coded.indices), borders[1:], len(found) - 1)
    size = np.fromiter(map(len, found), np.int64, len(found)) // 4
    at = np.cumsum(size) - size
    taken = size[code]
    ids = np.frombuffer(b"".join(found), "<u4")[ranges(at[code], taken)]
    ends = np.cumsum(taken)[borders[1:] + np.arange(len(texts))]
    return np.concatenate(([0], ends)), ids


def encoding(path: str, end_id: int) -> Callable:
    """For mapInArrow: (doc_id, text) to (doc_id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in parts(batches):
            borders, ids = encode(part.column("text"), own, end_id)
            lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids.view("<i4"), pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], ["doc_id", "ids"])
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
              end_id: int = END_ID, stripe_bytes: int = 64 << 20, stride: int = 10_000) -> None:
    """Encode ``docs`` and write them in ascending order of ``doc_id``.

    Raw texts are range-partitioned, not ids: the sampling for the ranges then reads no text
    twice through the tokenizer. Every task sorts and writes its own range.
    """
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    rows = ordered.mapInArrow(encoding(tokenizer, end_id), "doc_id long, ids array<int>")
    (rows.select("doc_id", F.monotonically_increasing_id().alias("seq"), "ids")
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.create.index", "true")
     .option("orc.row.index.stride", stride).option("orc.stripe.size", stripe_bytes)
     .option("compression", "zstd").orc(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, seq, ids); a filter on ``doc_id`` reaches the files' metadata and Bloom filters."""
    return spark.read.schema(STORED).orc(path)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        offsets = np.asarray(lists.offsets).astype(np.int64)
        values = np.ascontiguousarray(np.asarray(lists.values), "<i4")
        crc = [zlib.crc32(values[a:b].data) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("seq"), pa.array(np.diff(offsets), pa.int64()),
             pa.array(crc, pa.int64())], ["doc_id", "seq", "n_tokens", "ids_crc32"])


def positions(stored: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of stored rows; ``start`` counts the ids before.

    Files are summed, one row per file is added up in order, and inside a file rows are
    added up in order: no task sees more than the rows of one file.
    """
    rows = stored.mapInArrow(_digests, "doc_id long, seq long, n_tokens long, ids_crc32 long")
    # written once: the ids are read and digested for the sums and for the places in one pass
    rows = cut_lineage(rows.withColumn("file", F.shiftright("seq", 33)))
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select(F.col("file").alias("f"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(bases, F.col("file") == F.col("f")).select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op5_token_ids(spark, sf_dir):
    import public_tokenizers
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents", "doc_id", "text"), path,
              public_tokenizers.path("byte_bpe_50k.json"))
    return positions(read_ids(spark, path))
