"""Words of whole texts found on their UTF-8 bytes, many texts at a time.

A table gives every byte a class: a gap, a part of a word, or a break that also ends the
piece. Only ASCII bytes are gaps or breaks, so words are valid UTF-8. A word never goes over
the end of its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from eventlens.llm.shingles import mix

GAP, PART, BREAK = 0, 1, 2
#: Bytes of text that a worker takes at a time; a longer text is taken alone.
PART_BYTES = 4 << 20
#: Bytes of a word that are hashed by eights for all words at once; longer words one by one.
LONG = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FIRST, _SECOND = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def classes(gaps: str = "", breaks: str = "", words: str | None = None) -> np.ndarray:
    """The class of each byte. With ``words`` every other ASCII character is a gap."""
    table = np.full(256, PART, np.uint8)
    if words is not None:
        table[:128] = GAP
        table[[ord(c) for c in words]] = PART
    table[[ord(c) for c in gaps]] = GAP
    table[[ord(c) for c in breaks]] = BREAK
    return table


def parts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of about PART_BYTES of ``column``."""
    for batch in batches:
        offsets = _offsets(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + PART_BYTES, "right")) - 1
            to = max(at + 1, to)
            yield batch.slice(at, to - at)
            at = to


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return np.frombuffer(texts.buffers()[1], kind, len(texts) + 1, texts.offset * kind().itemsize).astype(np.int64)


class Words:
    """The words of ``texts`` in order, A-Z lower-cased unless ``lower`` is false.

    ``owner``, ``start``, ``end``: number of the text, and byte range in ``data``, where the
    texts are cut at ``offsets``;
    ``begins``: whether the word is the first of its piece.
    """

    def __init__(self, texts: pa.Array, table: np.ndarray, lower: bool = True):
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = _offsets(texts)
        first, last = int(offsets[0]), int(offsets[-1])
        n = last - first
        self.data = np.zeros(n + LONG, np.uint8)
        if n:
            data = np.frombuffer(texts.buffers()[2], np.uint8, n, first)
            self.data[:n] = _LOWER[data] if lower else data
        self.offsets = offsets = offsets - first
        kind = table[self.data[:n]]
        part = kind == PART
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        begins, ends = part.copy(), part.copy()
        begins[1:] &= ~part[:-1] | edge[1:-1]
        ends[:-1] &= ~part[1:] | edge[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        counts = np.diff(np.searchsorted(self.start, offsets))
        self.owner = np.repeat(np.arange(len(texts)), counts)
        piece = np.searchsorted(np.flatnonzero(kind == BREAK), self.start)
        self.begins = np.ones(len(self.start), bool)
        self.begins[1:] = (piece[1:] != piece[:-1]) | (self.owner[1:] != self.owner[:-1])

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each word, independent of each other."""
        length = self.end - self.start
        eights = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        a = length.astype(np.uint64) * _FIRST
        b = length.astype(np.uint64) * _SECOND
        at = None       # all words
        for j in range(LONG // 8):
            left = (length if at is None else length[at]) - 8 * j
            x = eights[(self.start if at is None else self.start[at]) + 8 * j]
            short = np.maximum(0, 8 - left) * 8
            x = x & (np.uint64(0xFFFFFFFFFFFFFFFF) >> short.astype(np.uint64))
            if at is None:
                a, b = mix(a ^ x), mix((b + x) * _FIRST)
            else:
                a[at], b[at] = mix(a[at] ^ x), mix((b[at] + x) * _FIRST)
            more = np.flatnonzero(left > 8)
            at = more if at is None else at[more]
            if not len(at):
                break
        for i in at:
            whole = xxhash.xxh3_128_intdigest(self.data[self.start[i]:self.end[i]].tobytes())
            a[i], b[i] = whole & 0xFFFFFFFFFFFFFFFF, whole >> 64
        return a, b

    def digests(self) -> np.ndarray:
        """The hash that ``shingles.words_of`` gives each word, taken once for equal words."""
        coded = pa.array(self.hashes()[0]).dictionary_encode()
        code = np.asarray(coded.indices)
        at = np.zeros(len(coded.dictionary), np.int64)
        at[code] = np.arange(len(code))
        raw, digest = self.data.tobytes(), xxhash.xxh3_64_intdigest
        return np.fromiter((digest(raw[i:j]) for i, j in zip(self.start[at].tolist(), self.end[at].tolist())),
                           np.uint64, len(at))[code]

    def strings(self, which: np.ndarray) -> pa.StringArray:
        """The words with these numbers."""
        return cut_out(self.data, self.start[which], self.end[which])


def cut_out(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.StringArray:
    """Strings of the byte ranges of ``data``."""
    length = end - start
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    taken = data[np.repeat(start - offsets[:-1], length) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(offsets), pa.py_buffer(taken)).cast(pa.string())
