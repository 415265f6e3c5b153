"""Token counts of whole texts by rank-synchronous merging of arrays.

All distinct pre-tokens of a batch lie one after the other in one array of symbols. In each
round every pre-token finds the lowest-ranked pair it holds and merges all its occurrences
from left to right, all pre-tokens at once; those without a pair left are done, and what
counts is the number of symbols that survive.

Merging all occurrences of a pair at once equals one merge after the other where no pair can
rank before the pair that made its parts, which holds for trained merge lists and is checked
when a file is read; otherwise only the leftmost occurrence is merged in a round.

Defined results
    null or empty text: 0 tokens, 0 bytes
    special strings in a text (added tokens of the file): one token each
    very long texts or words: whole; repeated rows: each has its own row
    no rows: no rows
    other columns: not read
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from eventlens.llm.common import table, whole
from eventlens.llm.pieces import AT_A_TIME, PATTERN, REMEMBERED, cut

LIMIT = 512
NONE = np.iinfo(np.int64).max


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is
    printable, the next characters from U+0100 on in order elsewhere."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class MergeTable:
    """Ranks of symbol pairs, and the merging of many sequences at once."""

    def __init__(self, first: np.ndarray, merges: list[tuple[int, int, int]]):
        """``first``: the symbol of each byte; ``merges``: (left, right, merged) by rank."""
        self.first = first
        self.width = 1 + max([int(first.max()), *(max(m) for m in merges)])
        keys = np.array([a * self.width + b for a, b, _ in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([m for *_, m in merges], np.int64)
        made: dict[int, int] = {}
        for rank, (_, _, m) in enumerate(merges):
            made.setdefault(m, rank)
        self.ordered = all(max(made.get(a, -1), made.get(b, -1)) < made[m] == rank
                           for rank, (a, b, m) in enumerate(merges))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left of each word."""
        lengths = np.array([len(w) for w in words], np.int64)
        counts = lengths.copy()
        ids = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        while len(ids) > 1 and len(self.keys):
            rank = np.full(len(ids), NONE)
            rank[:-1] = np.where(owner[:-1] == owner[1:], self.rank(ids[:-1], ids[1:]), NONE)
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(starts, append=len(ids))
            lowest = np.minimum.reduceat(rank, starts)
            counts[owner[starts]] = sizes
            best = np.repeat(lowest, sizes)
            hit = (rank == best) & (best < NONE)
            hit = self._apart(hit) if self.ordered else self._leftmost(hit, owner)
            gone = np.zeros(len(ids), bool)
            gone[1:] = hit[:-1]
            ids = np.where(hit, self.merged[np.where(hit, rank, 0)], ids)
            live = ~gone & np.repeat(lowest < NONE, sizes)      # others are done
            counts[owner[starts]] -= np.add.reduceat(gone.astype(np.int64), starts)
            ids, owner = ids[live], owner[live]
        return counts

    @staticmethod
    def _apart(hit: np.ndarray) -> np.ndarray:
        """Every other one of hits that stand side by side, from the left."""
        at = np.arange(len(hit))
        begins = hit & ~np.concatenate(([False], hit[:-1]))
        return hit & ((at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0)

    @staticmethod
    def _leftmost(hit: np.ndarray, owner: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(hit)
        kept = np.zeros(len(hit), bool)
        kept[at[np.flatnonzero(np.diff(owner[at], prepend=-1))]] = True
        return kept


class Counter:
    """Token counts by a byte-level BPE file of the ``tokenizers`` library (.json)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = (model["type"] == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                 and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                 and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
                 and not model.get("end_of_word_suffix"))
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        vocab = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.table = MergeTable(np.array([vocab[s] for s in byte_symbols()], np.int64),
                                [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs])
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        if any(c.isspace() for t in added for c in t):
            raise ValueError("added tokens with blanks are not supported")
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.pattern = regex.compile(PATTERN)
        self.memory: dict[str, int] = {}

    def words(self, piece: str) -> tuple[list[str], int]:
        """Pre-tokens of a piece, and how many added tokens it holds."""
        if self.added is None:
            return self.pattern.findall(piece), 0
        parts = self.added.split(piece)
        return [w for p in parts for w in self.pattern.findall(p)], len(parts) - 1

    def pieces(self, pieces: Iterable[str]) -> list[int]:
        split = [self.words(p) for p in pieces]
        distinct = list({w for words, _ in split for w in words})
        n = dict(zip(distinct, self.table.counts([w.encode() for w in distinct]).tolist()))
        return [sum(map(n.__getitem__, words)) + added for words, added in split]

    def __call__(self, texts: list[str]) -> list[int]:
        split = [cut(t) for t in texts]
        first = self.pieces(p[0] for p in split)
        rest = [p[1:] for p in split]
        new = list(set().union(*rest).difference(self.memory))
        if len(self.memory) + len(new) > REMEMBERED:
            self.memory.clear()
            new = list(set().union(*rest))
        self.memory.update(zip(new, self.pieces(f" {p}" for p in new)))
        return [f + sum(map(self.memory.__getitem__, r)) for f, r in zip(first, rest)]


_counters: dict[str, Counter] = {}


def counting(path: str) -> Callable:
    """For mapInArrow: (doc_id, n_bytes, text) to (doc_id, n_bytes, n_tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(path) or _counters.setdefault(path, Counter(path))
        for batch in batches:
            for start in range(0, batch.num_rows, AT_A_TIME):
                part = batch.slice(start, AT_A_TIME)
                n = counter(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row; no shuffle."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    rows = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = rows.mapInArrow(counting(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark, sf_dir):
    import public_tokenizers
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text"),
                        public_tokenizers.path("byte_bpe_50k.json"))
