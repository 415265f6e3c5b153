"""Alignment of two tokenizers' tokens over the bytes of each text.

Both token rows tile the bytes of a space and the text. With A the incidence of the first
tokenizer's tokens and bytes and B that of the second's, both in compressed sparse rows,
A times B transposed links the tokens that overlap and counts the bytes they share. Bytes
where a token of either side ends cut both rows into groups: a group begins at a token whose
links do not touch those of the token before. Group incidence by ids, with multiplicities,
times its counterpart gives how often each pair of ids shares a group.

Sparse products go row by row (Gustavson): each entry of a left row takes in the right row of
its column, and what falls on one place is added; numpy does so for all rows at once.

Texts are cut at single spaces between two non-blank characters (:mod:`pieces`). The first
tokenizer starts a pre-token there, and no entry of the second has its space mark after
another character, so both have a token border there: links and groups of a text are those of
its pieces, and each worker works out a piece once as long as it remembers it.

Id pairs are counted by the documents that hold them linked, summed in the task first. Up to
PAIRS distinct pairs are broadcast to weigh the links; more are joined by shuffle.

Defined results
    null or empty text, and texts whose tokens' bytes are not the text's on both sides (as with
    the space mark itself): no tokens; zeros and an empty digest
    strings of special tokens: ordinary text
    repeated rows: each is a document, also in the counts; null ids stay null
    very long texts: whole; no rows: no rows; other columns: not read
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterator
from functools import partial
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventlens.session import cut_lineage
from eventlens.llm.byte_words import parts
from eventlens.llm.common import table, whole
from eventlens.llm.pieces import cut, ranges
from eventlens.llm.token_counts import byte_symbols
from eventlens.llm.token_store import Encoder

MARK = "▁"
#: Pieces that a worker remembers, and distinct pairs that are broadcast (16 bytes each).
REMEMBERED, PAIRS = 150_000, 4_000_000
#: Pieces that are encoded as one text.
TOGETHER = 512

Sparse = tuple[np.ndarray, np.ndarray, np.ndarray]      # row borders, columns, values


def product(left: Sparse, right: Sparse, width: int) -> Sparse:
    """The product of two sparse matrices, the right one of ``width`` columns, by rows."""
    borders, columns, values = left
    size = np.diff(right[0])[columns]
    taken = ranges(right[0][columns], size)
    row = np.repeat(np.repeat(np.arange(len(borders) - 1), np.diff(borders)), size)
    place = row * np.int64(width) + right[1][taken]
    value = np.repeat(values, size) * right[2][taken]
    if np.any(place[1:] < place[:-1]):
        order = np.argsort(place, kind="stable")
        place, value = place[order], value[order]
    new = np.flatnonzero(np.diff(place, prepend=-1))
    summed = np.add.reduceat(value, new) if len(new) else value
    found = place[new]
    return np.searchsorted(found, np.arange(len(borders)) * np.int64(width)), found % width, summed


def by_rows(row: np.ndarray, column: np.ndarray, rows: int, width: int) -> Sparse:
    """Entries, repeats added up, as sparse rows."""
    found, n = np.unique(row * np.int64(width) + column, return_counts=True)
    return np.searchsorted(found, np.arange(rows + 1) * np.int64(width)), found % width, n


def overlap(length_a: np.ndarray, length_b: np.ndarray) -> Sparse:
    """Token links and shared bytes of two rows of tokens that tile the same bytes."""
    n = int(length_a.sum())
    ones = np.ones(n, np.int64)
    a = (np.concatenate(([0], np.cumsum(length_a))), np.arange(n), ones)
    b = (np.arange(n + 1), np.repeat(np.arange(len(length_b)), length_b), ones)     # transposed
    return product(a, b, max(1, len(length_b)))


def groups(links: Sparse, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of both sides, from the overlap links."""
    borders, column, _ = links
    new = np.ones(len(borders) - 1, bool)
    new[1:] = column[borders[1:-1]] > column[borders[1:-1] - 1]
    group_a = np.cumsum(new) - 1
    group_b = np.zeros(n_b, np.int64)
    group_b[column] = np.repeat(group_a, np.diff(borders))
    return group_a, group_b


class Bytes:
    """The bytes of each token of a vocabulary."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ranges(self.start[ids], self.length[ids])]


class Aligner:
    """Tokens, groups and links of pieces by two tokenizers, remembered."""

    def __init__(self, first: str, second: str):
        import sentencepiece
        self.a = Encoder(first)
        self.a.tokenizer.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        size = self.b.get_piece_size()
        entries = [self.b.id_to_piece(i) for i in range(size)]
        if any(MARK in e.lstrip(MARK) for e in entries):
            raise ValueError(f"{second} has entries with a space after another character")
        symbol = {s: bytes([i]) for i, s in enumerate(byte_symbols())}
        vocabulary = self.a.tokenizer.get_vocab()
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            tokens[i] = b"".join(symbol.get(c, c.encode()) for c in token)
        self.bytes_a = Bytes(tokens)
        self.bytes_b = Bytes([bytes([int(e[3:5], 16)]) if self.b.is_byte(i) else e.replace(MARK, " ").encode()
                              for i, e in enumerate(entries)])
        self.width_a, self.width_b = len(tokens), size
        self.blank_b = np.array([e.startswith(MARK) for e in entries])
        self.names = [str(i) for i in range(max(len(tokens), size))]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[str] = []                       # the groups of each piece
        self.totals = np.zeros((0, 5), np.int64)        # n_a, n_b, n_groups, n_links, n_overlaps
        self.bad = np.zeros(0, bool)
        self.borders = np.zeros(1, np.int64)            # of the pairs of each piece
        self.pairs = self.times = np.zeros(0, np.int64)
        self.uses = np.zeros(0, np.int64)

    def thin_out(self) -> None:
        """Forget the pieces that came only once since they were learnt or last kept."""
        kept = np.flatnonzero(self.uses > 1)
        if len(kept) > REMEMBERED:
            return self.forget()
        names = list(self.known)
        self.known = {names[i]: n for n, i in enumerate(kept.tolist())}
        self.text = [self.text[i] for i in kept.tolist()]
        self.totals, self.bad, self.uses = self.totals[kept], self.bad[kept], np.ones(len(kept), np.int64)
        size = np.diff(self.borders)[kept]
        taken = ranges(self.borders[kept], size)
        self.pairs, self.times = self.pairs[taken], self.times[taken]
        self.borders = np.concatenate(([0], np.cumsum(size)))

    def flat(self, pieces: list[str]):
        """(ids, owner, table of bytes) of both sides, for a space and each piece. Pieces without
        a space inside are encoded together: each begins with the next token that has a space
        in front."""
        plain = [p for p in pieces if p and " " not in p and MARK not in p]
        rest = [p for p in pieces if not p or " " in p or MARK in p]
        together = [" ".join(plain[i:i + TOGETHER]) for i in range(0, len(plain), TOGETHER)]
        pieces[:] = plain + rest
        encode_a = partial(self.a.tokenizer.encode_batch_fast, add_special_tokens=False)
        sides = (([e.ids for e in encode_a([f" {t}" for t in together])], self.a.blank,
                  [e.ids for e in encode_a([f" {p}" for p in rest])], self.bytes_a),
                 (self.b.encode(together, num_threads=1), self.blank_b, self.b.encode(rest, num_threads=1), self.bytes_b))
        for joined, blank, alone, of in sides:
            ids = np.fromiter(chain.from_iterable(joined), np.int64)
            owner = np.cumsum(blank[ids]) - 1
            if len(owner) and owner[-1] != len(plain) - 1:
                raise ValueError("a tokenizer does not begin anew at spaces")
            count = np.array([len(x) for x in alone], np.int64)
            yield (np.concatenate([ids, np.fromiter(chain.from_iterable(alone), np.int64)]),
                   np.concatenate([owner, len(plain) + np.repeat(np.arange(len(rest)), count)]), of)

    def tile(self, pieces: list[str]):
        """(ids, owner) of both sides and which pieces are bad; those have no tokens. Puts the
        pieces in the order of their numbers."""
        sides = list(self.flat(pieces))
        raw = [f" {p}".encode() for p in pieces]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        bad = np.zeros(len(pieces), bool)
        for ids, owner, of in sides:
            bad |= np.bincount(owner, of.length[ids], len(pieces)).astype(np.int64) != size
        kept = ~bad     # where the lengths agree, the bytes must too
        true = np.frombuffer(b"".join(raw if kept.all() else [r for r, k in zip(raw, kept) if k]), np.uint8)
        for ids, owner, of in sides:
            differ = of.join(ids[kept[owner]]) != true
            if differ.any():
                bad[np.repeat(np.flatnonzero(kept), size[kept])[differ]] = True
        if bad.any():
            return [(ids[~bad[owner]], owner[~bad[owner]]) for ids, owner, _ in sides], bad
        return [(ids, owner) for ids, owner, _ in sides], bad

    def whole(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Both rows of ids of one text, without its pieces' being remembered."""
        a = np.array(self.a.tokenizer.encode(f" {text}", add_special_tokens=False).ids if text else [], np.int64)
        b = np.array(self.b.encode(text) if text else [], np.int64)
        raw = np.frombuffer(f" {text}".encode() if text else b"", np.uint8)
        if np.array_equal(self.bytes_a.join(a), raw) and np.array_equal(self.bytes_b.join(b), raw):
            return a, b
        return a[:0], b[:0]

    def learn(self, pieces: list[str]) -> None:
        if not pieces:
            return
        n = len(pieces)
        ((a, owner_a), (b, owner_b)), bad = self.tile(pieces)
        links = overlap(self.bytes_a.length[a], self.bytes_b.length[b])
        group_a, group_b = groups(links, len(b))
        n_groups = int(group_a[-1]) + 1 if len(a) else 0
        # (piece, id) by groups, times groups by ids
        row, at = np.unique(owner_a * np.int64(self.width_a) + a, return_inverse=True)
        shared = product(by_rows(at, group_a, len(row), max(1, n_groups)), by_rows(group_b, b, n_groups, self.width_b), self.width_b)
        per_row = np.diff(shared[0])
        pair = np.repeat(row % self.width_a, per_row) * np.int64(self.width_b) + shared[1]
        of_piece = np.repeat(row // self.width_a, per_row)
        overlaps = np.repeat(owner_a, np.diff(links[0]))
        first_a = np.flatnonzero(np.diff(group_a, prepend=-1))
        totals = np.stack([np.bincount(owner_a, minlength=n), np.bincount(owner_b, minlength=n),
                           np.bincount(owner_a[first_a], minlength=n),
                           np.bincount(of_piece, shared[2], n).astype(np.int64), np.bincount(overlaps, minlength=n)], 1)
        self.text += self.written(n, (a, owner_a, group_a), (b, owner_b, group_b))
        known = len(self.known)
        self.known.update(zip(pieces, range(known, known + n)))
        self.totals = np.concatenate([self.totals, totals])
        self.bad = np.concatenate([self.bad, bad])
        self.borders = np.concatenate([self.borders, self.borders[-1] + np.cumsum(np.bincount(of_piece, minlength=n))])
        self.pairs, self.times = np.concatenate([self.pairs, pair]), np.concatenate([self.times, shared[2]])

    def written(self, n: int, side_a, side_b) -> list[str]:
        """Each piece's groups as ``a,a|b;a|b,b``."""
        ids, owner, group, side = (np.concatenate(x) for x in zip(
            (*side_a, np.zeros(len(side_a[0]), np.int8)), (*side_b, np.ones(len(side_b[0]), np.int8))))
        order = np.lexsort((side, group))
        ids, owner, group, side = ids[order], owner[order], group[order], side[order]
        before = np.full(len(ids), ",", object)
        opens = np.diff(group, prepend=-1) != 0
        before[opens] = ";"
        before[np.diff(owner, prepend=-1) != 0] = ""
        before[(side == 1) & ~opens & (np.diff(side, prepend=0) != 0)] = "|"
        written = list(map(operator.add, before.tolist(), map(self.names.__getitem__, ids.tolist())))
        border = np.searchsorted(owner, np.arange(n + 1)).tolist()
        return ["".join(written[i:j]) for i, j in zip(border, border[1:])]

    def __call__(self, texts: list[str]):
        """Totals (5 columns), digests, and (document, pair, times) of the texts."""
        pieces = [cut(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.thin_out()
        self.learn(list(set().union(*pieces).difference(self.known)))
        count = np.array([len(p) for p in pieces], np.int64)
        owner = np.repeat(np.arange(len(texts)), count)
        flat = [c for p in pieces for c in map(self.known.__getitem__, p)]
        code = np.array(flat, np.int64)
        uses = np.bincount(code, minlength=len(self.known))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        good = np.ones(len(texts), bool)
        good[owner[self.bad[code]]] = False
        good &= count > 0
        totals = np.zeros((len(texts), 5), np.int64)
        for j in range(5):
            totals[:, j] = np.bincount(owner, self.totals[code, j], len(texts))
        totals[~good] = 0
        border = np.concatenate(([0], np.cumsum(count))).tolist()
        digests = [sha256(";".join(map(self.text.__getitem__, flat[i:j])).encode()).hexdigest() if ok else ""
                   for i, j, ok in zip(border, border[1:], good.tolist())]
        kept = good[owner]
        key, times = np.unique((owner[kept] << 32) | code[kept], return_counts=True)
        doc, code = key >> 32, key & 0xFFFFFFFF
        size = np.diff(self.borders)[code]
        taken = ranges(self.borders[code], size)
        spread = doc.repeat(size) * np.int64(self.width_a * self.width_b) + self.pairs[taken]
        weight = np.repeat(times, size) * self.times[taken]
        order = np.argsort(spread, kind="stable")
        spread, weight = spread[order], weight[order]
        first = np.flatnonzero(np.diff(spread, prepend=-1))
        summed = np.add.reduceat(weight, first) if len(first) else weight
        return totals, digests, spread[first] // (self.width_a * self.width_b), spread[first] % (self.width_a * self.width_b), summed


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    return _aligners.get((first, second)) or _aligners.setdefault((first, second), Aligner(first, second))


TOTALS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps"]
FOUND = "doc_id long, " + ", ".join(f"{n} long" for n in TOTALS) + ", groups_sha256 string, pairs array<long>, times array<long>"


def _align(first: str, second: str) -> Callable:
    """For mapInArrow: (doc_id, text) to FOUND; a pair is the first id times the second's
    number of ids, plus the second id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(first, second)
        for part in parts(batches):
            totals, digests, doc, pair, times = align(part.column("text").to_pylist())
            offsets = pa.array(np.searchsorted(doc, np.arange(part.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(totals[:, j]) for j in range(len(TOTALS))), pa.array(digests, pa.string()),
                 pa.ListArray.from_arrays(offsets, pa.array(pair)), pa.ListArray.from_arrays(offsets, pa.array(times))],
                ["doc_id", *TOTALS, "groups_sha256", "pairs", "times"])
    return run


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pairs, one list for each document) to (pair, n)."""
    for batch in batches:
        value, n = np.unique(np.asarray(batch.column("pairs").flatten()), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(value, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])


def _weigh(shared) -> Callable:
    """For mapInArrow: adds n_best and count_sum from the broadcast counts of pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shared.value
        for batch in batches:
            pair, times = batch.column("pairs"), np.asarray(batch.column("times").flatten())
            at = np.searchsorted(known, np.asarray(pair.flatten()))
            border = np.asarray(pair.offsets).astype(np.int64)
            border = border - border[0]
            sums = [np.concatenate(([0], np.cumsum(times * x[at])))[border] for x in (best, count)]
            names = [n for n in batch.schema.names if n not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), *(pa.array(np.diff(s)) for s in sums)],
                                             [*names, "n_best", "count_sum"])
    return run


def align(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Totals, digest of the groups, and linked id pairs of each document; a written table."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return cut_lineage(texts.mapInArrow(_align(first, second), FOUND).withColumn("row", F.monotonically_increasing_id()))


def pair_counts(aligned: DataFrame, width_b: int) -> DataFrame:
    """(pair, a, b, n, best): how many documents hold a pair linked, and whether no other pair
    of its first id has more. A written table."""
    counted = cut_lineage(aligned.select("pairs").mapInArrow(_documents, "pair long, n long").groupBy("pair")
                          .agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"pair div {width_b}"))
                          .withColumn("b", F.col("pair") % width_b))
    most = counted.groupBy("a").agg(F.max("n").alias("most"))
    return cut_lineage(counted.join(most, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best")))


def weighed(aligned: DataFrame, counts: DataFrame, most: int = PAIRS) -> DataFrame:
    """``aligned`` with n_best and count_sum in place of its pairs."""
    columns = ["doc_id", *TOTALS, "groups_sha256"]
    kinds = "doc_id long, " + ", ".join(f"{n} long" for n in TOTALS) + ", groups_sha256 string, n_best long, count_sum long"
    if counts.count() <= most:
        found = counts.select("pair", "n", F.col("best").cast("long").alias("best")).toArrow()
        pair, n, best = (np.asarray(found[c].combine_chunks()) for c in ("pair", "n", "best"))
        order = np.argsort(pair)
        shared = aligned.sparkSession.sparkContext.broadcast((pair[order], n[order], best[order]))
        return aligned.select(*columns, "pairs", "times").mapInArrow(_weigh(shared), kinds)
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link"))
    sums = (links.select("row", F.col("link.pairs").alias("pair"), "link.times").join(counts, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("times") * F.col("n")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (aligned.select("row", *columns).join(sums, "row", "left")
            .select(*columns, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum")))


def token_links(docs: DataFrame, first: str, second: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, a_groups, b_groups, links): both token rows, the group of each
    token, and the overlap links (a, b, bytes) by places in the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(first, second)
        for part in parts(batches):
            rows = []
            for one in part.column("text").to_pylist():
                a, b = align.whole(one)
                links = overlap(align.bytes_a.length[a], align.bytes_b.length[b])
                group_a, group_b = groups(links, len(b)) if len(a) else (a, b)
                from_a = np.repeat(np.arange(len(a)), np.diff(links[0]))
                rows.append((a.tolist(), b.tolist(), group_a.tolist(), group_b.tolist(),
                             [dict(zip(("a", "b", "bytes"), x)) for x in zip(from_a.tolist(), links[1].tolist(), links[2].tolist())]))
            kinds = [pa.list_(pa.int64())] * 4 + [pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("bytes", pa.int64())]))]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                             ["doc_id", "a_ids", "b_ids", "a_groups", "b_groups", "links"])
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    return texts.mapInArrow(run, "doc_id long, a_ids array<long>, b_ids array<long>, a_groups array<long>, "
                                 "b_groups array<long>, links array<struct<a long, b long, bytes long>>")


def op11_alignment(spark, sf_dir):
    import public_tokenizers
    first, second = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = align(table(spark, sf_dir, "documents", "doc_id", "text"), first, second)
    return weighed(aligned, pair_counts(aligned, entries(second)))


def entries(model: str) -> int:
    """Number of ids of a sentencepiece model."""
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size()
