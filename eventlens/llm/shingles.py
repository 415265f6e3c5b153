"""Word shingles of whole texts as 64-bit hashes, in arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE = 5
#: Odd multipliers by place in the shingle, and that of the number of words in a short one.
PLACES = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
LENGTH = np.uint64(0x1D8E4E27C47D124F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters their bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(owner and number of every word in order, the distinct words by number)."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    owner = np.asarray(pc.list_parent_indices(lists))
    found = pc.list_flatten(lists)
    real = np.asarray(pc.not_equal(found, ""))
    if not real.all():
        found, owner = found.filter(pa.array(real)), owner[real]
    coded = found.dictionary_encode()
    return owner.astype(np.int64), np.asarray(coded.indices), coded.dictionary


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(owner and number of every word in order, the distinct words by number, their hashes)."""
    owner, code, distinct = split_words(texts)
    table = np.fromiter((xxhash.xxh3_64_intdigest(w.encode()) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return owner, code, distinct, table


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of every shingle, repeats included: runs of ``size`` words, or all the
    words of a text with fewer. A text without words has none."""
    owner, code, _, hashes = words_of(texts)
    return runs_of(owner, hashes[code], len(texts), size)


def runs_of(owner: np.ndarray, word: np.ndarray, texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of so many texts by the owner and hash of every word."""
    n = len(word)
    k = np.bincount(owner, minlength=texts)
    starts = np.cumsum(k) - k
    width = np.minimum(size, k)[owner]      # words of the shingle that begins at a word
    place = np.arange(n) - starts[owner]
    begins = np.flatnonzero(place + width <= k[owner])
    owner, width = owner[begins], width[begins]
    total = width.astype(np.uint64) * LENGTH
    for j in range(size):
        inside = width > j
        at = begins + j
        if inside.all():
            total += word[at] * PLACES[j]
        else:
            total[inside] += word[at[inside]] * PLACES[j]
    return owner, mix(total)


def bags(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, value, count) of the distinct values of each owner, in order of both."""
    order = np.argsort(value)
    small = len(owner) and owner.max() < 1 << 16     # sorted by digits
    order = order[np.argsort(owner[order].astype(np.uint16) if small else owner[order], kind="stable")]
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(at, append=len(owner))


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (values, counts), values in order; 0 if both are empty."""
    total = int(a[1].sum()) + int(b[1].sum())
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][i], b[1][j]).sum())
    return common / (total - common) if total else 0.0
