"""BagMinHash signatures of multisets.

The signature of a weighted set holds, in each of its places, the first point of a Poisson
process over (time, weight) restricted to the weights that the set's elements have; two sets
agree in a place with probability equal to their weighted Jaccard similarity. Weights are
discretised to whole numbers and the weight axis is split into (0, 1], (1, 2], (2, 4], (4, 8]
and so on. Each element has one process per interval that its weight reaches, of a rate equal to the
interval's length; a point falls on one of the interval's levels at random and counts if the
weight reaches that level. An element of weight w thus costs log w processes, not w, and a
process is followed only until it is later than the latest place of the signature.
"""

from __future__ import annotations

import numpy as np

from eventlens.llm.shingles import mix

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
LEVEL = np.uint64(0xD6E8FEB86659FD93)
BAND = np.uint64(0xA0761D6478BD642F)


def processes(owner: np.ndarray, value: np.ndarray, weight: np.ndarray):
    """(owner, seed, low, high, weight) of each element's processes; levels low + 1 .. high."""
    n = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    at = np.repeat(np.arange(len(owner)), n)
    step = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    low = np.where(step == 0, 0, 1 << np.maximum(step - 1, 0))
    seed = mix(value[at] + step.astype(np.uint64) * LEVEL)
    return owner[at], seed, low, np.where(step == 0, 1, 1 << step), weight[at]


def signatures(n: int, owner: np.ndarray, value: np.ndarray, weight: np.ndarray, places: int) -> np.ndarray:
    """n x places points in time; infinite for owners without elements."""
    first = np.full(n * places, np.inf)
    own, seed, low, high, weight = processes(owner, value, weight)
    time, step, points = np.zeros(len(own)), np.uint64(0), 1
    while len(own):
        rates = (high - low).astype(float)
        draws = np.arange(1, points + 1, dtype=np.uint64) + step
        bits = mix(seed[:, None] + draws * GOLDEN)
        # 53 bits for the time to the next point; other bits of a second number for its place and level
        gaps = -np.log(((bits >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53)
        at = time[:, None] + np.cumsum(gaps, axis=1) / rates[:, None]
        more = mix(bits ^ LEVEL)
        place = ((more >> np.uint64(32)) * np.uint64(places)) >> np.uint64(32)
        latest = first.reshape(n, places).max(axis=1)
        counts = at <= latest[own][:, None]
        wide = np.flatnonzero(high - low > 1)
        if len(wide):
            level = low[wide, None] + 1 + ((more[wide] & np.uint64(0xFFFFFFFF)).astype(np.int64) % (high - low)[wide, None])
            counts[wide] &= level <= weight[wide, None]
        flat = (own[:, None] * places + place.astype(np.int64))[counts]
        np.minimum.at(first, flat, at[counts])
        latest = first.reshape(n, places).max(axis=1)
        time = at[:, -1]
        live = time <= latest[own]
        own, seed, low, high, weight, time = (x[live] for x in (own, seed, low, high, weight, time))
        step += np.uint64(points)
        points = min(2 * points, 64)
    return first.reshape(n, places)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each run of ``rows`` places; equal keys mean equal runs of one band."""
    n, places = signature.shape
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(n, places // rows, rows)
    key = np.tile((np.arange(places // rows, dtype=np.uint64) + np.uint64(1)) * BAND, (n, 1))
    for j in range(rows):
        key = mix(key + bits[:, :, j])
    return key.view(np.int64)
