"""Cutting texts where byte-level tokenizers surely start anew."""

from __future__ import annotations

import re

import numpy as np

#: Splits into pre-tokens; the fixed pattern of the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a worker remembers, and texts that it takes at a time.
REMEMBERED = 500_000
AT_A_TIME = 256
# Python's blanks hold all that the tokenizers split at, so both sides are surely not blank.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BLANKS = re.compile(r"\s\s")


def cut(text: str) -> list[str]:
    """``text`` cut at single spaces between two non-blank characters; the spaces are left out.

    A pre-token begins at each of these spaces, so the pieces, with their space before them,
    have the tokens that they have in the whole text.
    """
    if _BLANKS.search(text) or text[:1].isspace() or text[-1:].isspace():
        return _CUT.split(text)
    return text.split(" ")


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as its length."""
    ends = np.cumsum(length)
    return np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
