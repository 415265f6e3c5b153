"""Double-array tries of number sequences, and the advance of many positions at once."""

from __future__ import annotations

import numpy as np

#: Free slots that are tried at a time for the children of a node.
TRIED = 4096


class Trie:
    """Sequences of codes 1..n_codes in a double array.

    The node of the one-code sequence ``c`` is state ``c``; the child of state ``s`` by code
    ``c`` is ``base[s] + c`` if ``check`` of that slot is ``s``. All of a sequence's beginnings
    are nodes. ``states`` are those of the sequences given to the trie.
    """

    def __init__(self, sequences: list[np.ndarray], n_codes: int):
        """``sequences``: one array for each length from 2 up, of (rows, length), rows distinct."""
        self.n_codes = n_codes
        size = 2 * (n_codes + 1) + sum(map(len, sequences)) + 16
        self.base = np.zeros(n_codes + 1, np.int64)
        self.check = np.full(size, -1, np.int64)
        self.check[:n_codes + 1] = 0
        self.states = []        # of the rows of each array
        self._free = n_codes + 1        # no free slot below
        depth = max((s.shape[1] for s in sequences), default=1)
        rows = np.concatenate([np.pad(s, ((0, 0), (0, depth - s.shape[1]))) for s in sequences] or
                              [np.zeros((0, depth), np.int64)]).astype(np.int64)
        state = rows[:, 0].copy() if len(rows) else np.zeros(0, np.int64)
        for d in range(1, depth):
            going = np.flatnonzero(rows[:, d] > 0)
            key = (state[going] << 32) | rows[going, d]
            distinct, at = np.unique(key, return_inverse=True)
            state[going] = self._place(distinct >> 32, distinct & 0xFFFFFFFF)[at]
        for s in sequences:
            self.states.append(state[:len(s)])
            state = state[len(s):]
        self.size = int(np.flatnonzero(self.check >= 0)[-1]) + 1
        self.check = self.check[:self.size].astype(np.int32)
        base = np.zeros(self.size, np.int32)
        base[:min(self.size, len(self.base))] = self.base[:self.size]
        self.base = base

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            self.check = np.concatenate([self.check, np.full(max(size, 2 * len(self.check)) - len(self.check), -1, np.int64)])

    def _place(self, parent: np.ndarray, code: np.ndarray) -> np.ndarray:
        """States of the children, which come in order of parent and code."""
        out = np.zeros(len(parent), np.int64)
        if not len(parent):
            return out
        first = np.flatnonzero(np.diff(parent, prepend=-1))
        count = np.diff(first, append=len(parent))
        if int(parent.max()) >= len(self.base):
            self.base = np.concatenate([self.base, np.zeros(int(parent.max()) + 1 - len(self.base), np.int64)])
        for i in first[np.argsort(-count, kind="stable")][:int((count > 1).sum())]:      # wide nodes first
            n = int(np.searchsorted(parent, parent[i], "right")) - int(i)
            shape = code[i:i + n] - code[i]
            at = self._fit(shape)
            self.base[parent[i]] = at - code[i]
            out[i:i + n] = at + shape
            self.check[at + shape] = parent[i]
        single = first[count == 1]
        if len(single):
            self._grow(self._free + len(self.check) + len(single))
            slots = self._free + np.flatnonzero(self.check[self._free:] < 0)[:len(single)]
            self.base[parent[single]] = slots - code[single]
            out[single] = slots
            self.check[slots] = parent[single]
            self._free = int(slots[-1]) + 1
        return out

    def _fit(self, shape: np.ndarray) -> int:
        """The least tried slot from which all of ``shape`` is free."""
        start = self._free
        while True:
            self._grow(start + TRIED + int(shape[-1]) + 1)
            at = start + np.flatnonzero(self.check[start:start + TRIED] < 0)
            if len(at) and start == self._free:
                self._free = int(at[0])
            for c in shape[1:]:
                at = at[self.check[at + c] < 0]
                if not len(at):
                    break
            if len(at):
                return int(at[0])
            start += TRIED

    def advance(self, codes: np.ndarray, depth: int):
        """For each length from 1 to ``depth``: (positions, states) of the sequences of that
        length that begin at these positions. Code 0 is in no sequence."""
        at = np.flatnonzero(codes > 0)
        state = codes[at].astype(np.int64)
        yield at, state
        for d in range(1, depth):
            inside = at + d < len(codes)
            at, state = at[inside], state[inside]
            code = codes[at + d]
            slot = self.base[state] + code
            here = (code > 0) & (slot > 0) & (slot < self.size)
            at, state, slot = at[here], state[here], slot[here]
            here = self.check[slot] == state
            at, state = at[here], slot[here].astype(np.int64)
            yield at, state
