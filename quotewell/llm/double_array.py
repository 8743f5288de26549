"""A double-array trie over rows of whole numbers, built and walked with numpy."""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

#: A code is spelled in digits of so many bits, so that a node has at most 256 children however many codes there are.
DIGIT_BITS = 8
ROOT = 1


def digits(codes: np.ndarray, count: int) -> np.ndarray:
    """(..., count) digits of the codes, highest first."""
    shifts = np.arange(count - 1, -1, -1, dtype=np.int64) * DIGIT_BITS
    return (codes[..., None] >> shifts) & ((1 << DIGIT_BITS) - 1)


@dataclass(frozen=True)
class DoubleArray:
    """Slot ``base[s] + d`` is the child of slot s by digit d if ``check`` names s there; ``value`` has the row of a leaf.

    ``words`` are the sorted distinct symbols of the rows, whose place is their
    code; ``ids`` are the ids of the rows, in the order of the rows.
    """

    width: int
    words: np.ndarray
    ids: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @property
    def digit_count(self) -> int:
        return max(1, -(-int(len(self.words)).bit_length() // DIGIT_BITS))

    @classmethod
    def build(cls, rows: np.ndarray, ids: np.ndarray) -> DoubleArray:
        """The trie of distinct ``rows`` (any order) of equal width, each with an id."""
        words, codes = np.unique(rows, return_inverse=True)
        codes = codes.reshape(rows.shape)
        order = np.lexsort(codes.T[::-1])
        codes = codes[order]
        count = max(1, -(-int(len(words)).bit_length() // DIGIT_BITS))
        spelled = digits(codes.astype(np.int64), count).reshape(len(rows), -1)
        # A node is a distinct beginning; rows are in order, so its number is a running count of changes.
        nodes = np.zeros(len(rows), np.int64)  # number of each row's node at the depth reached, from 0 at every depth
        total, parents, edge_digits, first = 1, [], [], [0]
        for depth in range(spelled.shape[1]):
            new = np.concatenate([[True], (spelled[1:, depth] != spelled[:-1, depth]) | (nodes[1:] != nodes[:-1])])
            parents.append(nodes[new] + first[-1])
            edge_digits.append(spelled[new, depth])
            first.append(total)
            nodes = np.cumsum(new) - 1
            total += int(new.sum())
        parent, digit = np.concatenate(parents), np.concatenate(edge_digits)  # of the nodes 1, 2, ... in order
        slot, base = cls.placed(total, parent, digit)
        size = int(max(slot.max(), (base + (1 << DIGIT_BITS)).max())) + 1
        check, bases, value = np.zeros(size, np.int32), np.zeros(size, np.int32), np.full(size, -1, np.int32)
        check[slot[1:]] = slot[parent]
        bases[slot] = base
        value[slot[first[-1] + nodes]] = np.arange(len(rows))
        return cls(rows.shape[1], words, ids[order], bases, check, value)

    @staticmethod
    def placed(total: int, parent: np.ndarray, digit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each node and base of each node's children: large families first, each at a place where all its digits are free.

        Families of one size class are placed together, round by round: every
        one proposes a base, those whose slots are free and claimed by no
        earlier one are set, the others propose again; the array grows while
        few succeed, so all find a place.
        """
        children = np.bincount(parent, minlength=total)
        begin = np.concatenate([[0], np.cumsum(children)])
        rng = np.random.default_rng(7)
        slot, base = np.zeros(total, np.int64), np.zeros(total, np.int64)
        slot[0] = ROOT
        width = 1 << DIGIT_BITS
        room = max(4 * width, 2 * len(parent))
        used = np.zeros(room + 2 * width, bool)
        used[: ROOT + 1] = True
        waiting = np.flatnonzero(children)
        waiting = waiting[np.argsort(-children[waiting], kind="stable")]
        classes = np.floor(np.log2(children[waiting])).astype(int)
        for size_class in np.unique(classes)[::-1]:
            todo = waiting[classes == size_class]
            while len(todo):
                counts = children[todo]
                edges = np.repeat(begin[todo] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
                who = np.repeat(np.arange(len(todo)), counts)
                proposed = rng.integers(ROOT + 1, room, len(todo))
                places = proposed[who] + digit[edges]
                claim = np.full(len(used), len(todo), np.int64)
                np.minimum.at(claim, places, who)
                lost = np.bincount(who, weights=used[places] | (claim[places] != who), minlength=len(todo)) > 0
                won = ~lost
                used[places[won[who]]] = True
                slot[edges[won[who]] + 1] = places[won[who]]  # edge e leads to node e + 1
                base[todo[won]] = proposed[won]
                todo = todo[lost]
                if len(todo) > 0.9 * len(won):  # the array is too full for families of this size
                    room += room // 8
                    used = np.concatenate([used, np.zeros(room + 2 * width - len(used), bool)])
        return slot, base

    def encoded(self, words: np.ndarray) -> np.ndarray:
        """Codes of ``words``; the number of codes, which no row has, where a word is in no row."""
        at = np.searchsorted(self.words, words)
        known = self.words[np.minimum(at, len(self.words) - 1)] == words
        return np.where(known, at, len(self.words))

    def counts(self, tokens: np.ndarray) -> np.ndarray:
        """How often each row (in the order of ``ids``) occurs in ``tokens``, codes of words in text order.

        The states of all positions advance together, digit by digit and word by
        word; positions whose state has died are left out of the next step.
        """
        width, n = self.width, self.digit_count
        spelled = digits(np.arange(len(self.words) + 1), n)
        at = np.flatnonzero(tokens[: max(len(tokens) - width + 1, 0)] < len(self.words))
        states = np.full(len(at), ROOT, np.int64)
        for k in range(width):
            codes = tokens[at + k]
            for j in range(n):
                children = self.base[states] + spelled[codes, j]
                alive = self.check[children] == states
                states, at, codes = children[alive], at[alive], codes[alive]
        return np.bincount(self.value[states], minlength=len(self.ids))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> DoubleArray:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**{name: arrays[name] if arrays[name].ndim else int(arrays[name]) for name in arrays.files})
