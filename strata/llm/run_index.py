"""A run-length index of a set of strings: run-compressed BWT with sampled run ends.

Built over the strings put one after another, each closed by an end mark of its own.
Runs of equal letters in the Burrows-Wheeler transform are kept with the text positions
at their borders: where a run starts, and where the run before it ends.  These two
neighbours in suffix order differ in the letter before them, so their common prefix is a
match that cannot grow to the left; every other pair of neighbours is such a pair moved
to the right, one letter shorter for each step.  So the samples alone give the matching
statistics of the strings against one another, streamed in text order
(``matching_statistics``), and all long matches (``long_matches``), in space that grows
with the number of runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_WORD = 8


class RunIndex:
    """``starts``/``ends``: text positions of the strings; samples ``at``, ``before``, ``length`` by run."""

    def __init__(self, strings: Sequence[bytes]):
        size = np.array([len(s) for s in strings], dtype=np.int64)
        self.ends = np.cumsum(size + 1) - 1  # places of the end marks
        self.starts = self.ends - size
        self.text = np.frombuffer(b"\xff".join(strings) + b"\xff" * (len(strings) > 0), dtype=np.uint8)
        self.at = self.before = self.length = np.zeros(0, dtype=np.int64)
        self.runs = 0
        if len(self.text):
            self._build()

    def _build(self) -> None:
        text, n = self.text, len(self.text)
        owner = np.repeat(np.arange(len(self.ends)), self.ends - self.starts + 1)
        left = self.ends[owner] - np.arange(n)  # letters before the end mark
        word = np.zeros(n, dtype=np.uint64)
        for k in range(_WORD):  # eight letters as one number, empty after the end mark
            part = np.zeros(n, dtype=np.uint64)
            part[:max(0, n - k)] = text[k:]
            part[left < k] = 0
            word |= part << np.uint64(8 * (_WORD - 1 - k))
        order = self._suffixes(word, left, owner)
        # the letter before each suffix; a string's first suffix has one that no other has
        prior = np.empty(n, dtype=np.int64)
        prior[1:] = text[:-1]
        prior[self.starts] = 256 + np.arange(len(self.starts))
        bwt = prior[order]
        border = np.flatnonzero(bwt[1:] != bwt[:-1]) + 1
        self.runs = len(border) + 1
        self.at, self.before = order[border], order[border - 1]
        self.length = self._common(word, left, self.at, self.before)
        by_text = np.argsort(self.at)
        self.at, self.before, self.length = self.at[by_text], self.before[by_text], self.length[by_text]

    @staticmethod
    def _suffixes(word: np.ndarray, left: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Suffix order by doubling; only groups that are still equal are sorted again."""
        n = len(word)
        ending = np.where(left < _WORD, owner + 1, 0)  # end marks differ, so such suffixes do
        order = np.lexsort((ending, word))
        new = np.ones(n, dtype=bool)
        new[1:] = (word[order[1:]] != word[order[:-1]]) | (ending[order[1:]] != ending[order[:-1]])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        reach = _WORD
        while True:
            last = np.ones(n, dtype=bool)
            last[:-1] = new[1:]
            place = np.flatnonzero(~(new & last))  # places in groups of more than one
            if not len(place):
                return order
            who = order[place]
            head = rank[who]
            key = (head.astype(np.uint64) << np.uint64(32)) | rank[who + reach].astype(np.uint64)
            sort = np.argsort(key)
            who, key = who[sort], key[sort]
            order[place] = who  # groups keep their places, so sorting them all at once is safe
            fresh = np.ones(len(place), dtype=bool)
            fresh[1:] = key[1:] != key[:-1]
            new[place] = fresh
            rank[who] = place[np.maximum.accumulate(np.where(fresh, np.arange(len(place)), 0))]
            reach *= 2

    @staticmethod
    def _common(word: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, end marks excluded."""
        out = np.minimum(left[a], left[b])
        live, done = np.arange(len(a)), 0
        while len(live):
            live = live[out[live] > done]
            x = word[a[live] + done] ^ word[b[live] + done]
            miss = x != 0
            if miss.any():
                same = np.zeros(miss.sum(), dtype=np.int64)
                y, open_ = x[miss], np.ones(miss.sum(), dtype=bool)
                for k in range(_WORD):
                    open_ &= (y >> np.uint64(8 * (_WORD - 1 - k))) & np.uint64(255) == 0
                    same += open_
                out[live[miss]] = np.minimum(out[live[miss]], done + same)
            live = live[~miss]
            done += _WORD
        return out

    def matching_statistics(self) -> Iterator[tuple[int, int, int]]:
        """(position, length, other position) in text order: each suffix's longest match with the one before it in order."""
        k = -1
        for p in range(len(self.text)):
            while k + 1 < len(self.at) and self.at[k + 1] <= p:
                k += 1
            if k >= 0:
                step = p - self.at[k]
                yield p, max(0, int(self.length[k] - step)), int(self.before[k] + step)

    def long_matches(self, least: int) -> np.ndarray:
        """For every byte of ``text``: whether a string of ``least`` bytes around it starts elsewhere too."""
        use = self.length >= least
        size = self.length[use]
        edge = np.zeros(len(self.text) + 1, dtype=np.int64)
        for side in (self.at[use], self.before[use]):
            np.add.at(edge, side, 1)
            np.add.at(edge, side + size, -1)
        return np.cumsum(edge)[:-1] > 0
