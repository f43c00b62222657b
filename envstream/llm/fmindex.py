"""A compressed FM-index over words, with matching statistics of bounded length.

The text is a sequence of numbered words; passages are set apart by 0. Suffixes
are sorted by their first ``ORDER`` words, which is all that patterns of fewer
words need. The Burrows-Wheeler transform is kept in a wavelet matrix: one
packed bit vector per bit of the word numbers, with counts every 64 bits.

``match`` reads passages from their ends. A backward step puts a word in front
of the match; before the next step the match is cut back by its last word (the
parent interval), so each window of ``window`` words costs one step.
"""

from __future__ import annotations

import numpy as np

ORDER = 32


def _ranked(keys):
    """Ranks of keys from 0, equal keys alike."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.empty(len(keys), bool)
    new[:1] = False
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks, order


def _ahead(ranks, by):
    """Ranks of the suffixes ``by`` words on; 0 behind the end."""
    out = np.zeros_like(ranks)
    out[:max(0, len(ranks) - by)] = ranks[by:] + 1
    return out


class WaveletMatrix:
    def __init__(self, values, n_values):
        self._levels, n = [], len(values)
        self.n_bits = max(1, int(n_values - 1).bit_length())
        for bit in range(self.n_bits - 1, -1, -1):
            ones = (values >> bit) & 1
            padded = np.zeros((n // 64 + 1) * 64, np.uint8)
            padded[:n] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.zeros(len(words) + 1, np.int32)
            np.cumsum(np.bitwise_count(words), out=counts[1:])
            zeros = n - int(ones.sum())
            self._levels.append((words, counts, zeros, bit))
            ones = ones.astype(bool)
            values = np.concatenate([values[~ones], values[ones]])
        self.n_bytes = sum(w.nbytes + c.nbytes for w, c, _, _ in self._levels)

    def rank_place(self, value, at):
        """Where the first ``at`` places' copies of ``value`` end on the last level."""
        for words, counts, zeros, bit in self._levels:
            low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            word = at >> 6
            ones = counts[word] + np.bitwise_count(words[word] & low)
            at = np.where((value >> bit) & 1, zeros + ones, at - ones)
        return at


class FmIndex:
    def __init__(self, text, n_words, window):
        """``text``: word numbers from 1, 0 between passages and at the end."""
        if not 4 < window < ORDER:
            raise ValueError(f"window must be from 5 to {ORDER - 1}")
        self.text, self.window = text, window
        ranks, order = _ranked(text)
        by_size = {1: ranks}
        size = 1
        while size < ORDER:
            ranks, order = _ranked(ranks * (len(text) + 1) + _ahead(ranks, size))
            size *= 2
            by_size[size] = ranks
        self.suffixes = order
        self._bwt = WaveletMatrix(text[order - 1], n_words + 1)
        # Word c's suffixes begin where the copies of c begin on the last level.
        everyone = np.arange(n_words + 1)
        self._first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_words + 1))])
        self._base = self._bwt.rank_place(everyone, np.zeros(n_words + 1, np.int64))
        self.group, _, _ = self._groups(by_size, window)
        _, self._low, self._high = self._groups(by_size, window - 1)

    def _groups(self, by_size, length):
        """Suffixes with the same first ``length`` words, in their order: the
        group of each, and its begin and end."""
        n = len(self.text)
        new = np.zeros(n, bool)
        new[0] = True
        at, rest = 0, length
        for size in sorted(by_size, reverse=True):
            if size <= rest:
                ranks = (_ahead(by_size[size], at) if at else by_size[size])[self.suffixes]
                new[1:] |= ranks[1:] != ranks[:-1]
                at, rest = at + size, rest - size
        group = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        return group, starts[group], ends[group]

    def step(self, words, low, high):
        """The matches with ``words`` put in front."""
        base, first = self._base[words], self._first[words]
        return (first + self._bwt.rank_place(words, low) - base,
                first + self._bwt.rank_place(words, high) - base)

    def match(self, starts, lengths, text=None):
        """For passages of ``text`` (default: the indexed one): (passage, window, low,
        high) of every window that occurs; low and high bound its suffixes."""
        text = self.text if text is None else text
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.text))
        size = np.zeros(len(starts), np.int64)
        found = []
        for k in range(int(lengths.max(initial=0))):
            active = int(np.searchsorted(-lengths, -k, side="left"))
            at = lengths[:active] - 1 - k
            low, high, size = low[:active], high[:active], size[:active]
            words = text[starts[:active] + at]
            full = size == self.window
            if full.any():
                low = np.where(full, self._low[np.minimum(low, len(self._low) - 1)], low)
                high = np.where(full, self._high[np.maximum(high - 1, 0)], high)
            low, high = self.step(words, low, high)
            size = np.minimum(size + 1, self.window)
            # Nothing matches: begin anew in front of this word.
            none = low >= high
            if none.any():
                low, high = np.where(none, 0, low), np.where(none, len(self.text), high)
                size = np.where(none, 0, size)
            whole = np.flatnonzero(size == self.window)
            found.append((order[whole], at[whole], low[whole], high[whole]))
        if not found:
            return tuple(np.empty(0, np.int64) for _ in range(4))
        return tuple(np.concatenate(c) for c in zip(*found))
