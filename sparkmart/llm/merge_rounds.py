"""Byte-pair merges of many words at once, in numpy.

The symbols of all words lie in one flat array.  A round finds the smallest pair rank of
each word, merges its leftmost pair of that rank in all words at the same time, and
compacts the array; rounds go on until no word holds a pair of the table.  A word sees
the merges in the order of the one-at-a-time algorithm: smallest rank first, leftmost of
equals, so the result is the same.
"""

from __future__ import annotations

import heapq

import numpy as np

#: Rank of a pair that is not in the table.
NEVER = np.int32(2**31 - 1)
#: Words of more symbols are merged one at a time: a round costs what the word is long.
LONG_WORD = 256
#: Characters per word of its limit that a table of words holds at most.
WORD_CHARS = 16
_SHIFT = np.int64(22)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """(left, right) -> (rank, merged symbol), looked up for whole arrays by open addressing."""

    def __init__(self, left, right, rank, merged):
        keys = (np.asarray(left, np.int64) << _SHIFT) | np.asarray(right, np.int64)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.rank = np.full(size, NEVER, np.int32)
        self.merged = np.zeros(size, np.int32)
        rank, merged = np.asarray(rank, np.int32), np.asarray(merged, np.int32)
        left_over, slot = np.arange(len(keys)), self._slot(keys)
        while len(left_over):
            free = np.flatnonzero(self.keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            at, who = slot[put], left_over[put]
            self.keys[at], self.rank[at], self.merged[at] = keys[who], rank[who], merged[who]
            stay = np.ones(len(left_over), bool)
            stay[put] = False
            left_over, slot = left_over[stay], (slot[stay] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged symbols; :data:`NEVER` where the pair is not in the table."""
        keys = (left.astype(np.int64) << _SHIFT) | right
        slot = self._slot(keys)
        seen = self.keys[slot]
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[slot[open_]]
            open_ = open_[(seen != keys[open_]) & (seen != -1)]
        # an unused slot holds NEVER, and that is where a missing pair ends
        return self.rank[slot], self.merged[slot]


def merge_words(symbols: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """The final symbols of all words, in order, and how many each word has."""
    lengths = np.asarray(lengths, np.int64)
    word = np.repeat(np.arange(len(lengths)), lengths)
    long_ = lengths > LONG_WORD
    done_word, done_symbol = [], []
    if long_.any():
        ends = np.cumsum(lengths)
        for w in np.flatnonzero(long_):
            own = _merge_one(symbols[ends[w] - lengths[w] : ends[w]], pairs)
            done_word.append(np.full(len(own), w))
            done_symbol.append(own)
        keep = ~np.repeat(long_, lengths)
        symbols, word = symbols[keep], word[keep]
    sym = symbols.astype(np.int32)
    rank = np.full(len(sym), NEVER, np.int32)
    new = np.zeros(len(sym), np.int32)
    if len(sym) > 1:
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside], new[inside] = pairs.find(sym[inside], sym[inside + 1])
    while len(sym):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        sizes = np.diff(np.r_[starts, len(sym)])
        best = np.minimum.reduceat(rank, starts)
        alive = best < NEVER
        if not alive.all():
            mask = np.repeat(alive, sizes)
            done_word.append(word[~mask])
            done_symbol.append(sym[~mask])
            sym, word, rank, new = sym[mask], word[mask], rank[mask], new[mask]
            sizes, best = sizes[alive], best[alive]
            if not len(sym):
                break
        hit = np.flatnonzero(rank == np.repeat(best, sizes))
        first = hit[np.r_[True, word[hit[1:]] != word[hit[:-1]]]]
        sym[first] = new[first]
        keep = np.ones(len(sym), bool)
        keep[first + 1] = False
        sym, word, rank, new = sym[keep], word[keep], rank[keep], new[keep]
        at = first - np.arange(len(first))
        rank[at] = NEVER
        right = at[(at + 1 < len(sym))]
        right = right[word[right] == word[right + 1]]
        left = at[at > 0] - 1
        left = left[word[left] == word[left + 1]]
        touched = np.r_[right, left]
        rank[touched], new[touched] = pairs.find(sym[touched], sym[touched + 1])
    if not done_word:
        return symbols.astype(np.int32), lengths
    word, sym = np.concatenate(done_word), np.concatenate(done_symbol)
    order = np.argsort(word, kind="stable")
    return sym[order].astype(np.int32), np.bincount(word, minlength=len(lengths))


def _merge_one(symbols: np.ndarray, pairs: PairTable) -> np.ndarray:
    """One long word by an agenda of pairs: time grows with its length, not with the square."""
    sym = symbols.astype(np.int64).tolist()
    after, before = [*range(1, len(sym)), -1], [-1, *range(len(sym) - 1)]
    rank, new = pairs.find(symbols[:-1], symbols[1:])
    agenda = [(int(r), i, sym[i], sym[i + 1], int(n)) for i, (r, n) in enumerate(zip(rank, new, strict=True)) if r < NEVER]
    heapq.heapify(agenda)
    while agenda:
        _, i, left, right, merged = heapq.heappop(agenda)
        j = after[i]
        if sym[i] != left or j < 0 or sym[j] != right:
            continue
        sym[i], sym[j] = merged, -1
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for a in (before[i], i):
            if a >= 0 and after[a] >= 0:
                r, n = pairs.find(np.array([sym[a]]), np.array([sym[after[a]]]))
                if r[0] < NEVER:
                    heapq.heappush(agenda, (int(r[0]), a, sym[a], sym[after[a]], int(n[0])))
    return np.array([s for s in sym if s >= 0], np.int64)


class WordTable(dict):
    """word -> code, and per code its ids; distinct words are encoded once, slice by slice.

    ``encode(words) -> (flat ids, ids per word)``.  The table is emptied when it holds
    ``limit`` words, or ``WORD_CHARS`` times as many characters, so a worker's memory stays
    bounded, also while it idles beside later stages; results do not depend on it.
    """

    def __init__(self, encode, limit: int = 250_000):
        super().__init__()
        self.encode, self.limit = encode, limit
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.fresh: list[str] = []
        self.chars = 0
        self.ids, self.counts, self.starts = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        self.fresh.append(word)
        return code

    def codes(self, lists: list[list[str]]) -> list[np.ndarray]:
        """The codes of each list's words; every word of them is encoded afterwards."""
        if len(self) > self.limit or self.chars > WORD_CHARS * self.limit:
            self._empty()
        get = self.__getitem__
        found = [np.fromiter(map(get, words), np.int32, len(words)) for words in lists]
        if self.fresh:
            ids, counts = self.encode(self.fresh)
            self.chars += sum(map(len, self.fresh))
            self.fresh = []
            self.ids, self.counts = np.concatenate([self.ids, ids]), np.concatenate([self.counts, counts])
            self.starts = np.cumsum(self.counts) - self.counts
        return found

    def ids_of(self, codes: np.ndarray) -> np.ndarray:
        return gather(self.ids, self.starts, self.counts, codes)


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``flat[starts[r] : starts[r] + counts[r]]`` of all ``rows``, one behind the other."""
    n = counts[rows]
    ends = np.cumsum(n)
    return flat[np.repeat(starts[rows] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]
