"""Suffixes of one bucket in order, a block at a time, long ties told apart by ranks of a difference cover."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BLOCK = 1 << 16
ORDER = 5


@lru_cache
def difference_cover(order: int) -> tuple[int, tuple[int, ...]]:
    """A perfect difference set: ``(q*q + q + 1, residues)`` for a prime ``q``.

    Every distance modulo the period is the difference of two of the ``q + 1`` residues. They are the
    exponents of a primitive element of the field of q^3 elements that fall in a plane (Singer).
    """
    q, period = order, order * order + order + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                def times(v):
                    """Multiply v0 + v1 x + v2 x^2 by x, where x^3 = a x^2 + b x + c."""
                    return v[2] * c % q, (v[0] + v[2] * b) % q, (v[1] + v[2] * a) % q
                v, residues = (1, 0, 0), []
                for e in range(period):
                    if v[2] == 0:
                        residues.append(e)
                    v = times(v)
                differences = {(x - y) % period for x in residues for y in residues}
                if len(residues) == q + 1 and len(differences) == period:
                    return period, tuple(residues)
    raise ValueError(f"{order} is not a prime")


@lru_cache
def _meetings(order: int) -> np.ndarray:
    """For each pair of residues, one row behind the other, the least distance at which both meet the cover."""
    period, residues = difference_cover(order)
    inside = np.isin(np.arange(2 * period) % period, residues)
    ahead = np.stack([inside[x:x + period] for x in range(period)])
    return np.argmax(ahead[:, None, :] & ahead[None, :, :], axis=2).ravel()


class Words:
    """The eight bytes at each place of a text, as numbers in the order of the bytes; zeros follow the text."""

    def __init__(self, raw: bytes, beyond: int):
        self.size = len(raw)
        padded = raw + bytes(beyond + 8)
        self._at = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))

    def __call__(self, places: np.ndarray) -> np.ndarray:
        return self._at[places].astype(np.uint64)


class Order:
    """Items sorted as far as they are compared. ``head`` is the place of the first of an item's tie.

    ``open`` holds the places of items in ties that are still to be compared, whole ties at a time.
    """

    def __init__(self, items: np.ndarray, head: np.ndarray):
        self.items, self.head = items, head
        self.open = np.arange(len(items))[self._tied(head)]

    @staticmethod
    def _tied(head: np.ndarray) -> np.ndarray:
        tied = np.zeros(len(head), bool)
        same = head[1:] == head[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        return tied

    def compare(self, keys: np.ndarray) -> np.ndarray:
        """Sort the open ties by the keys of their items; returns the keys of what is still tied, in its order.

        Only ties that the keys divide are sorted.
        """
        head = self.head[self.open]
        divided = np.zeros(len(self.items), bool)
        divided[head[1:][(head[1:] == head[:-1]) & (keys[1:] != keys[:-1])]] = True
        some = divided[head]
        if some.any():
            places, own, key = self.open[some], head[some], keys[some]
            order = np.argsort(key) if own[0] == own[-1] else np.lexsort((key, own))
            self.items[places] = self.items[places][order]
            key = key[order]
            fresh = np.ones(len(key), bool)
            fresh[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
            self.head[places] = np.maximum.accumulate(np.where(fresh, places, 0))
            keys = keys.copy()
            keys[some] = key
            tied = self._tied(self.head[self.open])
            self.open, keys = self.open[tied], keys[tied]
        return keys


class CoverRanks:
    """Ranks, to ``depth`` bytes at least, of the suffixes at the places of a difference cover.

    Any two places have a distance below the period at which both meet the cover, so their order behind
    that distance is read off two ranks.
    """

    def __init__(self, words: Words, depth: int, order: int = ORDER):
        self.period, residues = difference_cover(order)
        self.each = len(residues)
        self.slot = np.full(self.period, -1)
        self.slot[list(residues)] = np.arange(self.each)
        self.meet = _meetings(order)
        rows = words.size // self.period + 2
        places = (np.arange(rows)[:, None] * self.period + np.array(residues)).ravel()
        sample = Order(np.arange(len(places)), np.zeros(len(places), np.int64))
        for offset in offsets(self.period):
            sample.compare(words(places[sample.items[sample.open]] + offset))
        reach, step = self.period, self.each
        while True:
            self.rank = np.zeros(len(places) + step, np.int64)  # behind the end comes what is least
            self.rank[sample.items] = sample.head + 1
            if reach >= depth or not len(sample.open):
                return
            following = np.minimum(sample.items[sample.open] + step, len(places))
            sample.compare(self.rank[following])
            reach, step = 2 * reach, 2 * step

    def _rank(self, places: np.ndarray) -> np.ndarray:
        row, residue = np.divmod(places, self.period)
        return self.rank[row * self.each + self.slot[residue]]

    def sign(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at ``a`` is less than, tied with or greater than that at ``b``.

        Both agree in the first ``period`` bytes already.
        """
        ahead = self.meet[a % self.period * self.period + b % self.period]
        return np.sign(self._rank(a + ahead) - self._rank(b + ahead))


def offsets(length: int) -> list[int]:
    """Where words start that cover ``length`` bytes (eight at least)."""
    return [min(o, length - 8) for o in range(0, length, 8)]


def _sort_block(words: Words, block: Order, ranks: CoverRanks) -> None:
    """Sort by the first bytes, one period of them, then divide what is tied by the cover, around one of each tie."""
    for offset in offsets(ranks.period)[1:]:
        if len(block.open):
            block.compare(words(block.items[block.open] + offset))
    while len(block.open):
        places = block.items[block.open]
        first = np.flatnonzero(np.diff(block.head[block.open], prepend=-1))
        sizes = np.diff(first, append=len(places))
        middle = np.repeat(places[first + sizes // 2], sizes)
        signs = block.compare(ranks.sign(places, middle))
        block.open = block.open[signs != 0]  # tied with the middle one: equal to the depth of the ranks


def equal_neighbours(raw: bytes, starts: np.ndarray, length: int, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``(order, same)``: the strings of ``length`` bytes at ``starts`` in suffix order, and which equal the one before.

    Equal strings stand side by side, so one that equals neither neighbour has no equal. Suffixes are dealt to
    blocks of some ``block`` suffixes by their first eight bytes and one block is sorted at a time; ranks of the
    cover are made before. Strings are compared as bytes, whatever comes behind them; no starts give nothing.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    beyond = 4 * difference_cover(ORDER)[0] + length
    words = Words(raw, beyond)
    ranks = CoverRanks(words, length)
    first = words(starts)
    order = np.argsort(first)
    edge = np.flatnonzero(np.diff(first[order], prepend=first[order[0]] ^ np.uint64(1)))
    items, same = starts[order].astype(np.int64), np.zeros(len(starts), bool)
    cuts = np.unique(edge[np.searchsorted(edge, np.arange(0, len(starts), block), side="right") - 1]).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(starts)]):
        own = edge[np.searchsorted(edge, a):np.searchsorted(edge, b)] - a
        suffixes = Order(items[a:b], np.repeat(own, np.diff(own, append=b - a)))
        _sort_block(words, suffixes, ranks)
        same[a + 1:b] = suffixes.head[1:] == suffixes.head[:-1]
    open_ = np.flatnonzero(~same[1:]) + 1  # told apart by the order, maybe behind the string only
    for offset in offsets(length):
        open_ = open_[words(items[open_ - 1] + offset) == words(items[open_] + offset)]
    same[open_] = True
    return items, same
