"""Matching blocks of two texts as the standard library's ``SequenceMatcher`` finds
them, in a time that grows almost linearly with long texts.

The library looks for the longest match of two ranges (first in ``a``, then in ``b``
among equals), takes it with the equal characters around it, and goes on to its left
and to its right.  Popular characters of a long ``b`` start no match.  Here the length
of the longest match is found by halving, with digests of all runs of one length at
once.  All matches of that length that the library would take one after the other to
the right come out of one pass, so what is left over has shorter matches only.

Texts that differ by characters which the other lacks (symbols for words, spaces on one
side) need no search.
"""

from __future__ import annotations

import difflib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np

#: Ranges of ``a`` up to this length, and of ``a`` times ``b`` up to this size, are
#: searched by ``str.find``.
SHORT, SMALL = 48, 1_000_000
#: The popular-character rule applies from this length of the second text.
POPULAR_FROM = 200
#: Characters that are replaced one by one.
FEW = 16
#: Candidates that an existence test looks at one by one.
TRIES = 8

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def _two_unused(text: set[str]) -> tuple[str, str]:
    """Two characters that are not in the set."""
    found = []
    code = 0x10FFFF
    while len(found) < 2:
        if chr(code) not in text:
            found.append(chr(code))
        code -= 1
    return found[0], found[1]


def _runs_of(text: str, known: set[str]) -> tuple[list[int], list[int]]:
    """Starts and ends of the longest runs of a text that hold known characters only."""
    gone = "".join(set(text) - known)
    if not gone:
        return [0], [len(text)]
    if len(gone) > FEW:
        text = text.translate(dict.fromkeys(map(ord, gone), gone[0]))
    else:  # far faster than translate
        for c in gone[1:]:
            text = text.replace(c, gone[0])
    starts, ends, at = [], [], 0
    for run in text.split(gone[0]):
        if run:
            starts.append(at)
            ends.append(at + len(run))
        at += len(run) + 1
    return starts, ends


def _aligned(a: str, b: str, popular: set[str]) -> list[tuple[int, int, int]] | None:
    """Blocks of two texts that are the same pieces between runs of characters which the
    other text lacks; None for other texts.

    No match leaves a piece.  The longest runs without popular characters stand in the
    same order in both, so the first one of ``a`` meets itself, and grows to its whole
    piece; the same holds on its left and right.  A piece of popular characters starts no
    match, but for one at the start of both texts.
    """
    if not a or not b:
        return None
    starts, ends = _runs_of(a, set(b))
    others, stops = _runs_of(b, set(a))
    if len(starts) != len(others):
        return _nested(a, b, starts, ends, others, stops) if len(b) < POPULAR_FROM else None
    found = []
    for i, end, j, stop in zip(starts, ends, others, stops):
        piece = a[i:end]
        if piece != b[j:stop]:
            return None
        if not popular or i == j == 0 or not popular.issuperset(piece):
            found.append((i, j, end - i))
    return found


def _nested(a: str, b: str, starts: list[int], ends: list[int], others: list[int],
            stops: list[int]) -> list[tuple[int, int, int]] | None:
    """Blocks of two texts without popular characters that are the same but for characters
    which the other lacks, where the runs of one lie within runs of the other (spaces on one
    side, say); None for other texts.

    No match exceeds a run of the finer text, and each of them stands in the other text.  So
    the longest one is the longest match, wherever it comes first there; that must be its own
    place, or it is left to a search.
    """
    if "".join([a[i:k] for i, k in zip(starts, ends)]) != "".join([b[j:k] for j, k in zip(others, stops)]):
        return None
    of_a = len(starts) > len(others)
    if of_a:
        text, other, runs, outer = a, b, zip(starts, ends), zip(others, stops)
    else:
        text, other, runs, outer = b, a, zip(others, stops), zip(starts, ends)
    found = []  # place in the finer text, place in the other, length
    at = hi = 0
    for i, end in runs:
        if at == hi:
            at, hi = next(outer)
        if at + end - i > hi:
            return None
        found.append((i, at, end - i))
        at += end - i
    placed: list[int] = []
    order = sorted(range(len(found)), key=lambda r: -found[r][2])
    for n, r in enumerate(order):
        i, place, size = found[r]
        k = bisect_left(placed, r)
        low = sum(found[placed[k - 1]][1:]) if k else 0
        behind = placed[k] if k < len(placed) else len(found)
        high = found[behind][1] if k < len(placed) else len(other)
        if other.find(text[i:i + size], low, high) != place:
            return None
        if not of_a:  # the first place in ``a`` counts, of any run of this length
            for q in order[n + 1:]:
                j, _, others_size = found[q]
                if others_size < size:
                    break
                if q < behind and other.find(text[j:j + size], low, place + size - 1) >= 0:
                    return None
        placed.insert(k, r)
    return found if of_a else [(j, i, size) for i, j, size in found]


class _Digests:
    """Digests of the runs of any one length of a text."""

    def __init__(self, text: str):
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        power, self.back = (np.full(len(codes) + 1, b, np.uint64) for b in (_BASE, _INVERSE))
        power[0] = self.back[0] = 1
        np.multiply.accumulate(power, out=power)
        np.multiply.accumulate(self.back, out=self.back)
        codes = (codes + np.uint64(1)) * _SPREAD
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes ^ (codes >> np.uint64(29))) * power[:-1], out=self.sums[1:])

    def runs(self, start: int, stop: int, size: int) -> np.ndarray:
        """Digests of the runs of ``size`` that lie in the range, by their starts."""
        h = (self.sums[start + size:stop + 1] - self.sums[start:stop + 1 - size]) * self.back[start:stop + 1 - size]
        h = (h ^ (h >> np.uint64(32))) * _SPREAD
        return h ^ (h >> np.uint64(29))


def _maybe_in(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Places of ``x`` whose values may be among ``others`` (never missing one)."""
    shift = np.uint64(64 - max(10, (8 * len(others)).bit_length()))
    seen = np.zeros(1 << (64 - int(shift)), bool)
    seen[(others >> shift).astype(np.int64)] = True
    return np.flatnonzero(seen[(x >> shift).astype(np.int64)])


class Matcher(difflib.SequenceMatcher):
    """``SequenceMatcher`` of two texts; only the search for blocks is another one."""

    def set_seq2(self, b):
        """Popular characters as the library has them, without its places of all characters."""
        if b is self.b:
            return
        self.b = b
        self.matching_blocks = self.opcodes = self.fullbcount = None
        self.bpopular = set()
        if self.autojunk and len(b) >= POPULAR_FROM:
            self.bpopular = {c for c, n in Counter(b).items() if n > len(b) // 100 + 1}

    def get_matching_blocks(self):
        if self.matching_blocks is not None:
            return self.matching_blocks
        a, b = self.a, self.b
        found = _aligned(a, b, self.bpopular)
        if found is None:
            found = self._search(a, b)
        self.matching_blocks = [difflib.Match(*m) for m in _joined(sorted(found))]
        self.matching_blocks.append(difflib.Match(len(a), len(b), 0))
        return self.matching_blocks

    def _search(self, a: str, b: str) -> list[tuple[int, int, int]]:
        """Blocks of any two texts."""
        x, y = a, b  # without popular characters, which match nothing here
        if self.bpopular:
            gone_a, gone_b = _two_unused(set(a) | set(b))
            x = a.translate({ord(c): gone_a for c in self.bpopular})
            y = b.translate({ord(c): gone_b for c in self.bpopular})
        self._x, self._y, self._digests = x, y, None
        self._runs = _runs_of(x, set(y))
        found = []
        # ranges of a and of b, and a length that no match in them exceeds
        todo = [(0, len(a), 0, len(b), min(len(a), len(b)))]
        while todo:
            alo, ahi, blo, bhi, most = todo.pop()
            if alo >= ahi or blo >= bhi:
                continue
            small = ahi - alo <= SHORT or (ahi - alo) * (bhi - blo) <= SMALL
            search = self._by_find if small else self._by_digests
            size, ties = search(alo, ahi, blo, bhi, min(most, ahi - alo, bhi - blo))
            while match := ties.first(alo, blo):
                (i, j), k = match, size
                while i > alo and j > blo and a[i - 1] == b[j - 1]:
                    i, j, k = i - 1, j - 1, k + 1
                while i + k < ahi and j + k < bhi and a[i + k] == b[j + k]:
                    k += 1
                found.append((i, j, k))
                todo.append((alo, i, blo, j, size - 1))
                alo, blo = i + k, j + k
            if size:
                todo.append((alo, ahi, blo, bhi, size if small else size - 1))
                continue
            k = 0  # no match, but equal popular characters at the start
            while alo + k < ahi and blo + k < bhi and a[alo + k] == b[blo + k]:
                k += 1
            if k:
                found.append((alo, blo, k))
        self._digests = self._runs = None
        return found

    def _by_find(self, alo: int, ahi: int, blo: int, bhi: int, most: int) -> tuple[int, "_One"]:
        """Length of the longest match, and the first such match.

        No match holds a character that ``b`` lacks, so only runs without one are
        searched, each first as a whole."""
        x, find = self._x, self._y.find
        starts, ends = self._runs
        best, first = 0, alo
        k = bisect_right(ends, alo)
        while best < most and k < len(starts) and starts[k] < ahi:
            i, stop = max(alo, starts[k]), min(ahi, ends[k])
            k += 1
            while best < stop - i and best < most:
                if find(x[i:i + best + 1], blo, bhi) >= 0:
                    first, low, high = i, best + 1, stop - i
                    if find(x[i:stop], blo, bhi) >= 0:
                        low = high
                    while high - low > 1:
                        probe = (low + high) // 2
                        low, high = (probe, high) if find(x[i:i + probe], blo, bhi) >= 0 else (low, probe)
                    best = low
                i += 1
        return best, _One((first, find(x[first:first + best], blo, bhi)) if best else None)

    def _by_digests(self, alo: int, ahi: int, blo: int, bhi: int, most: int) -> tuple[int, "_Ties"]:
        """Length of the longest match, and all matches of that length."""
        if self._digests is None:
            self._digests = _Digests(self._x), _Digests(self._y)
        dx, dy = self._digests
        x, y = self._x, self._y

        def exists(size: int) -> bool:
            hx, hy = dx.runs(alo, ahi, size), dy.runs(blo, bhi, size)

            def same(c: int, all_places: bool) -> bool:
                places = np.flatnonzero(hy == hx[c])
                return any(x[alo + c:alo + c + size] == y[blo + j:blo + j + size]
                           for j in places[:None if all_places else 1].tolist())
            maybe = _maybe_in(hx, hy)
            if any(same(c, False) for c in maybe[:TRIES].tolist()):
                return True
            if not len(maybe):
                return False
            maybe = maybe[np.isin(hx[maybe], hy[_maybe_in(hy, hx[maybe])])]
            return any(same(c, True) for c in maybe.tolist())

        # down from ``most`` in growing steps, then by halving
        low, high, step = 0, most + 1, 1
        while high > 1:
            probe = max(1, high - step)
            if exists(probe):
                low = probe
                break
            high, step = probe, 2 * step
        while low and high - low > 1:
            probe = (low + high) // 2
            low, high = (probe, high) if exists(probe) else (low, probe)
        if not low:
            return 0, _One(None)
        return low, _Ties(x, y, low, dx.runs(alo, ahi, low), dy.runs(blo, bhi, low), alo, blo)


class _One:
    """At most one match."""

    def __init__(self, match: tuple[int, int] | None):
        self.match = match

    def first(self, alo: int, blo: int) -> tuple[int, int] | None:
        match, self.match = self.match, None
        return match


class _Ties:
    """All matches of one length between two ranges."""

    def __init__(self, x: str, y: str, size: int, hx: np.ndarray, hy: np.ndarray, alo: int, blo: int):
        self.x, self.y, self.size, self.at = x, y, size, 0
        mine = _maybe_in(hx, hy)
        others = _maybe_in(hy, hx[mine])
        others = others[np.argsort(hy[others], kind="stable")]
        values = hy[others]
        low, high = np.searchsorted(values, hx[mine], "left"), np.searchsorted(values, hx[mine], "right")
        some = high > low
        self.starts = (mine[some] + alo).tolist()
        self.low, self.high = low[some].tolist(), high[some].tolist()
        self.places = (others + blo).tolist()

    def first(self, alo: int, blo: int) -> tuple[int, int] | None:
        """The first match from these places on; they may only grow from call to call."""
        while self.at < len(self.starts):
            i, high = self.starts[self.at], self.high[self.at]
            if i >= alo:
                for k in range(bisect_left(self.places, blo, self.low[self.at], high), high):
                    j = self.places[k]
                    if self.x[i:i + self.size] == self.y[j:j + self.size]:
                        return i, j
            self.at += 1
        return None


def _joined(blocks: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Blocks that follow each other without a gap are one block."""
    out: list[tuple[int, int, int]] = []
    for i, j, k in blocks:
        if out and out[-1][0] + out[-1][2] == i and out[-1][1] + out[-1][2] == j:
            out[-1] = (*out[-1][:2], out[-1][2] + k)
        else:
            out.append((i, j, k))
    return out
