"""E10 on one text: ordered, cascading replacement in a time that grows with the
replacements, not with keys times text.

All occurrences of all keys are found once by an Aho-Corasick automaton.  A heap holds
the ranks of keys that may occur; each step takes the lowest, replaces its occurrences,
and looks for new ones only around the replaced places.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from heapq import heappop, heappush


class Dictionary:
    """Entries in rank order and their automaton; empty keys replace nothing."""

    def __init__(self, entries: Sequence[tuple[str, str]]):
        import ahocorasick
        self.entries = entries
        ranks: dict[str, list[int]] = {}
        for rank, (key, _value) in enumerate(entries):
            if key:
                ranks.setdefault(key, []).append(rank)
        self.longest = max(map(len, ranks), default=0)
        self.automaton = ahocorasick.Automaton()
        for key, own in ranks.items():
            self.automaton.add_word(key, (key, own))
        if ranks:
            self.automaton.make_automaton()

    def occurrences(self, text: str) -> Iterator[tuple[int, int, str, list[int]]]:
        """(first place, last place, key, its ranks)."""
        if self.longest:
            for last, (key, ranks) in self.automaton.iter(text):
                yield last - len(key) + 1, last, key, ranks

    def occurs(self, text: str | None) -> bool | None:
        return None if text is None else next(self.occurrences(text), None) is not None


class LinkedText:
    """A text whose places can be replaced.  Characters keep their numbers, new ones
    follow behind; links are held only where they differ from the text's own order.
    Place -1 stands before the text, ``end`` behind it."""

    def __init__(self, text: str):
        self.text, self.end = text, len(text)
        self.added: list[str] = []
        self.after: dict[int, int] = {}
        self.before: dict[int, int] = {}
        self.gone: set[int] = set()

    def char(self, place: int) -> str:
        return self.text[place] if place < self.end else self.added[place - self.end - 1]

    def match(self, place: int, key: str) -> list[int] | None:
        """The places of ``key`` from ``place`` on, or None if it does not stand there."""
        places = []
        for ch in key:
            if place == self.end or place in self.gone or self.char(place) != ch:
                return None
            places.append(place)
            place = self.after.get(place, place + 1)
        return places

    def replace(self, places: list[int], value: str) -> list[int]:
        """Put ``value`` in their stead; returns its places."""
        left = self.before.get(places[0], places[0] - 1)
        right = self.after.get(places[-1], places[-1] + 1)
        self.gone.update(places)
        first = self.end + len(self.added) + 1
        self.added.extend(value)
        new = list(range(first, first + len(value)))
        for place in [*new, right]:
            self.after[left], self.before[place] = place, left
            left = place
        return new

    def walk(self, place: int, links: dict[int, int], step: int, most: int) -> list[int]:
        """At most ``most`` places that follow ``place`` in one direction."""
        out = []
        while len(out) < most:
            place = links.get(place, place + step)
            if place in (-1, self.end):
                break
            out.append(place)
        return out

    def __str__(self) -> str:
        breaks = sorted(p for p in self.after if p < self.end)
        out, place = [], self.after.get(-1, 0)
        while place != self.end:
            if place > self.end:
                out.append(self.char(place))
                place = self.after[place]
                continue
            k = bisect_left(breaks, place)
            stop = breaks[k] if k < len(breaks) else self.end - 1
            out.append(self.text[place:stop + 1])
            place = self.after.get(stop, stop + 1)
        return "".join(out)


def _apart(found: dict[int, list[int]]) -> Iterator[list[int]]:
    """Of occurrences (first place -> places), those that ``str.replace`` takes: from
    left to right, none that overlaps one taken before."""
    follows = {}
    for start, places in found.items():
        follows[start] = next((p for p in places[1:] if p in found), None)
    behind = set(follows.values())
    for start in found:
        taken = None
        while start not in behind or taken:
            if taken is None or start not in taken:
                taken = found[start]
                yield taken
            start = follows[start]
            if start is None:
                break


def fold_text(text: str | None, dictionary: Dictionary) -> str | None:
    """The text after all entries have been applied in rank order, each to the outcome
    of those before it."""
    if text is None:
        return None
    waiting: dict[str, set[int]] = {}
    heap: list[int] = []
    queued: set[int] = set()
    rank = -1

    def meet(key: str, ranks: list[int], place: int) -> None:
        k = bisect_right(ranks, rank)
        if k < len(ranks):
            waiting.setdefault(key, set()).add(place)
            if ranks[k] not in queued:
                queued.add(ranks[k])
                heappush(heap, ranks[k])

    for first, _last, key, ranks in dictionary.occurrences(text):
        meet(key, ranks, first)
    if not heap:
        return text
    linked, reach = LinkedText(text), dictionary.longest - 1
    while heap:
        rank = heappop(heap)
        key, value = dictionary.entries[rank]
        found = {p: places for p in waiting.pop(key, ()) if (places := linked.match(p, key))}
        for places in list(_apart(found)):
            new = linked.replace(places, value)
            left = linked.before[new[0]] if new else linked.before.get(places[0], places[0] - 1)
            right = linked.after[new[-1]] if new else linked.after[left]
            head, tail = [], []
            if left != -1 and reach:
                head = [*linked.walk(left, linked.before, -1, reach - 1)[::-1], left]
            if right != linked.end and reach:
                tail = [right, *linked.walk(right, linked.after, 1, reach - 1)]
            near = head + new + tail
            for first, last, other, ranks in dictionary.occurrences("".join(map(linked.char, near))):
                if first < len(head) + len(new) and last >= len(head):  # touches the replaced place
                    meet(other, ranks, near[first])
    return str(linked)
