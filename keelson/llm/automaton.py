"""Suffix automata over words, for matching statistics.

The automaton of several texts accepts every run of words in any of them. Each
state knows the first text (in order of adding) that holds its runs.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence


class SuffixAutomaton:
    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]
        self.texts = 0

    def add(self, words: Sequence[Hashable]) -> None:
        """Add a text; its number is how many were added before."""
        text, self.texts = self.texts, self.texts + 1
        last = 0
        for w in words:
            last = self._grow(last, w, text)

    def _state(self, length: int, text: int, steps: dict, link: int) -> int:
        self.next.append(steps)
        self.link.append(link)
        self.length.append(length)
        self.first.append(text)
        return len(self.next) - 1

    def _grow(self, last: int, w: Hashable, text: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        to = nxt[last].get(w)
        if to is not None:  # a run that an earlier text holds too
            return to if length[to] == length[last] + 1 else self._split(last, w, to)
        new = self._state(length[last] + 1, text, {}, 0)
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            to = nxt[p][w]
            link[new] = to if length[to] == length[p] + 1 else self._split(p, w, to)
        return new

    def _split(self, p: int, w: Hashable, to: int) -> int:
        """A state for the shorter runs of ``to``, those that end in ``w`` after ``p``."""
        nxt, link = self.next, self.link
        copy = self._state(self.length[p] + 1, self.first[to], nxt[to].copy(), link[to])
        link[to] = copy
        while p >= 0 and nxt[p].get(w) == to:
            nxt[p][w] = copy
            p = link[p]
        return copy

    def matches(self, words: Sequence[Hashable], most: int) -> Iterator[tuple[int, int]]:
        """Matching statistics: after each word, the length (``most`` at the
        largest) of the longest run ending there that some text holds, and the
        first text that does (-1 for none)."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        state = held = 0
        for w in words:
            while state and w not in nxt[state]:
                state = link[state]
                held = length[state]
            to = nxt[state].get(w)
            if to is None:
                state = held = 0
            else:
                state, held = to, held + 1
                if held > most:
                    held = most
                while length[link[state]] >= held and state:
                    state = link[state]
            yield held, first[state]
