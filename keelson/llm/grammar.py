"""Probabilistic automata inferred from strings by state merging.

The strings' prefix tree is built with counts; states are then visited in
breadth-first order and each is merged with the first earlier state whose
outgoing and ending frequencies, and those of all common successors, agree
within Hoeffding's bound. What remains is a small automaton with loops.
"""

from __future__ import annotations

import math
from collections import Counter, deque
from collections.abc import Iterable
from dataclasses import dataclass

#: Confidence of the compatibility test: smaller merges more.
ALPHA = 0.05
#: Log probability of a step that no training string took.
UNSEEN = math.log(1e-5)


class _Node:
    __slots__ = ("count", "ends", "next", "taken")

    def __init__(self) -> None:
        self.count, self.ends = 0, 0
        self.next: dict[str, _Node] = {}
        self.taken: Counter[str] = Counter()


@dataclass
class Automaton:
    """``steps[state]`` maps a symbol to (next state, log probability)."""

    steps: list[dict[str, tuple[int, float]]]
    ends: list[float]

    def likelihood(self, symbols: str) -> float:
        """Mean log probability of a string's steps and its end; an unseen step
        stays in its state."""
        state, total = 0, 0.0
        for s in symbols:
            to, p = self.steps[state].get(s, (state, UNSEEN))
            state, total = to, total + p
        return (total + self.ends[state]) / (len(symbols) + 1)


def _prefix_tree(strings: Iterable[tuple[str, int]]) -> _Node:
    root = _Node()
    for symbols, n in strings:
        node = root
        node.count += n
        for s in symbols:
            node.taken[s] += n
            node = node.next.setdefault(s, _Node())
            node.count += n
        node.ends += n
    return root


def _differ(a: int, n: int, b: int, m: int, alpha: float) -> bool:
    bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
    return abs(a / n - b / m) > bound


def _compatible(a: _Node, b: _Node, alpha: float) -> bool:
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        if not x.count or not y.count:
            continue
        if _differ(x.ends, x.count, y.ends, y.count, alpha):
            return False
        for s in x.taken.keys() | y.taken.keys():
            if _differ(x.taken[s], x.count, y.taken[s], y.count, alpha):
                return False
            if s in x.next and s in y.next and x.next[s] is not y.next[s]:
                todo.append((x.next[s], y.next[s]))
    return True


def _fold(a: _Node, b: _Node) -> None:
    """Add the tree below ``b`` to ``a`` and what ``a`` leads to."""
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        x.count += y.count
        x.ends += y.ends
        x.taken.update(y.taken)
        for s, child in y.next.items():
            if s in x.next:
                todo.append((x.next[s], child))
            else:
                x.next[s] = child


def infer(strings: Iterable[tuple[str, int]], alpha: float = ALPHA) -> Automaton:
    """The automaton of (string, count) pairs; of none, one that accepts nothing likely."""
    root = _prefix_tree(sorted(strings))
    kept: list[_Node] = [root]
    known = {id(root)}
    open_: deque[tuple[_Node, str]] = deque((root, s) for s in sorted(root.next))
    while open_:
        parent, symbol = open_.popleft()
        node = parent.next[symbol]
        if id(node) in known:
            continue
        twin = next((k for k in kept if _compatible(k, node, alpha)), None)
        if twin is None:
            kept.append(node)
            known.add(id(node))
            open_.extend((node, s) for s in sorted(node.next))
        else:
            parent.next[symbol] = twin
            _fold(twin, node)
            # folding may hang new trees below states that were kept before
            open_.extend((k, s) for k in kept for s in sorted(k.next) if id(k.next[s]) not in known)
    number = {id(k): i for i, k in enumerate(kept)}
    steps = [{s: (number[id(t)], math.log(k.taken[s] / k.count)) for s, t in sorted(k.next.items())} for k in kept]
    return Automaton(steps, [math.log(k.ends / k.count) if k.ends else UNSEEN for k in kept])
