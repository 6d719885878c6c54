"""Probabilistic automata inferred from examples by merging states."""

from __future__ import annotations

import math
from collections.abc import Iterable

#: Share of probability that every state keeps for symbols it never saw.
UNSEEN = 0.01


class Automaton:
    """Deterministic automaton with counts, from a prefix tree whose states were merged.

    States are merged if their counts of ends and of every next symbol, and those of all
    states behind them, agree within Hoeffding bounds of confidence ``1 - alpha``.
    """

    def __init__(self, examples: Iterable[str], alphabet: int, alpha: float = 0.05):
        self.alphabet = alphabet
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        self.count: list[int] = [0]
        self.ends: list[int] = [0]
        # Per state: symbol to [next state, times].
        self.next: list[dict[str, list[int]]] = [{}]
        for x in examples:
            self._add(x)
        self._merge()
        self.scores = [self._score(s) for s in range(len(self.count))]

    def _add(self, example: str) -> None:
        s = 0
        self.count[0] += 1
        for c in example:
            step = self.next[s].get(c)
            if step is None:
                step = self.next[s][c] = [len(self.count), 0]
                self.count.append(0)
                self.ends.append(0)
                self.next.append({})
            step[1] += 1
            s = step[0]
            self.count[s] += 1
        self.ends[s] += 1

    def _merge(self) -> None:
        """Settle states from the root on; each new one is merged or settled itself."""
        settled = [0]
        fringe = [(0, c) for c in sorted(self.next[0])]
        while fringe:
            fringe.sort(key=lambda e: (-self.count[self.next[e[0]][e[1]][0]], e))
            source, symbol = fringe.pop(0)
            state = self.next[source][symbol][0]
            for other in settled:
                if self._agree(other, state):
                    self.next[source][symbol][0] = other
                    self._fold(other, state)
                    break
            else:
                settled.append(state)
            known = set(settled)
            fringe = [
                (s, c) for s in settled for c, (t, _) in sorted(self.next[s].items()) if t not in known
            ]

    def _agree(self, a: int, b: int) -> bool:
        """Whether two states may be one. The states behind ``b`` still are a tree."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.count[a], self.count[b]
            bound = self.width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            x, y = self.next[a], self.next[b]
            for c in x.keys() | y.keys():
                p, q = x.get(c), y.get(c)
                if abs((p[1] if p else 0) / n - (q[1] if q else 0) / m) > bound:
                    return False
                if p and q:
                    todo.append((p[0], q[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the counts of ``b`` and of all states behind it to ``a`` and those behind."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            mine = self.next[a]
            for c, (target, times) in self.next[b].items():
                step = mine.get(c)
                if step is None:
                    mine[c] = [target, times]
                else:
                    step[1] += times
                    todo.append((step[0], target))

    def _score(self, s: int) -> tuple[dict[str, tuple[float, int]], float, float]:
        """Logarithms by symbol with the next state, of an unseen symbol, and of the end."""
        if not self.count[s]:
            floor = -math.log(self.alphabet + 1)
            return {}, floor, floor
        floor = UNSEEN / (self.alphabet + 1)
        known = lambda times: math.log((1 - UNSEEN) * times / self.count[s] + floor)
        return (
            {c: (known(times), target) for c, (target, times) in self.next[s].items()},
            math.log(floor),
            known(self.ends[s]),
        )

    def log_likelihood(self, text: str) -> float:
        """Log probability of a text. An unseen symbol leaves the state as it is."""
        total, s = 0.0, 0
        scores = self.scores
        for c in text:
            steps, unseen, _ = scores[s]
            step = steps.get(c)
            if step is None:
                total += unseen
            else:
                total += step[0]
                s = step[1]
        return total + scores[s][2]
