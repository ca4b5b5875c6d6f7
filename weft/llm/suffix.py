"""A suffix automaton of many sequences of small numbers, built in one pass.

After reading symbols, the state is the longest suffix that occurs in one of the
sequences. Transitions are in one dictionary, ``step``, by state * ``alphabet`` + symbol:
about 100 bytes each, and there are little more of them than of symbols read.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator


class SuffixAutomaton:
    def __init__(self, alphabet: int):
        self.alphabet = alphabet
        self.step: dict[int, int] = {}
        self.link, self.size = array("i", [-1]), array("i", [0])
        #: Symbols that lead onward from a state: none, one, or a list of them; only needed while it grows.
        self._onward: list[None | int | list[int]] = [None]

    def __len__(self) -> int:
        return len(self.link)

    def _state(self, length: int, link: int) -> int:
        self.size.append(length)
        self.link.append(link)
        self._onward.append(None)
        return len(self.link) - 1

    def _lead(self, state: int, symbol: int, to: int) -> None:
        key = state * self.alphabet + symbol
        if key not in self.step:
            now = self._onward[state]
            if now is None:
                self._onward[state] = symbol
            elif isinstance(now, list):
                now.append(symbol)
            else:
                self._onward[state] = [now, symbol]
        self.step[key] = to

    def _clone(self, p: int, symbol: int, q: int) -> int:
        step, n = self.step, self.alphabet
        k = self._state(self.size[p] + 1, self.link[q])
        now = self._onward[q]
        for c in now if isinstance(now, list) else [] if now is None else [now]:
            self._lead(k, c, step[q * n + c])
        self.link[q] = k
        while p >= 0 and step.get(p * n + symbol) == q:
            step[p * n + symbol] = k
            p = self.link[p]
        return k

    def add(self, symbols: Iterable[int]) -> Iterator[int]:
        """Adds a sequence; gives the state after each of its symbols."""
        step, link, size, n = self.step, self.link, self.size, self.alphabet
        last = 0
        for c in symbols:
            q = step.get(last * n + c)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._clone(last, c, q)
            else:
                cur, p = self._state(size[last] + 1, 0), last
                while p >= 0 and p * n + c not in step:
                    self._lead(p, c, cur)
                    p = link[p]
                if p >= 0:
                    q = step[p * n + c]
                    link[cur] = q if size[q] == size[p] + 1 else self._clone(p, c, q)
                last = cur
            yield last

    def finish(self) -> list[int]:
        """No more sequences come. All states but the first, the longest first."""
        self._onward = []
        return sorted(range(1, len(self)), key=self.size.__getitem__, reverse=True)
