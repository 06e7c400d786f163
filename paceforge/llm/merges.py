"""Byte-pair merges: which two tokens stay apart when the merges run over both."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from heapq import heapify, heappop, heappush

NEVER = 1 << 60
#: Symbols from which on a row is merged with a heap.
LONG = 40


class Merges:
    """A vocabulary of strings and the rank at which two of them become one (NEVER: not at all).

    Merges run lowest rank first, and from the left among equals. The tokens of a string are then the
    only row of tokens that spells it and in which each token stays apart from the next; so the last token of every
    prefix follows from the last tokens of shorter prefixes, and the prefixes are a plain dynamic programme.
    """

    def __init__(self, tokens: dict[str, int], rank: Callable[[str, str], int], split: Callable[[str], list[str]]):
        """tokens: number of each; rank: of a pair; split: the smallest symbols of a token."""
        self.rank, self.number = rank, {}
        self.text: dict[int, str] = {}
        #: of each token the rank of the merge that made it (-1: none), and its two halves
        self.made: dict[int, tuple[int, str, str]] = {}
        for token, number in tokens.items():
            symbols = split(token)
            last = (-1, "", "")
            if len(symbols) > 1:
                done, last = self.run(symbols)
                if len(done) > 1:
                    continue  # no text ever gives this token
            self.number[token], self.text[number], self.made[number] = number, token, last
        self.longest = max(map(len, self.number), default=0)
        self.known: dict[int, bool] = {}

    def run(self, symbols: Sequence[str]) -> tuple[list[str], tuple[int, str, str]]:
        """All merges of a row of symbols, one by one, and the last merge."""
        if len(symbols) > LONG:
            return self._run_long(symbols)
        row, last = list(symbols), (-1, "", "")
        while len(row) > 1:
            best, at = min((self.rank(row[k], row[k + 1]), k) for k in range(len(row) - 1))
            if best >= NEVER:
                break
            last = (best, row[at], row[at + 1])
            row[at : at + 2] = [row[at] + row[at + 1]]
        return row, last

    def _run_long(self, symbols: Sequence[str]) -> tuple[list[str], tuple[int, str, str]]:
        """The same for a long row, with the pairs in a heap."""
        row: list[str | None] = list(symbols)
        after, before = list(range(1, len(row) + 1)), list(range(-1, len(row) - 1))
        heap = [(r, k, row[k], row[k + 1]) for k in range(len(row) - 1) if (r := self.rank(row[k], row[k + 1])) < NEVER]
        heapify(heap)
        last = (-1, "", "")
        while heap:
            rank, k, a, b = heappop(heap)
            n = after[k]
            if row[k] != a or n >= len(row) or row[n] != b:
                continue  # one of the two has merged with another since
            last = (rank, a, b)
            row[k], row[n] = a + b, None
            after[k] = after[n]
            if after[k] < len(row):
                before[after[k]] = k
            for left in (before[k], k):
                right = after[left] if left >= 0 else len(row)
                if right < len(row) and (r := self.rank(row[left], row[right])) < NEVER:
                    heappush(heap, (r, left, row[left], row[right]))
        return [x for x in row if x is not None], last

    def apart(self, a: int, b: int) -> bool:
        """Whether token a, followed by token b, is what merging leaves of both together.

        The merges are taken back, the last one first; at each moment the pieces that meet at the border
        must not have had a merge that went before the one taken back.
        """
        key = a << 20 | b
        found = self.known.get(key)
        if found is None:
            if len(self.known) > 1_000_000:
                self.known.clear()
            found = self.known[key] = self._apart(self.text[a], self.made[a], self.text[b], self.made[b])
        return found

    def _apart(self, x: str, made_x: tuple, y: str, made_y: tuple) -> bool:
        bound = NEVER
        while self.rank(x, y) >= bound:
            if made_x[0] < 0 and made_y[0] < 0:
                return True
            if made_x[0] > made_y[0]:  # the left piece was made later
                bound, x = made_x[0], made_x[2]
                made_x = self.made[self.number[x]]
            else:  # the right one; among equals the left goes first, so an equal rank goes before it
                bound, y = made_y[0] + 1, made_y[1]
                made_y = self.made[self.number[y]]
        return False
