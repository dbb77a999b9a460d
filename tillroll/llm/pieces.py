"""Values of text pieces remembered by a Python worker."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np

PIECES, CHARS = 500_000, 20_000_000


class Pieces:
    """A table from pieces to numbers (``numbers``, a row per slot) and values
    (``values``, lists by slot).

    Texts repeat their words (Zipf), so a piece is computed once and looked up
    afterwards.  ``compute(pieces)`` gives the rows of numbers and the lists of
    values.  ``trim`` bounds the table: over ``limit`` pieces or ``chars``
    characters the most used three quarters stay.  Forgetting costs time only.
    """

    def __init__(self, compute: Callable, width: int, n_values: int, limit: int = PIECES, chars: int = CHARS):
        self.compute, self.limit, self.chars = compute, limit, chars
        self.slot: dict[str, int] = {}
        self.values: list[list] = [[] for _ in range(n_values)]
        self.numbers = np.zeros((1024, width), np.int64)
        self.uses = np.zeros(1024, np.int64)
        self.held = 0

    def full(self) -> bool:
        return len(self.slot) > self.limit or self.held > self.chars

    def trim(self) -> None:
        pieces = list(self.slot)
        order = np.argsort(-self.uses[: len(pieces)], kind="stable")[: 3 * self.limit // 4]
        sizes = np.cumsum([len(pieces[i]) for i in order.tolist()])
        kept = order[sizes <= 3 * self.chars // 4]
        self.numbers[: len(kept)], self.uses[: len(kept)], self.uses[len(kept) :] = self.numbers[kept], 0, 0
        kept = kept.tolist()
        self.slot = {pieces[i]: n for n, i in enumerate(kept)}
        self.values = [[v[i] for i in kept] for v in self.values]
        self.held = int(sizes[len(kept) - 1]) if kept else 0

    def slots(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The slots of all pieces of all lists, and where each list ends there."""
        flat = list(chain.from_iterable(lists))
        at = np.fromiter(map(self.slot.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            again = [flat[i] for i in missing]
            new = list(dict.fromkeys(again))
            start, stop = len(self.slot), len(self.slot) + len(new)
            numbers, values = self.compute(new)
            while len(self.uses) < stop:
                self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
                self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)])
            self.numbers[start:stop] = numbers
            for old, more in zip(self.values, values):
                old.extend(more)
            self.slot.update(zip(new, range(start, stop)))
            self.held += sum(map(len, new))
            at[missing] = list(map(self.slot.__getitem__, again))
        self.uses[: len(self.slot)] += np.bincount(at, minlength=len(self.slot))
        return at, np.cumsum([len(x) for x in lists], dtype=np.int64)
