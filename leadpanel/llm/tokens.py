"""Token ids of many texts from the ids of their distinct units.

Texts repeat their words. A tokenizer whose pieces never cross a unit's edge
gives a text the ids of its units in a row, so each distinct unit is encoded
once per Python worker and a text's ids are gathered with numpy.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa

#: Distinct units a worker remembers before it forgets the later half; bounds its memory, not the result.
UNITS_KEPT = 800_000
#: Characters that are split into units at a time.
CHUNK_CHARS = 2_000_000


def flatten(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids in a row, and how many each list had."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes


#: What this Python worker remembers for one operator, and how to forget it.
_held: dict[str, Callable[[], None]] = {}


def give_back() -> None:
    """Hands memory that Python and Arrow have freed back to the system, where its allocator can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def hold(owner: str, forget: Callable[[], None]) -> None:
    """Called as a task starts: what other operators left in this reused worker is forgotten, so memories do not add up."""
    others = [name for name in _held if name != owner]
    for other in others:
        _held.pop(other)()
    if others or not _held:
        give_back()
    _held[owner] = forget


class WordNumbers(dict):
    """A number per word, made on first use; forgets all when it is full."""

    def __init__(self, make: Callable[[bytes], int], limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = self.make(word)
        return value


class _Numbers(dict):
    """Gives each new key the next number and notes it."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key) -> int:
        self[key] = number = len(self)
        self.new.append(key)
        return number


class UnitEncoder:
    """``split`` cuts a text into units, ``encode`` gives the ids of a list of units in a row, and the number of each.

    ``parts`` is an encoder that ``encode`` uses itself; it is forgotten with this one.
    """

    def __init__(self, split: Callable[[str], list], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
                 units_kept: int = UNITS_KEPT, chunk_chars: int = CHUNK_CHARS, parts: UnitEncoder | None = None):
        self.split, self.encode, self.units_kept, self.chunk_chars, self.parts = split, encode, units_kept, chunk_chars, parts
        self.forget()

    def forget(self) -> None:
        if self.parts is not None:
            self.parts.forget()
        self.index = _Numbers()
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.used = np.zeros(4096, np.uint32), 0

    def _learn(self, units: list) -> None:
        flat, sizes = self.encode(units)
        first, n = len(self.index) - len(units), len(units)
        while len(self.starts) < first + n:
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.starts[first:first + n] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:first + n] = sizes
        self.ids[self.used:self.used + len(flat)] = flat
        self.used += len(flat)

    def _forget_later_half(self) -> None:
        """What was met first is what is met most."""
        keep = self.units_kept // 2
        kept = _Numbers()
        kept.update(islice(self.index.items(), keep))
        self.index = kept
        self.used = int(self.starts[keep - 1] + self.sizes[keep - 1]) if keep else 0

    def texts(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        waiting: list[str] = []
        chars = 0
        for text in texts:
            waiting.append(text)
            chars += len(text)
            if chars >= self.chunk_chars:
                yield from self._chunk(waiting)
                waiting, chars = [], 0
        yield from self._chunk(waiting)

    def _chunk(self, texts: list[str]) -> Iterator[np.ndarray]:
        units = [self.split(text) for text in texts]
        if len(self.index) > self.units_kept:
            self._forget_later_half()
        counts = list(map(len, units))
        at = np.fromiter(map(self.index.__getitem__, chain.from_iterable(units)), np.int64, sum(counts))
        if self.index.new:
            self._learn(self.index.new)
            self.index.new = []
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        where = np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        flat = self.ids[where]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        for low, high in zip(bounds[:-1], bounds[1:]):
            yield flat[low:high]
