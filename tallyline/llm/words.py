"""Words and word windows of whole texts as numpy arrays of 64-bit hashes.

A word is a run of bytes outside space and 0x09-0x0D.  Nothing here makes a Python
object per word: the texts of an Arrow batch are taken as one byte buffer, in
pieces of bounded size, so memory depends on the longest single text only.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; one longer text is handled alone.
PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_STEP = 0x9E3779B97F4A7C15
_WORD_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd base modulo 2**64, grown on demand."""

    def __init__(self, base: int) -> None:
        self.base = base
        self.table = np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), 1 << 64))
            self.table = np.concatenate([self.table, self.table * step])
        return self.table[:n]


_FORWARD = [_Powers(b) for b in _WORD_BASES]
_BACKWARD = [_Powers(pow(b, -1, 1 << 64)) for b in _WORD_BASES]


def _ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All numbers ``begin[i]`` up to ``begin[i] + count[i]``, in a row."""
    before = np.cumsum(count) - count
    return np.repeat(begin - before, count) + np.arange(int(count.sum()))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run; runs are not empty.

    Each eight bytes are scrambled together with their place before they are added up, so
    no arrangement of bytes cancels out as it does in a sum of bytes times powers.
    """
    lengths = ends - starts
    if not len(lengths):
        return np.zeros(0, np.uint64)
    lanes = (lengths + 7) >> 3
    first = np.cumsum(lanes) - lanes
    number = np.arange(int(lanes.sum())) - np.repeat(first, lanes)
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    lane = eights[np.repeat(starts, lanes) + 8 * number]
    spare = 8 * (8 * lanes - lengths).astype(np.uint64)
    last = first + lanes - 1
    lane[last] = lane[last] << spare >> spare
    lane = mixed(lane + (number + 1).astype(np.uint64) * np.uint64(_STEP))
    return mixed(np.add.reduceat(lane, first) + lengths.astype(np.uint64) * np.uint64(_WORD_BASES[0]))


class Words:
    """The words of some texts.

    ``hashes`` has one value per word; text ``i`` has the words ``first[i]`` up to
    ``first[i + 1]``; ``starts`` and ``ends`` are places in ``data``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        self.data = _LOWER[data] if lower else data
        solid = ~_SPACE[self.data]
        cut = np.zeros(len(solid) + 1, bool)
        cut[offsets] = True
        before = np.empty(len(solid), bool)
        before[:1] = True
        before[1:] = ~solid[:-1]
        after = np.empty(len(solid), bool)
        after[-1:] = True
        after[:-1] = ~solid[1:]
        self.starts = np.flatnonzero(solid & (before | cut[:-1]))
        self.ends = np.flatnonzero(solid & (after | cut[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = run_hashes(self.data, self.starts, self.ends)
        self._sums: dict[int, np.ndarray] = {}

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def _prefix(self, which: int) -> np.ndarray:
        if which not in self._sums:
            total = np.zeros(len(self.hashes) + 1, np.uint64)
            np.cumsum(self.hashes * _FORWARD[which].upto(len(self.hashes)), out=total[1:])
            self._sums[which] = total
        return self._sums[which]

    def spans(self, begin: np.ndarray, stop: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of the word sequences ``begin`` up to ``stop``, of some hundred words at most.

        Sums of powers modulo 2**64 lose bits over a thousand words arranged on purpose;
        ``whole`` is for sequences of any length.
        """
        total = self._prefix(which)
        back = _BACKWARD[which].upto(len(self.hashes) + 1)
        return mixed((total[stop] - total[begin]) * back[begin] + (stop - begin).astype(np.uint64))

    def whole(self, text: np.ndarray, which: int = 0) -> np.ndarray:
        """Hashes of all words of some texts, each with one word at least."""
        count = self.counts()[text]
        at = _ranges(self.first[text], count)
        begin = np.cumsum(count) - count
        place = np.arange(len(at)) - np.repeat(begin, count)
        each = mixed(self.hashes[at] + (place + 1).astype(np.uint64) * np.uint64(_WORD_BASES[which]))
        return mixed(np.add.reduceat(each, begin) + count.astype(np.uint64)) if len(at) else each

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words inside one text."""
        last = np.repeat(self.first[1:], self.counts())
        return np.flatnonzero(np.arange(len(self.hashes)) + size <= last)


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def tidy(emit: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``emit`` for ``mapInArrow``; when its task ends, freed memory goes back to the system.

    Workers stay for later tasks, and what their allocators keep for themselves would add
    to the executor's memory in stages that run no Python too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from emit(batches)
        _give_back()

    return run


def pieces(
    batch: pa.RecordBatch, text: str = "text", most: int = PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a batch with their text bytes and offsets; null is empty."""
    column = batch.column(text)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, places, data = column.buffers()
    ends = np.frombuffer(places, np.int64)[column.offset : column.offset + n + 1]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + most, "right")) - 1)
        stop = min(stop, n)
        yield row, stop, held[ends[row] : ends[stop]], ends[row : stop + 1] - ends[row]
        row = stop
