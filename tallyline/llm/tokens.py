"""Token ids of whole texts by a public tokenizer file, each distinct unit encoded once.

A unit is a piece of text no token reaches beyond: the run of characters between
ASCII white space (with the white space before it, for tokenizers that keep white
space), cut once more before a full stop or comma that follows a letter or digit.
None of the pre-tokenizer patterns in use joins characters across such places, so
the ids of a text are the ids of its units in a row.  Texts with other white space
than ASCII are encoded whole where white space is kept.  Units are found, hashed and
put together as numpy arrays; only units not met before become strings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from tallyline.llm.words import _SPACE, _ranges, pieces, run_hashes

#: Units remembered per worker (some 40 bytes each); only a cache, emptied when full.
CACHED_UNITS = 3_000_000

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True


def _after(data: np.ndarray, n: int, fill: int = 0) -> np.ndarray:
    """``data`` shifted so that place i holds what stands n places later."""
    out = np.full(len(data), fill, data.dtype)
    if n < len(data):
        out[: len(data) - n] = data[n:]
    return out


def _wide_space(data: np.ndarray) -> np.ndarray:
    """Places where a white-space character outside ASCII begins (UTF-8)."""
    a, b, c = data, _after(data, 1), _after(data, 2)
    found = (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    found |= (a == 0xE1) & (b == 0x9A) & (c == 0x80)
    line = ((c >= 0x80) & (c <= 0x8A)) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)
    found |= (a == 0xE2) & (((b == 0x80) & line) | ((b == 0x81) & (c == 0x9F)))
    return np.flatnonzero(found | ((a == 0xE3) & (b == 0x80) & (c == 0x80)))


class Encoder:
    """Encodes texts to ids; ``keeps_space``: white space becomes part of tokens."""

    def __init__(self, path: str, keeps_space: bool | None = None) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        if keeps_space is None:
            keeps_space = len(self._ids([" "])[0]) > 0
        self.keeps_space = keeps_space
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        space = _SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        one, two = np.roll(data, 1), np.roll(data, 2)
        letter = _ALNUM[one] | ((two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7))
        cut = _STOP[data] & letter
        if self.keeps_space:
            first = edge[:-1] | cut | (space & ~np.roll(space, 1))
            starts = np.flatnonzero(first)
            return starts, np.append(starts[1:], len(data))
        first = ~space & (edge[:-1] | cut | np.roll(space, 1))
        last = ~space & (edge[1:] | _after(cut, 1) | _after(space, 1, True))
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        if len(self.keys) + len(keys) > CACHED_UNITS:
            self._clear()
        ids: list[list[int]] = []
        for start in range(0, len(texts), 10_000):
            ids += self._ids(texts[start : start + 10_000])
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum()))
        begin = len(self.flat) + np.cumsum(count) - count
        slots = len(self.begin) + np.arange(len(ids))
        self.flat = np.concatenate([self.flat, flat])
        self.begin = np.concatenate([self.begin, begin])
        self.count = np.concatenate([self.count, count])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.slots = np.insert(self.slots, at, slots)

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys

    def encode(
        self, data: np.ndarray, offsets: np.ndarray, end_id: int | None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a byte buffer in a row, and where each text's begin."""
        n = len(offsets) - 1
        starts, ends = self._units(data, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
        hashes = run_hashes(data, starts, ends)
        keys, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~self._known(keys)
        if len(self.keys) + int(new.sum()) > CACHED_UNITS:
            self._clear()
            new[:] = True
        if new.any():
            raw, at = data.tobytes(), where[new]
            self._learn(
                keys[new],
                [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[at], ends[at], strict=True)],
            )
        if len(keys):
            slot = self.slots[np.searchsorted(self.keys, keys)][which]
            begin, count = self.begin[slot], self.count[slot]
        else:
            begin = count = np.zeros(0, np.int64)
        owned = np.searchsorted(starts, offsets)
        ids = self.flat[_ranges(begin, count)]
        total = np.append(0, np.cumsum(count))[owned]
        if self.keeps_space and len(data) and len(wide := _wide_space(data)):
            ids, total = self._whole(data, offsets, ids, total, wide)
        if end_id is None:
            return ids, total
        places = total + np.arange(n + 1)
        out = np.empty(int(places[-1]), np.uint32)
        out[places[1:] - 1] = end_id
        body = np.ones(len(out), bool)
        body[places[1:] - 1] = False
        out[body] = ids
        return out, places

    def _whole(self, data, offsets, ids, total, wide):
        """Replaces the ids of texts with wide white space by those of the whole text."""
        odd = np.unique(np.searchsorted(offsets, wide, "right") - 1)
        raw = data.tobytes()
        found = self._ids([raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace") for i in odd])
        parts = np.split(ids, total[1:-1]) if len(total) > 2 else [ids]
        for i, x in zip(odd, found, strict=True):
            parts[i] = np.array(x, np.uint32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.concatenate(parts), np.append(0, np.cumsum(sizes))

    def encode_batch(self, batch: pa.RecordBatch, end_id: int | None, text: str = "text"):
        """Yields ``(first row, last row + 1, ids, places)`` over pieces of a batch."""
        for start, stop, data, offsets in pieces(batch, text):
            yield start, stop, *self.encode(data, offsets, end_id)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name: str) -> str:
    """Where a file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)
