"""Word shingles of texts and their SuperMinHash signatures, over Arrow batches of texts."""

from __future__ import annotations

import numpy as np

from adloom.llm.common import mix64

WORDS = 5
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_OF_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_OF_PLACE = mix64(np.arange(1, WORDS + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)) | _U(1)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the text it is in. Words end at ASCII white space; A-Z are lowered."""
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    begin = np.flatnonzero(starts)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    kept = np.flatnonzero(inside)
    at = np.searchsorted(kept, begin)
    size = np.diff(np.append(at, len(kept)))
    place = np.arange(len(kept)) - np.repeat(at, size)
    weights = mix64(np.arange(1, size.max() + 1, dtype=np.uint64) * _U(0x2545F4914F6CDD1D))
    sums = np.add.reduceat(_OF_BYTE[_LOWER[data[kept]]] * weights[place], at)
    owner = np.searchsorted(offsets, begin, "right") - 1
    return mix64(sums + size.astype(np.uint64)), owner


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: all hashes end to end, ascending within a text, and their offsets.

    A text of fewer than five words has its word sequence as its one shingle, one without words has none.
    """
    texts = len(offsets) - 1
    words, owner = _words(data, offsets)
    count = np.bincount(owner, minlength=texts)
    total = len(words)
    # words beyond the end of a short text do not enter its sum
    window = np.zeros(total, np.uint64)
    for place in range(WORDS):
        stop = max(total - place, 0)  # a slice can hold fewer words than a shingle
        part = words[place:] * _OF_PLACE[place]
        same = owner[place:] == owner[:stop] if place else np.ones(total, bool)
        window[:stop] += np.where(same, part, _U(0))
    room = np.repeat(np.cumsum(count), count) - np.arange(total)  # words from here to the end of the text
    begins = np.arange(total) == np.repeat(np.cumsum(count) - count, count)
    used = (room >= WORDS) | begins
    hashes = mix64(window[used] + np.minimum(room[used], WORDS).astype(np.uint64))
    owner = owner[used]
    bounds = np.searchsorted(owner, np.arange(texts + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.searchsorted(owner[fresh], np.arange(texts + 1))


def signatures(hashes: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash signature of each set, one row of ``size`` values each.

    An element visits the positions in the order of a random permutation of its own, and its value at its
    j-th position lies between j and j + 1; a position keeps the least value it gets. So once every position
    of a set has a value after rank j, later ranks change nothing, and the set stops there. Values are
    integers: the rank above, the fraction below.
    """
    texts = len(offsets) - 1
    out = np.full(texts * size, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    state, rows = hashes, owner
    swaps: list[np.ndarray] = []  # what each element's first ranks exchanged
    order: np.ndarray | None = None  # afterwards, the rest of its permutation
    for rank in range(size):
        drawn = mix64(state + _U((rank + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        swap = (rank + (((drawn & _U(0xFFFFFFFF)) * _U(size - rank)) >> _U(32)).astype(np.int64)).astype(np.int32)
        if order is None:
            place = swap.copy()
            for earlier in range(rank - 1, -1, -1):
                place[place == swaps[earlier]] = earlier
            swaps.append(swap)
        else:
            every = np.arange(len(order))
            place = order[every, swap].astype(np.int64)
            order[every, swap] = order[:, rank]
        value = (_U(rank) << _U(48)) | (drawn >> _U(16))
        np.minimum.at(out, rows * size + place, value)
        pending = np.unique(rows)
        open_rows = np.zeros(texts, bool)
        open_rows[pending] = (out.reshape(texts, size)[pending] == np.iinfo(np.uint64).max).any(axis=1)
        active = open_rows[rows]
        if not active.any():
            break
        if not active.all():
            state, rows = state[active], rows[active]
            swaps = [s[active] for s in swaps]
            order = order[active] if order is not None else None
        if order is None and rank + 1 >= 6:
            order = np.tile(np.arange(size, dtype=np.uint16), (len(state), 1))
            every = np.arange(len(state))
            for done, swap in enumerate(swaps):
                moved = order[every, swap]
                order[every, swap] = order[:, done]
                order[:, done] = moved
            swaps = []
    return out.reshape(texts, size)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band of each signature; equal bands at different places have different keys."""
    texts, size = signature.shape
    rows = size // bands
    parts = signature[:, : bands * rows].reshape(texts, bands, rows)
    keys = np.zeros((texts, bands), np.uint64)
    for place in range(rows):
        keys = mix64(keys + parts[:, :, place] + _U((place + 1) * 0xD1342543DE82EF95 % (1 << 64)))
    return mix64(keys + np.arange(1, bands + 1, dtype=np.uint64)[None, :] * _U(0x9E3779B97F4A7C15))
