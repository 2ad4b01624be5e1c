"""SuperMinHash signatures of sets of 64-bit hashes.

Each element draws, from its hash alone, a random permutation of the signature's
places and a random fraction for each; at step j it offers ``j + fraction`` to
its j-th place, and a place keeps the smallest offer. Offers of later steps are
larger than all of earlier ones, so a set is done at the first step before which
all its places hold something: large sets after one step, small ones after a few.
All sets of a block take their steps together. Values are integers, the step in
the high bits; two sets agree at a place with their Jaccard similarity as
probability, with less variance than independent minima.
"""

from __future__ import annotations

import numpy as np

from kimberlite.llm.words import mix

_FRACTION_BITS = np.uint64(40)
_EMPTY = np.uint64(2**64 - 1)
#: Permutations are kept for so many elements at a time.
_ELEMENTS = 1 << 15


def _draws(elements: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit numbers of each element for a step."""
    one = mix(elements + np.uint64((2 * step + 1) * 0xD1B54A32D192ED03 % 2**64))
    return one, mix(one ^ np.uint64(0x8CB92BA72F3D8DD7))


def _offer(signature: np.ndarray, row: np.ndarray, place: np.ndarray, step: int, draw: np.ndarray) -> None:
    value = (np.uint64(step) << _FRACTION_BITS) | (draw >> (np.uint64(64) - _FRACTION_BITS))
    np.minimum.at(signature.ravel(), row * signature.shape[1] + place, value)


def signatures(elements: np.ndarray, sizes: np.ndarray, places: int) -> np.ndarray:
    """One row of ``places`` values per set; ``elements`` holds the sets in turn.

    An empty set's row is all ones. Elements are distinct within a set; repeats
    would change nothing.
    """
    out = np.full((len(sizes), places), _EMPTY)
    if not len(elements):
        return out
    row = np.repeat(np.arange(len(sizes)), sizes)
    fraction, choice = _draws(elements, 0)
    first = (choice % np.uint64(places)).astype(np.int64)
    _offer(out, row, first, 0, fraction)
    todo = np.flatnonzero((out.max(axis=1) == _EMPTY) & (sizes > 0))
    ends = np.cumsum(sizes)
    while len(todo):
        upto = max(1, int(np.searchsorted(np.cumsum(sizes[todo]), _ELEMENTS, side="right")))
        some, todo = todo[:upto], todo[upto:]
        pick = np.concatenate([np.arange(ends[i] - sizes[i], ends[i]) for i in some])
        out[some] = _finish(out[some], elements[pick], sizes[some], first[pick])
    return out


def _finish(signature: np.ndarray, elements: np.ndarray, sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The steps after the first."""
    places = signature.shape[1]
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.tile(np.arange(places, dtype=np.uint16), (len(elements), 1))
    at = np.arange(len(elements))
    order[at, first], order[:, 0] = 0, first
    for step in range(1, places):
        open_rows = signature.max(axis=1) >= np.uint64(step) << _FRACTION_BITS
        keep = open_rows[row[at]]
        if not keep.any():
            break
        at = at[keep]
        fraction, choice = _draws(elements[at], step)
        swap = step + (choice % np.uint64(places - step)).astype(np.int64)
        place = order[at, swap]
        order[at, swap] = order[at, step]
        order[at, step] = place
        _offer(signature, row[at], place.astype(np.int64), step, fraction)
    return signature


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per row and band of ``places / bands`` values, distinct between bands."""
    rows = signature.shape[1] // bands
    parts = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25), parts.shape[:2])
    for j in range(rows):
        keys = mix(keys ^ parts[:, :, j]) + np.uint64(j)
    return keys
