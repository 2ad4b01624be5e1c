"""Words of many texts at once, as positions and 64-bit hashes.

The texts of an Arrow batch are laid side by side in one byte array, a line end
before and after each. Every character that separates words is ASCII, so bytes
decide as characters would. Words are hashed by a polynomial over their bytes,
read from prefix sums, in which A-Z count as a-z; no text is copied or lowered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))

#: Blocks of texts end at this many bytes; a longer text is a block of its own.
BLOCK_BYTES = 1 << 19


def _table(pattern_excluded: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in pattern_excluded:
        table[low : high + 1] = False
    return table


#: Bytes of words ``[^\x20\x09-\x0D]+``.
BLANK_SEPARATED = _table([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of lines.
NO_LINE_END = _table([(0x0A, 0x0A)])
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lowered.
ALPHANUMERIC = _table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_EXACT = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_FOLDED = _EXACT.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _EXACT[ord("a") : ord("z") + 1]
#: Bytes with A-Z as a-z, and as they are.
FOLDED = np.arange(256, dtype=np.uint64)
FOLDED[ord("A") : ord("Z") + 1] += np.uint64(32)
EXACT = np.arange(256, dtype=np.uint64)
_SALT = np.uint64(0xD1B54A32D192ED03)
#: Values that ``placed`` works on at once.
_STEP = 1 << 20
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def power(which: str, n: int) -> np.ndarray:
    """The first powers of the base ("up") or of its inverse ("down")."""
    held = _powers[which]
    if len(held) < n:
        base = _BASE if which == "up" else _INVERSE
        held = np.full(n, base, np.uint64)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if n <= 4 * BLOCK_BYTES:
            _powers[which] = held
    return held[:n]


@dataclass
class Words:
    """Words of ``n_docs`` texts: bytes ``data[start:end]``, the text's number, the hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # per text, its first word; n_docs + 1 values
    base: np.ndarray  # per text, where it begins in data

    @property
    def n_docs(self) -> int:
        return len(self.first) - 1


def words_of(
    texts: list[bytes], word_bytes: np.ndarray, kinds: np.ndarray | None = None, exact: bool = False
) -> Words:
    """The runs of ``word_bytes``; with ``kinds``, also cut between bytes of kinds 1 and 2.

    With ``exact``, hashes tell A-Z from a-z.
    """
    data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    base = np.cumsum(lengths + 1) - lengths
    inside = word_bytes[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edges[0::2], edges[1::2]
    if kinds is not None:
        kind = kinds[data]
        cuts = np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1
        start, end = np.sort(np.append(start, cuts)), np.sort(np.append(end, cuts))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_EXACT if exact else _FOLDED)[data] * power("up", len(data)), out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * power("down", len(data))[start])
    first = np.searchsorted(start, np.append(base, len(data)))
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, start, end, doc, hashes, first, base)


def blocks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, list[bytes]]]:
    """Row number of the first text, and texts, of blocks of bounded size; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts, begun, size = [], 0, 0
    for i, value in enumerate(column.cast(pa.large_binary())):
        text = value.as_py() or b""
        if texts and size + len(text) > BLOCK_BYTES:
            yield begun, texts
            texts, begun, size = [], i, 0
        texts.append(text)
        size += len(text) + 1
    if texts:
        yield begun, texts


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words, across texts too; ``len(hashes) - n + 1`` values."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.full(count, np.uint64(n))
    for j in range(n):
        out = out * _BASE + hashes[j : j + count]
    return mix(out)


def starts_inside(words: Words, n: int) -> np.ndarray:
    """Whether the run of ``n`` words from each word stays in its text; as long as ``grams``."""
    count = len(words.doc) - n + 1
    if count <= 0:
        return np.empty(0, bool)
    return words.doc[:count] == words.doc[n - 1 :]


def stretches(hashes: np.ndarray, first: np.ndarray, beyond: np.ndarray) -> np.ndarray:
    """Hash of the words from ``first`` up to ``beyond``, for stretches of any length."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power("up", len(hashes)), out=sums[1:])
    return mix((sums[beyond] - sums[first]) * power("down", len(hashes) + 1)[first])


def placed(values: np.ndarray, first: np.ndarray, beyond: np.ndarray, codes: np.ndarray | None = None) -> np.ndarray:
    """Another hash of the values from ``first`` up to ``beyond``, which shares nothing with ``stretches``.

    The sum, over the values (their ``codes``, if given), of a mix of the value
    and its place. Stretches may overlap.
    """
    lengths = beyond - first
    edges = np.concatenate([[0], np.cumsum(lengths)])
    out = np.zeros(len(first), np.uint64)
    for a in range(0, int(edges[-1]), _STEP):
        b = min(a + _STEP, int(edges[-1]))
        low, high = np.searchsorted(edges, a, "right") - 1, np.searchsorted(edges, b, "left")
        begin, end = np.maximum(edges[low:high], a), np.minimum(edges[low + 1 : high + 1], b)
        at = np.arange(a, b) - np.repeat(edges[low:high], end - begin)
        value = values[np.repeat(first[low:high], end - begin) + at]
        cells = mix((value if codes is None else codes[value]) ^ mix(at.astype(np.uint64) + _SALT))
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(cells, out=sums[1:])
        out[low:high] += sums[end - a] - sums[begin - a]
    return mix(out ^ mix(lengths.astype(np.uint64)))
