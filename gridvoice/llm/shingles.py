"""Word and shingle hashes of whole texts, computed on the bytes of an Arrow batch.

A word is a run of bytes that are not separators. A batch of texts is handled as one
byte array, so the cost per word is a handful of vector operations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])

_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_BLOCK = 1 << 16


def symbol_values(size: int) -> np.ndarray:
    return np.random.default_rng(0xA1FA).integers(1, 2**63, size, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, _BLOCK), _powers(_UNBASE, _BLOCK)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row and the n + 1 offsets. A null has no bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return raw, offsets - offsets[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    """A-Z in lower case; every other byte as it is."""
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)


def words(raw: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each text (n + 1 positions)."""
    inside = ~separator[raw]
    opens, closes = inside.copy(), inside.copy()
    if len(raw):
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        at = offsets[1:-1]
        at = at[(at > 0) & (at < len(raw))]
        opens[at] |= inside[at]
        closes[at - 1] |= inside[at - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = _BYTE) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same wherever the word stands.

    ``values`` has a random odd number for each symbol; ``symbol_values`` makes it for other symbols than bytes.
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    scale_up, scale_down = np.uint64(1), np.uint64(1)
    down = np.empty(len(starts), np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        for at in range(0, len(raw), _BLOCK):
            part = raw[at : at + _BLOCK]
            total[at + 1 : at + 1 + len(part)] = values[part] * (_UP[: len(part)] * scale_up)
            last = np.searchsorted(starts, at + len(part))
            down[first:last] = _DOWN[starts[first:last] - at] * scale_down
            first = last
            scale_up = scale_up * _UP[-1] * _BASE
            scale_down = scale_down * _DOWN[-1] * _UNBASE
        np.cumsum(total, out=total)
        return mix((total[ends] - total[starts]) * down + (ends - starts).astype(np.uint64))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words; the whole sequence if it is shorter, nothing if empty."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(width, n)
    total = np.zeros(n - width + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            total = mix(total + hashes[k : n - width + 1 + k] + np.uint64(k + 1) * _BASE)
    return total
