"""Words of whole texts as 64-bit hashes, computed with numpy over the UTF-8 bytes of one text at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

#: Separators of words: white space only, and everything but digits, a-z and bytes of non-ASCII characters.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True


def give_back() -> None:
    """Gives memory that is free again back to the system: Arrow's pool, and the heap where the C library can.

    Spark uses a Python worker again for other tasks; what a batch has needed once would stay with it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The rows of batches in small ones, so that what is made of them stays small too; free memory goes back after each batch."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)
        give_back()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64; kept up to a million."""
    have = _POWERS.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = out[0], out[1]
        if size <= 1 << 20:
            _POWERS[0] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that low and high bits are alike."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of each word of a text whose A-Z are lower-cased; three empty arrays without words."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = ~separators[b]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    power, inverse = _powers(len(b))
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * power, out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts, ends


def sequence_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; of the whole sequence if it is shorter; none without words."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = mix(words[: len(words) - size + 1] + np.uint64(size))
    for k in range(1, size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - size + 1 + k])
    return out
