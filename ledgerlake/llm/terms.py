"""Terms of whole texts as exact strings, counted in slices of bounded size."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa

#: Over UTF-8 bytes whose A-Z are lower-cased: digits, letters and all beyond ASCII; the same without digits.
ALNUM = re.compile(rb"[0-9a-z\x80-\xff]+")
LETTERS = re.compile(rb"[a-z\x80-\xff]+")
_NONE = re.compile(rb"[^0-9a-z\x80-\xff]")


def _slices(data: bytes, size: int) -> Iterator[bytes]:
    """data in slices of at least `size` bytes that end where no term can."""
    at = 0
    while at < len(data):
        end = len(data) if at + size >= len(data) else (m.end() if (m := _NONE.search(data, at + size)) else len(data))
        yield data[at:end] if at or end < len(data) else data
        at = end


def count_terms(text: pa.Scalar, pattern: re.Pattern[bytes], size: int = 1 << 20) -> Counter[bytes]:
    """Occurrences of each term of a string scalar; only A-Z are lower-cased. Null has none."""
    out: Counter[bytes] = Counter()
    data = text.as_buffer()
    if data is not None:
        for part in _slices(data.to_pybytes().lower(), size):
            out.update(pattern.findall(part))
    return out


def strings(terms: list[bytes]) -> pa.Array:
    """A string array of UTF-8 bytes, taken as they are."""
    return pa.array(terms, pa.binary()).view(pa.string())
