"""Word shingles of many texts at once, as sorted sets of 64-bit hashes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import LOWER_BYTES, mix64, word_hashes

SIZE = 5
#: Bytes of text hashed together.
CHUNK = 1 << 20
_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def chunks(texts: list[bytes], most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes together (a longer text is alone)."""
    low, size = 0, 0
    for i, t in enumerate(texts):
        if i > low and size + len(t) > most:
            yield low, i
            low, size = i, 0
        size += len(t) + 1
    if low < len(texts):
        yield low, len(texts)


def _pieces(data: bytes, most: int) -> Iterator[bytes]:
    """A text cut at separators into pieces of about ``most`` bytes (a longer word stays whole)."""
    low = 0
    while len(data) - low > 2 * most:
        found = _SEPARATOR.search(data, low + most)
        if found is None:
            break
        yield data[low:found.start()]
        low = found.start()
    yield data[low:]


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of texts (A-Z lower-cased), and where each text's words begin (and the end)."""
    data = b" ".join(texts).translate(LOWER_BYTES)
    if len(texts) == 1:  # a long text is hashed piece by piece
        h = [word_hashes(p)[0] for p in _pieces(data, CHUNK)]
        return np.concatenate(h), np.array([0, sum(map(len, h))])
    h, starts, _ = word_hashes(data)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return h, np.searchsorted(starts, begin)


def shingle_chunks(texts: list[bytes], size: int = SIZE, most: int = CHUNK) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Distinct shingle hashes of each text, ascending: of ``size`` words, or the whole
    sequence of a shorter text; none without words. Some texts at once (about ``most`` bytes):
    the first one's number and their sets."""
    for low, high in chunks(texts, most):
        w, at = words_of(texts[low:high])
        n = len(w) - size + 1
        s = sum((w[k:k + n] * _STEP[k % len(_STEP)] for k in range(size)), np.zeros(max(n, 0), dtype=np.uint64)) if n > 0 else w[:0]
        s = mix64(s)
        out: list[np.ndarray] = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= size:
                x = np.sort(s[a:b - size + 1])
                out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
            elif b > a:
                whole = sum((w[a + k:a + k + 1] * _STEP[k % len(_STEP)] for k in range(b - a)), np.full(1, b - a, dtype=np.uint64))
                out.append(mix64(whole))
            else:
                out.append(w[:0])
        yield low, out


def shingle_sets(texts: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """The sets of all texts at once."""
    return [s for _, sets in shingle_chunks(texts, size) for s in sets]
