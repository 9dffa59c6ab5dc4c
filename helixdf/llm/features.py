"""Hashed word features of texts, and linear models over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import LOWER_BYTES, _BYTE_CODE, _inv_pow, _pow, mix64, word_hashes
from .shingles import chunks, text_bytes

BITS = 20


def word_features(texts: list[bytes], bits: int = BITS, heads: tuple[int, ...] = (4, 6)) -> Iterator[np.ndarray]:
    """Of each text the distinct hashed features: its words (A-Z lower-cased) and the
    words' first bytes."""
    mask = np.uint64((1 << bits) - 1)
    for low, high in chunks(texts):
        data = b" ".join(texts[low:high]).translate(LOWER_BYTES)
        h, starts, ends = word_hashes(data)
        at = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts[low:high]]))
        b = np.frombuffer(data, dtype=np.uint8)
        acc = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[b] * _pow(len(b)), out=acc[1:])
        kinds = [h & mask]
        for k in heads:
            cut = np.minimum(starts + k, ends)
            kinds.append(mix64((acc[cut] - acc[starts]) * _inv_pow(len(b))[starts] + np.uint64(1000 + k)) & mask)
        f = np.stack(kinds, axis=1).astype(np.int32) if len(h) else np.zeros((0, len(kinds)), dtype=np.int32)
        for a, z in zip(at[:-1].tolist(), at[1:].tolist()):
            x = np.sort(f[a:z].ravel())
            yield x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) else x


def feature_rows(bits: int = BITS):
    """mapInArrow function: the last column (text) becomes its features."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f = pa.array(list(word_features(text_bytes(batch.column(batch.num_columns - 1)), bits)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], f], [*batch.schema.names[:-1], "features"])
    return each


def linear_scores(model, bits: int = BITS):
    """mapInArrow function: the last column (text) becomes its score, the logistic function
    of the bias and the weights of its features."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights = model.value
        for batch in batches:
            z = [bias + float(weights[f].sum(dtype=np.float64)) for f in word_features(text_bytes(batch.column(batch.num_columns - 1)), bits)]
            score = 1 / (1 + np.exp(-np.clip(np.array(z, dtype=np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score, pa.float64())], [*batch.schema.names[:-1], "score"])
    return each


def row_arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as views of its buffers."""
    out = []
    for chunk in column.chunks:
        at, flat = chunk.offsets.to_numpy().tolist(), chunk.values.to_numpy()
        out += [flat[a:z] for a, z in zip(at[:-1], at[1:])]
    return out


class Rows:
    """Sparse rows of features with the columns that occur in ``least`` rows or more and,
    given ``groups`` (booleans), that differ between the two groups of rows by ``apart``
    standard errors or more."""

    def __init__(self, rows: list[np.ndarray], least: int = 3, bits: int = BITS, groups: np.ndarray | None = None, apart: float = 3.0):
        size = np.array([len(r) for r in rows], dtype=np.int64)
        blocks = list(self._blocks(size))
        n, in_one = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)
        for a, z in blocks:
            flat = np.concatenate(rows[a:z])
            n += np.bincount(flat, minlength=1 << bits)
            if groups is not None:
                in_one += np.bincount(flat[np.repeat(groups[a:z], size[a:z])], minlength=1 << bits)
        use = n >= least
        if groups is not None:
            one, two = max(int(groups.sum()), 1), max(int((~groups).sum()), 1)
            rate = (n + 1) / (len(rows) + 2)
            use &= np.abs(in_one / one - (n - in_one) / two) >= apart * np.sqrt(rate * (1 - rate) * (1 / one + 1 / two))
        self.used = np.flatnonzero(use)
        place = np.full(1 << bits, -1, dtype=np.int32)
        place[self.used] = np.arange(len(self.used))
        cols, at = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int32)]
        for a, z in blocks:
            col = place[np.concatenate(rows[a:z])]
            cols.append(col[col >= 0])
            at.append(np.repeat(np.arange(a, z, dtype=np.int32), size[a:z])[col >= 0])
        self.col, self.row, self.n = np.concatenate(cols), np.concatenate(at), len(rows)

    @staticmethod
    def _blocks(size: np.ndarray, most: int = 1 << 19) -> Iterator[tuple[int, int]]:
        """Ranges of rows with about ``most`` features together, so that copies stay small."""
        low, held = 0, 0
        for i, k in enumerate(size.tolist()):
            if i > low and held + k > most:
                yield low, i
                low, held = i, 0
            held += k
        if low < len(size):
            yield low, len(size)

    def score(self, w: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(self.row, weights=w[self.col], minlength=self.n)

    def gradient(self, g: np.ndarray) -> tuple[np.ndarray, float]:
        return np.bincount(self.col, weights=g[self.row], minlength=len(self.used)), float(g.sum())


def fit(rows: Rows, slope, steps: int, rate: float, decay: float, bias: float = 0.0, bits: int = BITS) -> tuple[float, np.ndarray]:
    """Adam with full gradients; ``slope(scores)`` is the risk's gradient by score."""
    w, b = np.zeros(len(rows.used)), bias
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        gw, gb = rows.gradient(slope(rows.score(w, b)))
        g = np.append(gw + decay * w, gb)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    out = np.zeros(1 << bits, dtype=np.float32)
    out[rows.used] = w
    return float(b), out
