"""CIGAR walks over whole Arrow batches: each distinct CIGAR of a batch is read once."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions import cigar as cg

_RUN = re.compile("([0-9]+)([MIDNSHP=X])")
_INT_MAX = (1 << 31) - 1


def runs(size: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each n of ``size``, one after another."""
    end = np.cumsum(size)
    return np.arange(int(end[-1]) if len(end) else 0) - np.repeat(end - size, size)


def elements(text: str | None) -> list[tuple[int, str]]:
    """Runs (length, operator) of a CIGAR, as ``functions.cigar.elements``."""
    found = [(int(n), op) for n, op in _RUN.findall(text or "")]
    if any(n > _INT_MAX for n, _ in found):
        raise ValueError(f"a run of CIGAR {text!r} is longer than {_INT_MAX}")
    return found


def _blocks(text: str | None) -> list[tuple[int, int, int]]:
    """Aligned runs: read and reference bases before it, and its length."""
    read, ref, out = 0, 0, []
    for n, op in elements(text):
        if op in cg.ALIGNS and n:
            out.append((read, ref, n))
        read += n if op in cg.CONSUMES_READ else 0
        ref += n if op in cg.CONSUMES_REF else 0
    return out


_LEAD, _TRAIL = re.compile("^([0-9]+[SH])+"), re.compile("([0-9]+[SH])+$")


def clips_and_span(text: str | None) -> tuple[int, int, int]:
    """Leading clip, reference bases and trailing clip of a CIGAR (``functions.cigar``)."""
    lead, trail = (sum(n for n, _ in elements(m.group())) if (m := r.search(text or "")) else 0 for r in (_LEAD, _TRAIL))
    return lead, sum(n for n, op in elements(text) if op in cg.CONSUMES_REF), trail


def distinct(column: pa.Array) -> tuple[list[str | None], np.ndarray]:
    """The distinct texts of a column and each row's place among them."""
    coded = pc.dictionary_encode(column, null_encoding="encode")
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def batch_blocks(cigars: pa.Array, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Aligned blocks of reads: row, read bases before the block (0-based read offset), first
    locus and length. Blocks without a base are left out."""
    texts, which = distinct(cigars)
    own = [_blocks(t) for t in texts]
    many = np.array([len(b) for b in own], dtype=np.int64)
    table = np.array([x for b in own for x in b], dtype=np.int64).reshape(-1, 3)
    row = np.repeat(np.arange(len(which)), many[which])
    k = np.repeat((np.cumsum(many) - many)[which], many[which]) + runs(many[which])
    return row, table[k, 0], table[k, 1] + pos.astype(np.int64)[row], table[k, 2]
