"""Recalibrated qualities of whole batches of reads.

The delta rows (one per read group, bounded by ``preprocess.DELTA_BYTES``) are sent to the
workers once. numpy then looks up the deltas of all bases of a batch: no lambda per base.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bases as bs
from ..functions import flags as fl
from .reference import UPPER, flat

#: Base codes: A 0, C 1, G 2, T 3, any other 4; and those of the complement.
CODES = np.full(256, 4, dtype=np.int64)
CODES[np.frombuffer(b"ACGT", dtype=np.uint8)] = np.arange(4)
COMPLEMENT = np.array([3, 2, 1, 0, 4], dtype=np.int64)
#: Contexts: 5 x 5 codes.
N_CONTEXTS = 25


def _tables(deltas: DataFrame, rg: str) -> dict:
    """Read group -> (global delta, deltas by quality, by quality and cycle, by quality and context, cycles)."""
    table = deltas.select(rg, "d_rg", "a_q", "a_cycle", "a_ctx", "cycle_width").toArrow()
    out = {}
    for i in range(table.num_rows):
        row = {name: table[name][i] for name in table.column_names}
        arrays = [row[name].values.to_numpy(zero_copy_only=False) if row[name].is_valid else np.zeros(0) for name in ("a_q", "a_cycle", "a_ctx")]
        out[row[rg].as_py()] = (row["d_rg"].as_py() or 0.0, *arrays, row["cycle_width"].as_py())
    return out


def _at(table: np.ndarray, index: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Cells of a table; 0 where it has none."""
    ok = use & (index >= 0) & (index < len(table))
    out = np.zeros(len(index))
    out[ok] = table[index[ok]]
    return out


def _group(table: tuple, q: np.ndarray, cycle: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Sums of a base's quality and deltas; a negative cycle or context stands for none."""
    d_rg, a_q, a_cycle, a_ctx, width = table
    total = q + d_rg + _at(a_q, q, q >= 0) + _at(a_cycle, q * width + cycle, (cycle >= 0) & (cycle < width))
    return total + _at(a_ctx, q * N_CONTEXTS + context, context >= 0)


def recalibrated(groups: pa.Array, seq: pa.Array, qual: pa.Array, back: np.ndarray, tables: dict) -> pa.Array:
    """New qualities of reads: null where a quality is no character 33..126, empty for ``*``.
    A base past the end of the sequence has neither cycle nor context."""
    raw = qual.cast(pa.large_binary())
    n_rows = len(raw)
    if not n_rows or raw.buffers()[2] is None:
        data, at = np.zeros(0, dtype=np.uint8), np.zeros(n_rows + 1, dtype=np.int64)
    else:
        at = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + n_rows + 1]
        data = np.frombuffer(raw.buffers()[2], dtype=np.uint8)[at[0]:at[-1]]
        at = at - at[0]
    size = np.diff(at)
    row = np.repeat(np.arange(n_rows), size)
    valid = pc.is_valid(qual).to_numpy(zero_copy_only=False)
    valid[row[(data < bs.PHRED_OFFSET) | (data > bs.MAX_PHRED + bs.PHRED_OFFSET)]] = False
    one = np.flatnonzero(size == 1)
    absent = np.zeros(n_rows, dtype=bool)
    absent[one] = data[at[one]] == ord("*")
    keep = (valid & ~absent)[row]
    size = np.where(valid & ~absent, size, 0)

    bases, seq_at = flat(seq)
    code = CODES[UPPER[bases]]
    length = np.diff(seq_at)
    row, q, i = row[keep], data[keep].astype(np.int64) - bs.PHRED_OFFSET, (np.arange(len(data)) - np.repeat(at[:-1], np.diff(at)))[keep]
    n, neg = length[row], back[row]
    there = i < n
    cycle = np.where(there, np.where(neg, n - i, i + 1), -1)
    other = np.where(neg, i + 1, i - 1)
    both = there & (other >= 0) & (other < n)
    context = np.full(len(row), -1, dtype=np.int64)
    own, near = code[(seq_at[row] + i)[both]], code[(seq_at[row] + other)[both]]
    context[both] = np.where(neg[both], COMPLEMENT[near] * 5 + COMPLEMENT[own], near * 5 + own)

    total = q.astype(np.float64)
    kinds = pc.dictionary_encode(groups)
    kind = pc.fill_null(kinds.indices, -1).to_numpy(zero_copy_only=False)[row]
    for k, name in enumerate(kinds.dictionary.to_pylist()):
        if name in tables:
            mine = kind == k
            total[mine] = _group(tables[name], q[mine], cycle[mine], context[mine])
    new = np.clip(np.floor(total + 0.5), 1, bs.MAX_PHRED).astype(np.uint8) + bs.PHRED_OFFSET
    ends = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
    bits = pa.array(valid).buffers()[1]
    return pa.Array.from_buffers(pa.large_utf8(), n_rows, [bits, pa.py_buffer(ends), pa.py_buffer(new.astype(np.uint8))])


def recalibrate(reads: DataFrame, deltas: DataFrame, rg: str) -> DataFrame:
    """``reads`` with recalibrated ``qual`` (see ``preprocess.bqsr_apply``)."""
    held = reads.sparkSession.sparkContext.broadcast(_tables(deltas, rg))
    columns = reads.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            back = batch.column("_neg").to_numpy(zero_copy_only=False).astype(bool)
            qual = recalibrated(batch.column(rg), batch.column("seq"), batch.column("qual"), back, held.value)
            kept = [qual.cast(batch.schema.field(c).type) if c == "qual" else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(kept, names=columns)

    out = T.StructType([T.StructField(f.name, f.dataType) for f in reads.schema.fields])
    return reads.withColumn("_neg", F.coalesce(fl.has("flag", fl.REVERSE), F.lit(False))).mapInArrow(run, out)
