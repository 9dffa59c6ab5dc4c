"""Depth per locus from per-tile count vectors.

A task walks the aligned blocks of a batch of reads with numpy (each distinct CIGAR is read
once) and adds up bases per cell (contig, locus, base code). It hands on one row per tile of
``TILE`` loci: the cells that are not zero with their counts, packed into 4 bytes each. So the
shuffle carries a row per covered tile and buffer, not one per base, and a deep tile is no
larger than its 5 x ``TILE`` cells. After the shuffle a task reads its tiles in order, adds up
equal cells, and gives a row per covered locus; it holds one batch and one open tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flags as fl
from .blocks import batch_blocks, runs
from .reference import flat

TILE_SHIFT = 12
TILE = 1 << TILE_SHIFT
#: Bases that a task adds up before it hands rows on.
CELLS = 1 << 22
#: Loci in a batch of the result.
ROWS = 1 << 17
#: Base codes: A 0, C 1, G 2, T 3, any other 4.
CODES = np.full(256, 4, dtype=np.int64)
for _i, _b in enumerate(b"ACGT"):
    CODES[[_b, _b + 32]] = _i
_LOCUS_BITS = 36
#: Largest count that a packed cell holds; larger ones take several.
_MOST = 0xFFFF

_VECTOR = "ref_index int, tile long, cells binary"
_DEPTH = "ref_index int, pos int, depth long, n_a long, n_c long, n_g long, n_t long, n_n long"


def _added(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order and the sums of their counts."""
    if not len(cells):
        return cells, counts
    order = np.argsort(cells, kind="stable")
    cells, counts = cells[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
    return cells[first], np.add.reduceat(counts, first)


def _counted(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order and how often each occurs."""
    cells = np.sort(cells)
    first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1]))) if len(cells) else np.zeros(0, dtype=np.int64)
    return cells[first], np.diff(np.append(first, len(cells)))


def _packed(cells: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells with their counts in the low 16 bits, and how many packed cells each takes."""
    times = (counts + _MOST - 1) // _MOST
    if (times == 1).all():
        return (cells << 16) | counts, times
    last = np.cumsum(times) - 1
    out = (np.repeat(cells, times) << 16) | _MOST
    out[last] = (cells << 16) | (counts - (times - 1) * _MOST)
    return out, times


def _block_cells(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Cells of the bases of reads (contig, first locus, CIGAR, bases), some reads at a time."""
    for k in range(4):
        if batch.column(k).null_count:
            batch = batch.filter(pc.is_valid(batch.column(k)))
    data, at = flat(batch.column(3))
    code = CODES[data]
    row, begin, first, size = batch_blocks(batch.column(2), batch.column(1).to_numpy())
    size = np.clip(at[1:][row] - at[:-1][row] - begin, 0, size)  # no more than the sequence has
    begin, ref = begin + at[:-1][row], (batch.column(0).to_numpy().astype(np.int64)[row] + 1) << _LOCUS_BITS
    total = np.cumsum(size)
    low = 0
    while low < len(size):
        done = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, done + CELLS, "right")))
        part, n = slice(low, high), size[low:high]
        where = np.repeat(ref[part] + first[part], n) + runs(n)
        yield (where << 3) + code[np.repeat(begin[part], n) + runs(n)]
        low = high


def _vectors(cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row per tile of cells in order."""
    tile = cells >> (TILE_SHIFT + 3)
    new = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1])))
    packed, times = _packed(cells & (8 * TILE - 1), counts)
    at = np.append(np.concatenate(([0], np.cumsum(times)))[new], len(packed)) * 4
    blobs = pa.Array.from_buffers(pa.binary(), len(new), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(packed.astype(np.uint32))])
    where = tile[new]
    ref = where >> (_LOCUS_BITS - TILE_SHIFT)
    return pa.RecordBatch.from_arrays([pa.array((ref - 1).astype(np.int32)), pa.array(where - (ref << (_LOCUS_BITS - TILE_SHIFT))), blobs],
                                      ["ref_index", "tile", "cells"])


def _piled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    waiting, n_waiting = [], 0
    for batch in batches:
        for more in _block_cells(batch):
            waiting.append(more)
            n_waiting += len(more)
            if n_waiting >= CELLS:
                more, n = _counted(np.concatenate(waiting))
                waiting, n_waiting = [], 0
                cells, counts = _added(np.concatenate((cells, more)), np.concatenate((counts, n))) if len(cells) else (more, n)
                if len(cells) >= CELLS // 2:  # little to add up here: hand on
                    yield _vectors(cells, counts)
                    cells, counts = cells[:0], counts[:0]
    more, n = _counted(np.concatenate([cells[:0], *waiting]))
    cells, counts = _added(np.concatenate((cells, more)), np.concatenate((counts, n))) if len(cells) else (more, n)
    if len(cells):
        yield _vectors(cells, counts)


def _depths(where: np.ndarray, code: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row per locus of cells in order."""
    new = np.concatenate(([True], where[1:] != where[:-1]))
    row, at = np.cumsum(new) - 1, where[new]
    by = np.zeros((5, len(at)), dtype=np.int64)
    by[code, row] = counts
    columns = [pa.array(((at >> _LOCUS_BITS) - 1).astype(np.int32)), pa.array(at & ((1 << _LOCUS_BITS) - 1)).cast(pa.int32()),
               pa.array(by.sum(axis=0)), *[pa.array(b) for b in by]]
    rows = pa.RecordBatch.from_arrays(columns, ["ref_index", "pos", "depth", "n_a", "n_c", "n_g", "n_t", "n_n"])
    for low in range(0, len(at), ROWS):
        yield rows.slice(low, ROWS)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of vectors in order of their tile: the depths of every tile. The last tile of a batch waits."""
    open_tile, open_cells = -1, np.zeros(0, dtype=np.int64)
    for batch in batches:
        if not len(batch):
            continue
        ref, tile = (batch.column(k).to_numpy().astype(np.int64) for k in (0, 1))
        blobs = batch.column(2)
        at = np.frombuffer(blobs.buffers()[1], dtype=np.int32)[blobs.offset:blobs.offset + len(blobs) + 1]
        packed = np.frombuffer(blobs.buffers()[2], dtype=np.uint8)[at[0]:at[-1]].view(np.uint32).astype(np.int64)
        tiles = np.append(open_tile, ((ref + 1) << (_LOCUS_BITS - TILE_SHIFT)) + tile)
        size = np.append(len(open_cells), np.diff(at) // 4)
        # tiles of the batch by number, so that number, cell and count fit one sortable value
        new = np.concatenate(([False], tiles[1:] != tiles[:-1]))
        number = np.cumsum(new)
        key = np.sort((np.repeat(number, size) << 32) | np.concatenate((open_cells, packed)))
        cells = key >> 16
        first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        cells, counts = cells[first], np.add.reduceat(key & _MOST, first)
        last = int(np.searchsorted(cells, int(number[-1]) << 16))
        yield from _tile_depths(np.append(tiles[0], tiles[new]), cells[:last], counts[:last])
        open_tile, open_cells = int(tiles[-1]), _packed(cells[last:] & _MOST, counts[last:])[0]
    if len(open_cells):
        yield from _tile_depths(np.array([open_tile]), *_added(open_cells >> 16, open_cells & _MOST))


def _tile_depths(tiles: np.ndarray, cells: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(cells):
        where = (tiles[cells >> 16] << TILE_SHIFT) + ((cells & _MOST) >> 3)
        yield from _depths(where, cells & 7, counts)


def locus_depth(reads: DataFrame) -> DataFrame:
    """Per (contig, locus) that a mapped read's aligned block covers: depth and the number of
    A, C, G, T and other bases. A block past the end of its sequence covers what bases there are."""
    mapped = reads.filter(fl.is_mapped("flag")).select("ref_index", "pos", "cigar", "seq")
    tiles = mapped.mapInArrow(_piled, _VECTOR)
    return tiles.repartition("ref_index", "tile").sortWithinPartitions("ref_index", "tile").mapInArrow(_merged, _DEPTH)
