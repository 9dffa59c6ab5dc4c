"""Covariates of base quality recalibration, counted by segments.

A segment of a read (``reference.segments``) carries its bases with one neighbour on each
side, its qualities and the read's length, and meets its chunk of the reference and that
chunk's known sites in one join. numpy then counts (read group, quality, cycle, context)
over a whole batch, so that bases become rows neither in the plan nor in a shuffle.
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
from .blocks import runs
from .reference import ABSENT, CHUNK, CHUNK_SHIFT, GAP, UPPER, blobs, chunks, flat, octets, parts, reference_bases, segments, unpacked_bases, with_reference

COMPLEMENT = np.arange(256, dtype=np.uint8)
COMPLEMENT[np.frombuffer(b"ACGT", dtype=np.uint8)] = np.frombuffer(b"TGCA", dtype=np.uint8)


def _counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The distinct covariates of a batch of segments with their counts."""
    (wide, wide_at), (qual, at), (ref, _) = (flat(batch.column(name)) for name in ("read_cut", "qual_cut", "ref_cut"))
    size = np.diff(at)
    wide, ref = UPPER[wide], UPPER[ref]
    column = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("neg", "n", "seg_read", "seg_ref")}
    spread = {name: np.repeat(values.astype(np.int64), size) for name, values in column.items()}
    k = np.arange(len(qual)) - np.repeat(at[:-1], size)
    offset = spread["seg_read"] + k
    own = np.repeat(wide_at[:-1], size) + k + 1
    base, before, after = wide[own], wide[own - 1], wide[own + 1]
    back = spread["neg"] == 1
    value = qual.astype(np.int64) - bs.PHRED_OFFSET
    use = (ref != ord(GAP)) & (base != ord("N")) & (base != ord(ABSENT)) & (value >= 0)
    known = batch.column("known")
    sites = known.flatten().to_numpy(zero_copy_only=False)
    row = pc.list_parent_indices(known).to_numpy(zero_copy_only=False)
    if len(sites):
        use[at[row] + (sites.astype(np.int64) - column["seg_ref"].astype(np.int64)[row])] = False

    cycle = np.where(back, spread["n"] - offset + 1, offset)
    context = np.where(back, COMPLEMENT[after].astype(np.int64) * 128 + COMPLEMENT[base], before.astype(np.int64) * 128 + base)
    whole = np.where(back, offset < spread["n"], offset >= 2)
    context = np.where(whole, context, 1 << 14)
    group = pc.dictionary_encode(batch.column("rg"), null_encoding="encode")
    code = np.repeat(group.indices.to_numpy(zero_copy_only=False).astype(np.int64), size)

    cycles = int(cycle.max(initial=0)) + 1
    if batch.num_rows > 1 and len(group.dictionary) * 128 * 16385 * cycles >= 1 << 62:  # keys would not fit
        half = batch.num_rows // 2
        yield from _counted(batch.slice(0, half))
        yield from _counted(batch.slice(half))
        return
    key = (((code * 128 + value) * 16385 + context) * cycles + cycle)[use]
    keys, place, seen = np.unique(key, return_inverse=True, return_counts=True)
    wrong = np.bincount(place, weights=(base != ref)[use], minlength=len(keys)).astype(np.int64)
    rest, cycle_of = keys // cycles, keys % cycles
    rest, context_of = rest // 16385, rest % 16385
    texts = [None if c == 1 << 14 else chr(c >> 7) + chr(c & 127) for c in context_of.tolist()]
    yield pa.RecordBatch.from_arrays(
        [group.dictionary.take(pa.array(rest // 128)), pa.array((rest % 128).astype(np.int32)), pa.array(cycle_of.astype(np.int32)),
         pa.array(texts, type=pa.string()), pa.array(seen.astype(np.int64)), pa.array(wrong)],
        ["rg", "q", "cycle", "context", "observations", "mismatches"])


def _by_segment(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row per segment: its bases with one neighbour on each side, qualities, reference and known sites."""
    seg, first, size = parts(batch)
    row, k = np.repeat(seg, size), runs(size)
    ref = reference_bases(batch, row, np.repeat(first, size) + k)
    wide = unpacked_bases(batch.column("read_cut"), np.bincount(seg, weights=size + 2, minlength=batch.num_rows).astype(np.int64))
    start = np.frombuffer(octets(batch.column("offsets"))[0].tobytes(), dtype="<u4").astype(np.int64) + 1
    own = batch.column("known").take(pa.array(seg))
    site = own.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    at = pc.list_parent_indices(own).to_numpy(zero_copy_only=False).astype(np.int64)
    place = ((site - 1) & (CHUNK - 1)) - first[at]
    inside = (place >= 0) & (place < size[at])
    border = np.concatenate(([0], np.cumsum(np.bincount(at[inside], minlength=len(seg)))))
    return pa.RecordBatch.from_pydict({
        "rg": batch.column("rg").take(pa.array(seg)), "read_cut": blobs(wide, size + 2), "qual_cut": blobs(octets(batch.column("qual_cut"))[0], size),
        "ref_cut": blobs(ref, size), "neg": batch.column("neg").take(pa.array(seg)), "n": batch.column("n").take(pa.array(seg)),
        "seg_read": pa.array(start), "seg_ref": pa.array(first),
        "known": pa.ListArray.from_arrays(pa.array(border.astype(np.int32)), pa.array((first[at] + place)[inside]))})


def _all_counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _counted(_by_segment(batch))


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names]


def _sites(known: DataFrame) -> DataFrame:
    """Known sites by chunk: at most one per position."""
    chunk = F.shiftright(F.col("pos") - 1, CHUNK_SHIFT)
    return known.groupBy("ref_index", chunk.alias("chunk")).agg(F.collect_set("pos").alias("_known"))


def count_covariates(reads: DataFrame, ref_tiles: DataFrame, known: DataFrame, rg: str = "rg") -> DataFrame:
    """Per (``rg``, q, cycle, context): observations and mismatches of aligned bases.

    Left out: N, known sites, bases that no tile of the reference holds
    (``uncovered_bases`` counts them) and bases without a letter or quality of their own.
    ``context`` is the base and its predecessor in read orientation, NULL at the first.
    """
    table = chunks(ref_tiles).join(_sites(known), ["ref_index", "chunk"], "left")
    seq = F.when(F.col("seq") == "*", "").otherwise(F.coalesce("seq", F.lit("")))
    qual = F.when((F.col("qual") == "*") & (F.length("seq") != 1), "").otherwise(F.coalesce("qual", F.lit("")))
    own = reads.select(F.col(rg).alias("rg"), F.coalesce(fl.has("flag", fl.REVERSE), F.lit(False)).alias("neg"), "ref_index", "pos", "cigar",
                       seq.alias("seq"), qual.alias("qual"))
    seg = segments(own, ["rg", "neg"], flank=1).filter(F.length("parts") > 0).drop("alone")
    j = with_reference(seg, table).withColumnRenamed("_known", "known")
    out = T.StructType([j.schema["rg"], *_fields(T.IntegerType(), "q", "cycle"), *_fields(T.StringType(), "context"),
                        *_fields(T.LongType(), "observations", "mismatches")])
    counted = j.mapInArrow(_all_counted, out).groupBy("rg", "q", "cycle", "context")
    return counted.agg(F.sum("observations").alias("observations"), F.sum("mismatches").alias("mismatches")) \
        .withColumnRenamed("rg", rg)


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own, first, n = parts(batch)
        row = np.repeat(own, n)
        gap = reference_bases(batch, row, np.repeat(first, n) + runs(n)) == ord(GAP)
        sums = [np.bincount(own, weights=n, minlength=batch.num_rows), np.bincount(row, weights=gap, minlength=batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("rg"), *[pa.array(x.astype(np.int64)) for x in sums]], ["rg", "aligned", "uncovered"])


def uncovered_bases(reads: DataFrame, ref_tiles: DataFrame, rg: str = "rg") -> DataFrame:
    """Per ``rg``: aligned bases and those of them that no tile of the reference holds, which
    ``count_covariates`` leaves out."""
    bare = reads.select(F.col(rg).alias("rg"), "ref_index", "pos", "cigar", F.lit(None).cast("string").alias("seq"))
    seg = segments(bare, ["rg"]).filter(F.length("parts") > 0).drop("read_cut", "alone")
    j = with_reference(seg, chunks(ref_tiles))
    out = T.StructType([j.schema["rg"], *_fields(T.LongType(), "aligned", "uncovered")])
    sums = [F.sum(name).alias(name) for name in ("aligned", "uncovered")]
    return j.mapInArrow(_gaps, out).groupBy("rg").agg(*sums).withColumnRenamed("rg", rg)
