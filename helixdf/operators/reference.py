"""Read bases against the reference sequence.

The reference is a table of fixed-size tiles ``(ref_index, tile, bases)``
(tile t holds 1-based positions 32t+1 .. 32t+32). ``chunks`` puts 16 of them
together, so that a read of usual length meets one or two rows of the reference; a tile
of A, C, G, T is one BIGINT there, any other tile stays text.
A read's aligned blocks are cut at chunk borders into segments; a read has one row per chunk,
which carries only the segments' bases (4 bits each) and qualities to the join on
(ref_index, chunk), never the whole read. Behind the join numpy compares the bases of a whole
batch at once. Reads inside one chunk are done there; the others are added up by record.
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
from ..functions import cigar as cg
from ..functions import flags as fl
from ..functions import tags as tg
from ..session import ensure_checkpoint_dir
from .blocks import batch_blocks, runs

TILE_SHIFT = 5
TILE = 1 << TILE_SHIFT
CHUNK_SHIFT = 9
CHUNK = 1 << CHUNK_SHIFT
#: Stands for a position that the reference table does not hold.
GAP = " "
#: Stands for a base or a quality that a read does not hold (no base letter; under the lowest quality).
ABSENT = "\x1f"

#: Bytes to upper-case bytes.
UPPER = np.arange(256, dtype=np.uint8)
UPPER[ord("a"):ord("z") + 1] -= 32
TILES = CHUNK // TILE
#: Bases of a plain tile by their 2 bits; characters of a read that take 4 bits.
PLAIN = np.frombuffer(b"ACGT", dtype=np.uint8)
LETTERS = np.frombuffer(b"ACGTNMRSVWYHKDB" + ABSENT.encode(), dtype=np.uint8)
LETTER_CODE = np.full(256, 255, dtype=np.uint8)
LETTER_CODE[LETTERS] = np.arange(16)
#: Bases that are cut at once.
BASES = 1 << 22
_TALLIES = ("_n", "_nb", "_u", "_q")


def chunks(ref_tiles: DataFrame) -> DataFrame:
    """(ref_index, chunk, p0 .. p15, odd): ``CHUNK`` positions each. p holds a tile of A, C, G, T with
    2 bits a base, ``odd`` the chunk's text if a tile holds anything else, with ``GAP`` elsewhere.
    Repeated tiles count once, case is dropped. Bounded rows; store the result to use it often."""
    inside = F.col("tile").bitwiseAND(TILES - 1)
    rows = ref_tiles.select("ref_index", F.shiftright("tile", CHUNK_SHIFT - TILE_SHIFT).alias("chunk"), inside.alias("_k"),
                            F.upper(F.coalesce("bases", F.lit(""))).alias("_t"))
    plain = F.col("_t").rlike(f"^[ACGT]{{{TILE}}}$")
    code = F.when(plain, F.conv(F.translate("_t", "ACGT", "0123"), 4, -10).cast("long"))
    packed = rows.select("ref_index", "chunk", "_k", code.alias("_v")).groupBy("ref_index", "chunk").agg(
        *[F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(f"p{k}") for k in range(TILES)])
    text = F.rpad("_t", TILE, GAP)
    odd = rows.filter(~plain).groupBy("ref_index", "chunk").agg(
        *[F.max(F.when(F.col("_k") == k, text)).alias(f"_p{k}") for k in range(TILES)])
    filled = [F.coalesce(f"_p{k}", F.lit(GAP * TILE)) for k in range(TILES)]
    odd = odd.select("ref_index", "chunk", F.concat(*filled).alias("odd"))
    return packed.join(odd, ["ref_index", "chunk"], "left")


def with_reference(seg: DataFrame, ref_chunks: DataFrame) -> DataFrame:
    """Attach the reference of each segment's chunk (read by ``reference_bases``)."""
    t = ref_chunks.withColumnsRenamed({"ref_index": "_ri", "chunk": "_c"})
    j = seg.join(t, (F.col("ref_index") == F.col("_ri")) & (F.col("chunk") == F.col("_c")), "left")
    return j.drop("_ri", "_c", "ref_index", "chunk")


def reference_bases(batch: pa.RecordBatch, row: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The reference's bases at places ``off`` of the chunks of rows, ``GAP`` where no tile holds them."""
    columns = [batch.column(f"p{k}") for k in range(TILES)]
    held = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in columns], axis=1)
    value = np.stack([c.fill_null(0).to_numpy() for c in columns], axis=1)
    tile = off >> TILE_SHIFT
    bases = np.where(held[row, tile], PLAIN[(value[row, tile] >> (2 * (TILE - 1 - (off & (TILE - 1))))) & 3], ord(GAP)).astype(np.uint8)
    text, at = flat(batch.column("odd"))
    if len(text):
        rest = np.flatnonzero((np.diff(at) > 0)[row] & ~held[row, tile])
        bases[rest] = text[at[row[rest]] + off[rest]]
    return bases


def octets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one array of their UTF-8 bytes and the border of each (null: empty)."""
    raw = column.cast(pa.large_binary())
    if not len(raw) or raw.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(raw) + 1, dtype=np.int64)
    at = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2], dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one byte array and the border of each (null: empty). Characters outside ASCII
    become ``?``, so that a character is a byte."""
    data, at = octets(column)
    if len(data) and data.max() > 127:
        ascii_only = [b"" if s is None else s.encode("ascii", "replace") for s in column.to_pylist()]
        return octets(pa.array(ascii_only, type=pa.large_binary()))
    return data, at


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of each row's part of ``values``."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def blobs(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """Byte strings of ``size`` bytes each, one after another in ``data``."""
    at = np.concatenate(([0], np.cumsum(size)))
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.binary())


def packed_bases(bases: np.ndarray, size: np.ndarray) -> pa.Array:
    """Rows of ``size`` bases each with 4 bits a base; rows with another character than ``LETTERS``
    stay bytes, as rows of one base do."""
    code = LETTER_CODE[bases]
    at = np.concatenate(([0], np.cumsum(size)))
    raw = (row_sums(code == 255, at) > 0) | (size <= 1)
    length = np.where(raw, size, (size + 1) // 2)
    out = np.zeros(int(length.sum()), dtype=np.uint8)
    begin, k = np.repeat(np.cumsum(length) - length, size), runs(size)
    whole = np.repeat(raw, size)
    out[(begin + k)[whole]] = bases[whole]
    for half, shift in ((0, 4), (1, 0)):
        own = ~whole & (k & 1 == half)
        out[(begin + (k >> 1))[own]] |= code[own] << shift
    return blobs(out, length)


def unpacked_bases(column: pa.Array, size: np.ndarray) -> np.ndarray:
    """The bases that ``packed_bases`` packed (null rows: ``ABSENT``)."""
    data, at = octets(column)
    length, k = np.diff(at), runs(size)
    whole, begin = np.repeat(length == size, size), np.repeat(at[:-1], size)
    none = np.repeat(column.is_null().to_numpy(zero_copy_only=False), size)
    if not len(data):
        return np.full(len(k), ord(ABSENT), dtype=np.uint8)
    byte = data[np.where(none, 0, begin + np.where(whole, k, k >> 1))]
    return np.where(none, ord(ABSENT), np.where(whole, byte, LETTERS[(byte >> np.where(k & 1, 0, 4)) & 15])).astype(np.uint8)


def _cut(data: np.ndarray, at: np.ndarray, row: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``size`` characters of each row's text from ``first`` (0-based), ``ABSENT`` where it has none."""
    place = np.repeat(first, size) + runs(size)
    there = (place >= 0) & (place < np.repeat(np.diff(at)[row], size))
    out = np.full(len(place), ord(ABSENT), dtype=np.uint8)
    out[there] = data[(np.repeat(at[:-1][row], size) + place)[there]]
    return out


def _segmented(batch: pa.RecordBatch, flank: int) -> Iterator[pa.RecordBatch]:
    column = {name: batch.column(name) for name in batch.schema.names}
    usable = pc.and_(column["pos"].is_valid(), column["cigar"].is_valid()).to_numpy(zero_copy_only=False)
    pos = np.where(usable, column["pos"].fill_null(0).to_numpy(), 0)
    row, read, ref, size = batch_blocks(column["cigar"], pos)
    row, read, ref, size = (x[usable[row]] for x in (row, read, ref - 1, size))
    if size.sum() > BASES and batch.num_rows > 1:
        half = batch.num_rows // 2
        yield from _segmented(batch.slice(0, half), flank)
        yield from _segmented(batch.slice(half), flank)
        return
    # blocks are cut at the borders of chunks
    times = ((ref + size - 1) >> CHUNK_SHIFT) - (ref >> CHUNK_SHIFT) + 1
    block, k = np.repeat(np.arange(len(row)), times), runs(times)
    chunk = (ref >> CHUNK_SHIFT)[block] + k
    low = np.maximum(ref[block], chunk << CHUNK_SHIFT)
    n = np.minimum((ref + size)[block], (chunk + 1) << CHUNK_SHIFT) - low
    read, row, off = (read - ref)[block] + low, row[block], low & (CHUNK - 1)
    # a row per read and chunk; a read without aligned bases has one, without segments
    new = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (chunk[1:] != chunk[:-1])))) if len(row) else np.zeros(0, dtype=np.int64)
    segs = np.diff(np.append(new, len(row)))
    bare = np.flatnonzero(np.bincount(row, minlength=batch.num_rows) == 0)
    owner = np.concatenate((row[new], bare))
    more = np.zeros(len(bare), dtype=np.int64)
    many = np.bincount(owner, minlength=batch.num_rows)[owner]
    wide = np.add.reduceat(n + 2 * flank, new) if len(new) else new
    seq, at = flat(column["seq"])
    bases = packed_bases(UPPER[_cut(seq, at, row, read - flank, n + 2 * flank)], np.concatenate((wide, more)))
    absent = column["seq"].is_null().to_numpy(zero_copy_only=False)[owner]
    if absent.any():
        bases = pc.if_else(pa.array(absent), pa.scalar(None, pa.binary()), bases)
    out = {name: column[name].take(pa.array(owner)) for name in column if name not in ("pos", "cigar", "seq", "qual")}
    out["chunk"] = pa.array(np.concatenate((chunk[new], bare)).astype(np.int32))
    out["parts"] = blobs(((off << 16) | n).astype("<u4").view(np.uint8), 4 * np.concatenate((segs, more)))
    if flank:
        out["offsets"] = blobs(read.astype("<u4").view(np.uint8), 4 * np.concatenate((segs, more)))
        out["n"] = pa.array(np.diff(at)[owner].astype(np.int32))
    out["read_cut"] = bases
    if "qual" in column:
        qual, own = flat(column["qual"])
        length = np.concatenate((np.add.reduceat(n, new) if len(new) else new, more))
        out["qual_cut"] = blobs(_cut(qual, own, row, read, n), length)
    out["alone"] = pa.array(many == 1)
    yield pa.RecordBatch.from_pydict(out)


def segments(reads: DataFrame, keep: list[str], flank: int = 0) -> DataFrame:
    """Aligned segments of ``reads`` (ref_index, pos, cigar, seq and maybe qual): blocks split at chunk
    borders, a row per read and chunk. A read without aligned bases has one row without segments.

    Columns: ``keep``, ref_index, chunk, parts (4 bytes a segment: place in the chunk and length),
    read_cut (``packed_bases``, with ``flank`` neighbours on both sides of a segment), qual_cut, alone
    (the read has no other row); with ``flank`` also offsets (0-based read offset of a segment) and n (bases of the read).
    """
    keep = list(dict.fromkeys([*keep, "ref_index"]))
    rows = reads.select(*keep, *[c for c in ("pos", "cigar", "seq", "qual") if c in reads.columns])
    more = [("chunk", T.IntegerType()), ("parts", T.BinaryType())] + ([("offsets", T.BinaryType()), ("n", T.IntegerType())] if flank else [])
    more += [("read_cut", T.BinaryType())] + ([("qual_cut", T.BinaryType())] if "qual" in reads.columns else []) + [("alone", T.BooleanType())]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _segmented(batch, flank)
    return rows.mapInArrow(each, T.StructType([rows.schema[c] for c in keep] + [T.StructField(*f) for f in more]))


def parts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments of rows: row, place in the chunk and length."""
    data, at = octets(batch.column("parts"))
    word = np.frombuffer(data.tobytes(), dtype="<u4").astype(np.int64)
    return np.repeat(np.arange(batch.num_rows), np.diff(at) // 4), word >> 16, word & 0xFFFF


def _tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row of segments: mismatches, those that bisulfite conversion does not explain (C to T on the
    forward strand, G to A on the reverse), uncovered bases and the qualities of mismatches."""
    for batch in batches:
        own, first, n = parts(batch)
        size = np.bincount(own, weights=n, minlength=batch.num_rows).astype(np.int64)
        at = np.concatenate(([0], np.cumsum(size)))
        row, off = np.repeat(own, n), np.repeat(first, n) + runs(n)
        ref = UPPER[reference_bases(batch, row, off)]
        read = np.where(batch.column("read_cut").is_null().to_numpy(zero_copy_only=False)[row], ref, unpacked_bases(batch.column("read_cut"), size))
        back = batch.column("neg").to_numpy(zero_copy_only=False).astype(bool)[row]
        covered = ref != ord(GAP)
        differs = (read != ref) & covered
        converted = np.where(back, (ref == ord("G")) & (read == ord("A")), (ref == ord("C")) & (read == ord("T")))
        tallies = [differs, differs & ~converted, ~covered]
        if "qual_cut" in batch.schema.names:
            value = octets(batch.column("qual_cut"))[0].astype(np.int64) - bs.PHRED_OFFSET
            value[(value < 0) | (value > bs.MAX_PHRED)] = 0
            tallies.append(np.where(differs, value, 0))
        names = [c for c in batch.schema.names if c not in ("read_cut", "qual_cut", "neg", "parts", "alone", "odd") and not (c[0] == "p" and c[1:].isdigit())]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in names] + [pa.array(row_sums(x, at)) for x in tallies], [*names, *_TALLIES[:len(tallies)]])


def mismatch_stats(reads: DataFrame, ref_tiles: DataFrame, keep: list[str],
                   with_quals: bool = False) -> DataFrame:
    """Per record: ``keep`` columns + mismatches, mismatches_bisulfite, nm
    (mismatches + inserted + deleted bases) and, with ``with_quals``,
    mismatch_qual_sum.

    A record inside one chunk of the reference is one row of the join. Each other record gets a
    row id before it is cut into segments, so records sharing a name (or identical records) are
    counted separately, and its rows are added up by that id. Records without an aligned
    block or without a sequence (NULL) count zero mismatches; bases that CIGAR asks for
    and SEQ lacks are mismatches; absent qualities count 0. ``uncovered`` counts aligned bases
    that no tile of the reference holds: they are not compared and must not be taken as matches.
    """
    indel = cg.inserted_bases("cigar") + cg.deleted_bases("cigar")
    kept = {f"_k{i}": c for i, c in enumerate(keep)}  # apart from the columns of segments and chunks
    cols = ["_indel", *kept]
    r = reads.withColumns({"_indel": indel, "neg": F.coalesce(fl.has("flag", fl.REVERSE), F.lit(False))})
    r = r.withColumns({k: F.col(c) for k, c in kept.items()}).select(*cols, "neg", "ref_index", "pos", "cigar", "seq", *(["qual"] if with_quals else []))
    last = F.col("pos") + cg.ref_length("cigar") - 2
    crosses = F.coalesce(F.shiftright(F.col("pos") - 1, CHUNK_SHIFT) != F.shiftright(F.greatest(last, F.col("pos") - 1), CHUNK_SHIFT), F.lit(False))
    table = chunks(ref_tiles)
    tallies = list(_TALLIES if with_quals else _TALLIES[:3])

    def tallied(some: DataFrame, names: list[str]) -> DataFrame:
        j = with_reference(segments(some, [*names, "neg"]).drop("alone"), table)
        return j.mapInArrow(_tallied, T.StructType([j.schema[c] for c in j.columns if c in names] + [T.StructField(c, T.LongType()) for c in tallies]))

    one = tallied(r.filter(~crosses), cols)
    # the kept columns depend on the row id: grouping by them too keeps a hash aggregation
    several = tallied(r.filter(crosses).withColumn("_rid", F.monotonically_increasing_id()), [*cols, "_rid"])
    several = several.groupBy("_rid", *cols).agg(*[F.sum(c).alias(c) for c in tallies])
    out = ("mismatches", "mismatches_bisulfite", "uncovered", "mismatch_qual_sum")
    agg = one.unionByName(several.drop("_rid")).select(*[F.col(k).alias(c) for k, c in kept.items()], "_indel",
                                                       *[F.col(t).cast("int").alias(c) for t, c in zip(tallies, out)])
    return agg.withColumn("nm", (F.col("mismatches") + F.col("_indel")).cast("int")).drop("_indel")


def set_nm(reads: DataFrame, ref_tiles: DataFrame) -> DataFrame:
    """Write computed NM values into each record's tag map.

    Records get an id and are stored once in the checkpoint folder, so the
    statistics and the records they are joined back to carry the same ids.
    """
    ensure_checkpoint_dir(reads.sparkSession)
    r = reads.withColumn("_sid", F.monotonically_increasing_id()).checkpoint(eager=True)
    nm = mismatch_stats(r, ref_tiles, ["_sid"]).select("_sid", "nm")
    j = r.join(nm, "_sid", "left")
    return j.withColumn("tags", tg.set_tag("tags", "NM", "i", F.coalesce("nm", F.lit(0)))).drop("nm", "_sid")
