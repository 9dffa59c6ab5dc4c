"""Row filters and single-region queries over ``reads``.

All are plain ``filter`` predicates on columns that Parquet stores with
min/max statistics, so on a table written by ``write_reads_columnar``
(partitioned by ``ref_index``, sorted by ``pos``) they prune partitions and
row groups at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coords
from ..functions.flags import SECONDARY, UNMAPPED

# Contigs kept for variant calling (chr1..chr22, chrX, chrY).
PRIMARY_MIN_INDEX = 1
PRIMARY_MAX_INDEX = 24


def keep_primary_contigs(reads: DataFrame, lo: int = PRIMARY_MIN_INDEX,
                         hi: int = PRIMARY_MAX_INDEX) -> DataFrame:
    """Mapped reads on contigs lo..hi (secondary alignments are kept)."""
    return reads.filter((F.col("flag").bitwiseAND(UNMAPPED) == 0)
                        & (F.col("ref_index") >= lo) & (F.col("ref_index") <= hi))


def with_end(reads: DataFrame, name: str = "end") -> DataFrame:
    return reads.withColumn(name, coords.alignment_end("pos", "cigar", "flag"))


def _query_end(reads_end):
    """End used by region queries: unmapped-with-position counts as one base."""
    return F.when(reads_end <= 0, F.col("pos")).otherwise(reads_end)


def _region(ref_index: int, start: int, end: int):
    """Contig predicate plus the effective region end (end <= 0 means open)."""
    return F.col("ref_index") == ref_index, (end if end > 0 else 2**31 - 1)


def query_overlapping(reads: DataFrame, ref_index: int, start: int, end: int) -> DataFrame:
    """Records on ``ref_index`` overlapping 1-based [start, end]; end <= 0 = to contig end."""
    on_contig, stop = _region(ref_index, start, end)
    if start == 0 and stop == 2**31 - 1:
        return reads.filter(on_contig)
    e = _query_end(coords.alignment_end("pos", "cigar", "flag"))
    return reads.filter(on_contig & (F.col("pos") <= stop) & (e >= start))


def query_contained(reads: DataFrame, ref_index: int, start: int, end: int) -> DataFrame:
    """Records lying entirely inside 1-based [start, end]."""
    on_contig, stop = _region(ref_index, start, end)
    e = _query_end(coords.alignment_end("pos", "cigar", "flag"))
    return reads.filter(on_contig & (F.col("pos") >= start) & (F.col("pos") <= stop) & (e <= stop))


def query_alignment_start(reads: DataFrame, ref_index: int, start: int) -> DataFrame:
    return reads.filter((F.col("ref_index") == ref_index) & (F.col("pos") == start))


def query_unmapped(reads: DataFrame) -> DataFrame:
    """Reads without a reference (placed at the end of a coordinate-sorted file)."""
    return reads.filter(F.col("ref_index") == -1)


def query_whole_contig(reads: DataFrame, ref_index: int) -> DataFrame:
    return reads.filter(F.col("ref_index") == ref_index)


def skip_secondary(reads: DataFrame) -> DataFrame:
    return reads.filter(F.col("flag").bitwiseAND(SECONDARY) == 0)
