"""Aggregations: index statistics, bin and linear index, chunk coalescing,
per-region summaries.

Offsets of a BAM index become ranks in coordinate order (``global_rank``),
so the index tables describe the columnar store written in that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bases as bs
from ..functions import coords as co
from ..functions import flags as fl


def index_stats(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """Per contig: aligned and unaligned-with-position records, plus one row
    ``ref_index = -1`` counting records without a coordinate (no contig, or start 0).

    Contigs without reads are listed with zeros, reads on a contig outside the
    dictionary under its own index (null if it has none). One aggregation of the
    reads and the dictionary's zero rows; no join."""
    mapped = fl.is_mapped("flag")
    none = F.coalesce(F.col("ref_index") == -1, F.lit(False)) | (F.coalesce("pos", F.lit(0)) == 0)
    placed = F.when(none, F.lit(-1)).otherwise(F.col("ref_index"))
    counted = reads.select(placed.alias("ref_index"), (mapped & ~none).cast("long").alias("aligned"),
                           (~mapped | none).cast("long").alias("unaligned"))
    zero = F.lit(0).cast("long")
    listed = contigs.select("ref_index", zero.alias("aligned"), zero.alias("unaligned"))
    empty = reads.sparkSession.range(1).select(F.lit(-1).alias("ref_index"), zero.alias("aligned"), zero.alias("unaligned"))
    return (counted.unionByName(listed).unionByName(empty).groupBy("ref_index")
            .agg(F.sum("aligned").alias("aligned"), F.sum("unaligned").alias("unaligned")))


def bin_index(ranked: DataFrame) -> DataFrame:
    """Per (contig, bin): first / last rank and record count (``ranked`` needs
    ref_index, pos, cigar, flag, rank)."""
    end = co.alignment_end("pos", "cigar", "flag")
    return (ranked.filter((F.col("ref_index") >= 0) & (F.col("pos") > 0))
            .withColumn("bin", co.indexing_bin("pos", end))
            .groupBy("ref_index", "bin")
            .agg(F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
                 F.count(F.lit(1)).alias("n")))


def linear_index(ranked: DataFrame) -> DataFrame:
    """Per contig and 16 kbp window: the smallest rank of a record overlapping
    the window; empty windows take the previous window's value.

    Records without an alignment end (unaligned with a position) use one base
    at ``pos - 1``. Windows run from 0 to the furthest window seen on the
    contig, so the dense table is bounded by contig length / 16 kbp.
    """
    end = co.alignment_end("pos", "cigar", "flag")
    placed = ranked.filter((F.col("ref_index") >= 0) & (F.col("pos") > 0))
    w0 = F.when(end == 0, co.linear_window(F.col("pos") - 1)).otherwise(co.linear_window("pos"))
    w1 = F.when(end == 0, w0).otherwise(co.linear_window(end))
    per = placed.select("ref_index", "rank", F.explode(F.sequence(w0, w1)).alias("window"))
    mins = per.groupBy("ref_index", "window").agg(F.min("rank").alias("min_rank"))
    dense = (mins.groupBy("ref_index").agg(F.max("window").alias("_last"))
             .select("ref_index", F.explode(F.sequence(F.lit(0), "_last")).alias("window")))
    filled = dense.join(mins, ["ref_index", "window"], "left")
    w = Window.partitionBy("ref_index").orderBy("window").rowsBetween(Window.unboundedPreceding, 0)
    return filled.select("ref_index", "window", F.last("min_rank", ignorenulls=True).over(w).alias("min_rank"))


def coalesce_chunks(chunks: DataFrame, min_offset, key: list[str] | None = None) -> DataFrame:
    """Sort chunks [start, end), drop those ending at or before ``min_offset``,
    merge overlapping or adjacent ones (``start <= running end``)."""
    key = key or []
    c = chunks.filter(F.col("end") > min_offset)
    order = Window.partitionBy(*key).orderBy("start", "end")
    prev = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(prev.isNull() | (F.col("start") > prev), 1).otherwise(0)
    grp = F.sum("_o").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (c.withColumn("_o", opens).withColumn("_g", grp)
            .groupBy(*key, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
            .drop("_g"))


def genome_length(contigs: DataFrame) -> DataFrame:
    return contigs.agg(F.sum("length").cast("long").alias("genome_length"),
                       F.count(F.lit(1)).alias("n_contigs"))


# Highest quality still taken as Sanger (Phred+33).
SANGER_MAX_QUALITY = 60


def quality_encoding_guess(reads: DataFrame, group: str, order: str, first_only: bool = True) -> DataFrame:
    """Per group: max quality of the first record (by ``order``), or of all
    records, and the guessed encoding (SANGER if <= 60 else ILLUMINA)."""
    mx = F.array_max(bs.phred_decode("qual"))
    if first_only:
        agg = F.min_by(mx, F.col(order))
    else:
        agg = F.max(mx)
    per = reads.groupBy(group).agg(agg.alias("max_quality"))
    return per.withColumn("encoding", F.when(F.col("max_quality") <= SANGER_MAX_QUALITY, "SANGER")
                          .otherwise("ILLUMINA"))
