"""The whole read-preparation flow of the original job, composed from operators.

Original order: align -> key by contig and drop chrM/unplaced -> sort -> cut
into near-equal regions -> per region: clean, mark duplicates, add read
group, target regions from coverage islands, recalibrate, call. Alignment
and variant calling are external tools (not built); everything between them
is here as DataFrame steps, each a scalable operator. Nothing is collected:
the result is a set of DataFrames the caller writes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tags as tg
from ..operators import filters, intervals, islands, order, pileup, preprocess, records


def prepare_for_calling(reads: DataFrame, contigs: DataFrame, ref_tiles: DataFrame,
                        known_sites: DataFrame, n_regions: int,
                        targets: DataFrame | None = None) -> dict[str, DataFrame]:
    """Run the preparation steps over ``reads`` (qname, flag, ref_index, pos,
    mapq, cigar, seq, qual[, tags]).

    Returns DataFrames: ``reads`` (recalibrated, duplicates flagged, read group
    set, with ``region`` and ``rank``), ``read_groups``, ``regions`` (coverage
    islands per region), ``region_targets`` (islands clipped to targets when
    given), ``recal_table``, ``duplicate_metrics`` and ``depth``.
    """
    if "tags" not in reads.columns:
        reads = reads.withColumn("tags", F.create_map().cast(tg.TAGS_TYPE))
    kept = filters.keep_primary_contigs(reads)
    ranked = order.equal_split_regions(kept, order.coordinate_keys(
        mate_ref_index=None, mate_pos=None, isize=None), n_regions)
    cleaned = preprocess.clean_reads(ranked, contigs)
    marked = preprocess.mark_duplicates(cleaned)
    with_rg, read_groups = records.set_read_group(marked)
    with_rg = with_rg.withColumn("rg", tg.tag_string("tags", "RG"))

    placed = filters.with_end(with_rg.filter(F.col("ref_index") >= 0))
    isl = islands.islands(placed.select(F.col("ref_index"), F.col("pos").alias("start"), "end"))
    out = {"read_groups": read_groups, "regions": isl}
    if targets is not None:
        iv = isl.select("ref_index", (F.col("island_start") - 1).alias("start0"),
                        F.col("island_end").alias("end0"))
        out["region_targets"] = intervals.intersect(targets, iv)

    table = preprocess.bqsr_table(with_rg, ref_tiles, known_sites)
    recal = preprocess.bqsr_apply(with_rg, preprocess.recalibration_deltas(table))
    out["recal_table"] = table
    out["reads"] = recal
    out["duplicate_metrics"] = preprocess.duplicate_metrics(marked)
    out["depth"] = pileup.locus_depth(recal.filter(F.col("flag").bitwiseAND(0x400) == 0))
    return out
