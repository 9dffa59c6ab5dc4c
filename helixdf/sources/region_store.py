"""Reads stored for region queries: Spark reads only the files that regions need.

Reads are partitioned by contig, span and tile. A read's span is the smallest of the store's
spans that is no shorter than it (nearly all reads: the first), and its tile the bin of that size
that holds its start; inside a file reads are sorted by position. A region then meets, per
span, the tile before its start up to the tile of its end, so a region turns into a few
partition values. The distinct values of all regions prune the store's folders while the query
runs (dynamic partition pruning); the reads of these folders then meet the regions in a binned
interval join.

Each folder costs the driver memory, for its commit and its listing. So the smallest tile is
1 Mbp on a small genome and grows in powers of two with the stretch that the reads cover, until
about ``FOLDERS`` tiles hold it. The tile sizes of a store lie beside its reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coords
from ..operators import intervals

#: Sizes of tiles as powers of two (1 Mbp first).
SPANS = (20, 26, 32)
#: About the largest number of tiles of the smallest size.
FOLDERS = 1024
#: Folder of the tile sizes inside a store; scans of the store skip names with this beginning.
LAYOUT = "_layout"
PARTITIONS = ("store_ref", "store_span", "store_tile")


def _span(start0: Column, end0: Column, spans) -> Column:
    out = F.when(end0 - start0 <= 1 << spans[0], spans[0])
    for s in spans[1:-1]:
        out = out.when(end0 - start0 <= 1 << s, s)
    return out.otherwise(spans[-1])


def _tile(position0: Column, span: Column) -> Column:
    return F.call_function("shiftright", F.greatest(position0.cast("long"), F.lit(0).cast("long")), span)


def fitting_spans(last: DataFrame, spans=SPANS, folders: int = FOLDERS) -> tuple[int, ...]:
    """``spans``, the first enlarged so that contigs up to their ``last`` position make about
    ``folders`` tiles, the others to no less than that. One number comes to the driver."""
    length = last.agg(F.sum(F.col("last").cast("double"))).first()[0] or 0.0
    first = spans[0]
    while length / (1 << first) > folders:
        first += 1
    return tuple(sorted({first, *(max(s, first) for s in spans[1:])}))


def write_region_store(reads: DataFrame, path: str, spans=None) -> None:
    """Reads (ref_index, pos, cigar, flag, ...) with a contig, as a store for :func:`read_regions`."""
    start0 = (F.col("pos") - 1).cast("long")
    end0 = F.greatest(coords.alignment_end("pos", "cigar", "flag").cast("long"), start0 + 1)
    placed = reads.filter(F.col("ref_index") >= 0)
    if spans is None:
        spans = fitting_spans(placed.groupBy("ref_index").agg(F.max("pos").alias("last")))
    placed = placed.withColumns({"store_start0": start0, "store_end0": end0})
    span = _span(F.col("store_start0"), F.col("store_end0"), spans)
    placed = placed.withColumns({"store_ref": F.col("ref_index"), "store_span": span})
    placed = placed.withColumn("store_tile", _tile(F.col("store_start0"), F.col("store_span")))
    # later keys split a tile with many reads over several tasks
    keys = [*PARTITIONS, "pos", F.xxhash64("qname", "flag")]
    placed.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy(*PARTITIONS).parquet(path)
    spark = reads.sparkSession
    spark.createDataFrame([(s,) for s in spans], "span int").coalesce(1).write.parquet(f"{path}/{LAYOUT}")


def region_tiles(regions: DataFrame, spans=SPANS) -> DataFrame:
    """Distinct partition values of the store that 0-based half-open regions (ref_index, start0, end0) meet."""
    each = regions.select(F.col("ref_index").alias("r_ref"), F.col("start0").alias("r_start0"), F.col("end0").alias("r_end0"),
                          F.explode(F.array(*[F.lit(s) for s in spans])).alias("r_span"))
    low = _tile(F.col("r_start0"), F.col("r_span")) - 1  # a read of that span may begin one tile before
    high = _tile(F.col("r_end0") - 1, F.col("r_span"))
    tiles = each.select("*", F.explode(F.sequence(F.greatest(low, F.lit(0).cast("long")), F.greatest(high, F.lit(0).cast("long")))).alias("r_tile"))
    return tiles.filter((F.col("r_ref") >= 0) & (F.col("r_start0") < F.col("r_end0"))).select("r_ref", "r_span", "r_tile").distinct()


def read_regions(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """Stored reads that overlap any of the regions, each once, with their columns."""
    spans = tuple(sorted(r.span for r in spark.read.parquet(f"{path}/{LAYOUT}").collect()))
    stored = spark.read.parquet(path)
    columns = [c for c in stored.columns if c not in (*PARTITIONS, "store_start0", "store_end0")]
    # as many rows as the store has folders, whatever the number of regions
    tiles = F.broadcast(region_tiles(regions, spans))
    folder = (F.col("store_ref") == F.col("r_ref")) & (F.col("store_span") == F.col("r_span")) & (F.col("store_tile") == F.col("r_tile"))
    near = stored.join(tiles, folder, "left_semi")
    real = regions.filter((F.col("ref_index") >= 0) & (F.col("start0") < F.col("end0")))
    return intervals.overlap_join(near, real, "left_semi", probe_keys=("store_ref", "store_start0", "store_end0")).select(*columns)
