"""Coverage islands and interval merging.

An island is a maximal run of coordinate-sorted intervals on one contig where
each next start lies within ``gap`` bases of the running maximum end.

Scale plan (no single task ever sees a whole contig's reads):

1. pre-aggregate per (contig, start): max end, count. Map-side partial
   aggregation absorbs hot positions; the result is bounded by genome size,
   not by read depth.
2. local islands inside fixed 16 kbp buckets of the start position
   (window partitioned by (contig, bucket), <= 16 384 rows per partition).
3. join local islands across buckets with windows over the bucket summary
   table only (one row per bucket), then group by the global island id. No
   window ever spans a whole contig's reads or islands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

# Fixed value: reads closer than this to the running island end join it.
INTERVAL_OVERLAP = 51


def _islands_once(df: DataFrame, part_cols: list[str], gap: int, weight: str) -> DataFrame:
    """One pass of the island rule over (start, end, weight) rows."""
    order = Window.partitionBy(*part_cols).orderBy("start", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    prev_end = F.max("end").over(before)
    opens = F.when(prev_end.isNull() | (F.col("start") > prev_end + gap), 1).otherwise(0)
    flagged = df.withColumn("_open", opens)
    numbered = flagged.withColumn("_island", F.sum("_open").over(upto))
    return (numbered.groupBy(*part_cols, "_island")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"),
                 F.sum(weight).alias(weight)))


def islands(intervals: DataFrame, gap: int = INTERVAL_OVERLAP, bucket_shift: int = 14,
            key: str = "ref_index") -> DataFrame:
    """Islands of 1-based (``start``, ``end``) intervals per ``key``.

    Returns ``key, island_start, island_end, n_reads``.

    After the local islands of each bucket, a local island starts a new
    global island exactly when its start lies more than ``gap`` past the
    largest end of all earlier buckets (earlier local islands of its own
    bucket are already farther away by the local rule). So the others are the
    first ones of their bucket and belong to the last island opened in an earlier
    bucket. Both values are windows over the bucket summary table (one row per
    bucket, <= contig length / 16 kbp rows per contig), and an island is known by the
    start that opened it; the final grouping by it is an ordinary aggregation.
    """
    pre = (intervals.groupBy(key, "start")
           .agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("n")))
    local = _islands_once(pre.withColumn("_b", F.shiftright("start", bucket_shift)),
                          [key, "_b"], gap, "n")
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)

    def opens(start):
        return F.col("_prev").isNull() | (F.col(start) > F.col("_prev") + gap)

    summary = (local.groupBy(key, "_b").agg(F.max("end").alias("_bmax"), F.max("start").alias("_smax"))
               .withColumn("_prev", F.max("_bmax").over(earlier))
               .withColumn("_carry", F.max(F.when(opens("_smax"), F.col("_smax"))).over(earlier)))
    numbered = local.join(summary.select(key, "_b", "_prev", "_carry"), [key, "_b"]).withColumn(
        "_gid", F.when(opens("start"), F.col("start")).otherwise(F.col("_carry")))
    merged = numbered.groupBy(key, "_gid").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                               F.sum("n").alias("n"))
    return merged.select(F.col(key), F.col("start").cast("int").alias("island_start"),
                         F.col("end").cast("int").alias("island_end"),
                         F.col("n").cast("long").alias("n_reads"))


#: Buckets of starts (16 kbp), and groups of 1,024 buckets.
MERGE_SHIFT, MERGE_GROUP_SHIFT = 14, 10


def _before(summary: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """The summary with the largest ``value`` of all earlier buckets ``_b`` of a key, in two
    levels: earlier buckets of the bucket's group, and earlier groups. No window holds more
    than a group's buckets or a key's groups."""
    def earlier(*part, by):
        return Window.partitionBy(*part).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)

    rows = summary.withColumn("_sb", F.shiftright("_b", MERGE_GROUP_SHIFT))
    groups = (rows.groupBy(key, "_sb").agg(F.max(value).alias("_gv"))
              .withColumn("_gbefore", F.max("_gv").over(earlier(key, by="_sb"))).select(key, "_sb", "_gbefore"))
    inner = rows.withColumn("_ibefore", F.max(value).over(earlier(key, "_sb", by="_b")))
    return inner.join(groups, [key, "_sb"]).withColumn(out, F.greatest("_ibefore", "_gbefore")).drop("_sb", "_ibefore", "_gbefore")


def merge_ranges(ranges: DataFrame, overlap: int, name_col: str = "ref_name") -> DataFrame:
    """Merge named 1-based ranges the way region files are written.

    The start of each merged range is widened by ``overlap`` (not below 1); a
    following range joins while ``start - overlap < current end`` (strict).
    Names compare case-insensitively; a merged range has the name of its first range
    (of equal starts the least). Returns ``name, start, end`` (1-based).

    Ranges are first reduced to one row per widened start (combined map-side) and merged inside
    16 kbp buckets of starts; what is left is written once to the checkpoint folder. The largest end
    before a bucket comes from bucket summaries joined in two levels (``_before``), so no window
    holds a whole contig. A bucket's merged range that starts under that end belongs to the last range
    opened before the bucket, which the summaries give, too. A range that ends at or before its
    widened start (possible when ``overlap`` is 0) takes in no follower, so copies of it stay
    apart. Ranges with a null name, start or end are left out.
    """
    df = ranges.select(F.lower(F.col(name_col)).alias("_name"), F.col(name_col).alias("_orig"),
                       (F.col("start") - overlap).alias("_s"), F.col("end").alias("end")).dropna()
    closed = F.when(F.col("end") <= F.col("_s"), F.col("end"))
    pre = (df.groupBy("_name", "_s", closed.alias("_closed"))
           .agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("_n"), F.min("_orig").alias("_orig"))
           .withColumn("_b", F.shiftright("_s", MERGE_SHIFT)))
    order = Window.partitionBy("_name", "_b").orderBy("_s", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = pre.withColumn("_open", F.when(reach.isNull() | (F.col("_s") >= reach), 1).otherwise(0))
    numbered = opened.withColumn("_g", F.sum("_open").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # a range that is closed and opens a group is alone in it
    local = numbered.groupBy("_name", "_b", "_g").agg(
        F.min("_s").alias("_s"), F.max("end").alias("end"), F.min_by("_orig", F.struct("_s", "_orig")).alias("_orig"),
        F.max(F.when(F.col("_open") == 1, F.col("_closed"))).alias("_closed"), F.max("_n").alias("_n")).drop("_g")
    path = scratch_path(ranges.sparkSession, "ranges")
    local.write.parquet(path)
    local = ranges.sparkSession.read.schema(local.schema).parquet(path)

    def opens():
        return F.col("_prev").isNull() | (F.col("_s") >= F.col("_prev"))

    summary = _before(local.groupBy("_name", "_b").agg(F.max("end").alias("_bmax"), F.max("_s").alias("_s")), "_name", "_bmax", "_prev")
    summary = _before(summary.select("_name", "_b", "_prev", F.when(opens(), F.col("_s")).alias("_last")), "_name", "_last", "_carry")
    told = local.join(summary.select("_name", "_b", "_prev", "_carry"), ["_name", "_b"])
    told = told.withColumn("_g", F.when(opens(), F.col("_s")).otherwise(F.col("_carry"))).withColumn("_alone", F.when(opens(), F.col("_closed")))
    merged = told.groupBy("_name", "_g", "_alone").agg(
        F.min_by("_orig", F.struct("_s", "_orig")).alias("name"), F.greatest(F.min("_s"), F.lit(1)).alias("start"), F.max("end").alias("end"),
        F.max(F.when(F.col("_alone").isNotNull(), F.col("_n")).otherwise(1)).alias("_n"))
    return merged.select("name", "start", "end", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("col")
