"""Sort orders, a distributed global rank, near-equal region splits, order checks.

``global_rank`` never funnels rows through one task: the data is range
partitioned on the full sort key (Spark samples split points, so a hot
position is split by the later keys), sorted inside partitions, and stored
once in the session checkpoint folder. Ranks are then partition offset +
position inside the partition; the offset table has one row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import flags as fl
from ..session import ensure_checkpoint_dir

# Sorts after every real contig index (unmapped reads go last in coordinate order).
_LAST = 2**31 - 1


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def coordinate_keys(ref_index="ref_index", pos="pos", flag="flag", qname="qname", mapq="mapq",
                    mate_ref_index="mate_ref_index", mate_pos="mate_pos", isize="isize") -> list[Column]:
    """Keys of coordinate order: contig (unmapped last), start (ignored when
    unmapped), forward strand first, name, flags, mapq, mate contig, mate start,
    insert size. Optional keys passed as None are left out."""
    unplaced = _c(ref_index) == -1
    keys = [F.when(unplaced, F.lit(_LAST)).otherwise(_c(ref_index)),
            F.when(unplaced, F.lit(0)).otherwise(_c(pos)),
            fl.has(flag, fl.REVERSE).cast("int")]
    return keys + [_c(k) for k in (qname, flag, mapq, mate_ref_index, mate_pos, isize) if k is not None]


def queryname_keys(qname="qname", flag="flag", hit_index=None) -> list[Column]:
    """Keys of query-name order: name, paired first, first-of-pair before
    second, forward first, primary first, HI tag (absent first) ascending."""
    f = _c(flag)
    paired = fl.has(f, fl.PAIRED)
    end = (F.when(~paired, 0).when(fl.has(f, fl.FIRST_OF_PAIR), 0)
           .when(fl.has(f, fl.SECOND_OF_PAIR), 2).otherwise(1))
    keys = [_c(qname), F.when(paired, 0).otherwise(1), end,
            fl.has(f, fl.REVERSE).cast("int"), fl.has(f, fl.SECONDARY).cast("int")]
    if hit_index is not None:
        keys.append(_c(hit_index).asc_nulls_first())
    return keys


def ref_pos_keys(ref_index="ref_index", pos="pos") -> list[Column]:
    """Order used between pipeline stages: contig index (−1 first), start."""
    return [_c(ref_index), _c(pos)]


def global_rank(df: DataFrame, order: list, rank_col: str = "rank",
                num_partitions: int | None = None, with_total: bool = False):
    """0-based rank of every row in ``order`` (ties get distinct ranks).

    Range partition + sort on the full key, materialise once in the
    checkpoint folder (so the per-partition counts and the rows agree even if
    an executor is lost), count rows per partition, and add each partition's
    offset. The count table has one row per partition (bounded by the
    partition count, not the data); its prefix sums are taken on the driver
    and broadcast back. With ``with_total`` returns (ranked, total rows).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [_c(o) for o in order]
    staged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    part = F.shiftright("_mid", 33)
    counts = (staged.groupBy(part.alias("_p"))
              .agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_min")).collect())
    running, rows = 0, []
    for r in sorted(counts, key=lambda r: r["_p"]):
        rows.append((int(r["_p"]), int(r["_min"]), running))
        running += int(r["_n"])
    offsets = spark.createDataFrame(rows, "_p long, _min long, _off long")
    ranked = staged.withColumn("_p", part).join(F.broadcast(offsets), "_p")
    ranked = ranked.withColumn(rank_col, (F.col("_off") + F.col("_mid") - F.col("_min")).cast("long")) \
        .drop("_p", "_min", "_off", "_mid")
    return (ranked, running) if with_total else ranked


def equal_split_region(rank, n, k) -> Column:
    """Region (0..k-1) of a 0-based rank when n rows are cut into k contiguous
    regions whose sizes differ by at most one (the first n mod k get one more).
    Same as SQL ``NTILE(k) - 1``."""
    r = _c(rank)
    n, k = _c(n) if not isinstance(n, int) else F.lit(n), _c(k) if not isinstance(k, int) else F.lit(k)
    div = lambda x, y: F.call_function("div", x, y)  # noqa: E731  (integer division: ranks may pass 2^53)
    q = div(n, k)
    m = n - q * k
    big = m * (q + 1)
    return F.when(r < big, div(r, q + 1)).otherwise(m + div(r - big, q)).cast("int")


def equal_split_regions(df: DataFrame, order: list, k: int, region_col: str = "region") -> DataFrame:
    """Global rank + region id; the row count comes with the rank (no extra pass)."""
    ranked, n = global_rank(df, order, with_total=True)
    return ranked.withColumn(region_col, equal_split_region("rank", n, k))


#: Lines whose neighbours one window looks at.
ORDER_LINES = 1 << 16


def check_sort_order(records: DataFrame, keys: list, line_col: str = "line_no", lines: int = ORDER_LINES) -> DataFrame:
    """Records whose declared keys are below those of the record before them (by
    ``line_col``): the line, both keys as structs, both names.

    Neighbours are compared inside ranges of ``lines`` line numbers; the first record of a
    range is compared with the last one of the range before it, from a table of one row per
    range. Rows are shuffled once and never joined to each other.
    """
    key = F.struct(*[_c(k).alias(f"k{i}") for i, k in enumerate(keys)])
    cur = records.select(F.col(line_col).alias("line_no"), key.alias("key"), F.col("qname").alias("qname"))
    cur = cur.withColumn("_range", F.call_function("div", F.col("line_no").cast("long"), F.lit(lines).cast("long")))
    near = Window.partitionBy("_range").orderBy("line_no")
    seen = cur.withColumn("_prev", F.lag(F.struct("key", "qname")).over(near))
    ends = cur.groupBy(F.col("_range").alias("_of")).agg(F.max_by(F.struct("key", "qname"), "line_no").alias("_last"))
    before = ends.withColumn("_before", F.lag("_last").over(Window.orderBy("_of"))).drop("_last")  # a row per range
    heads = seen.filter(F.col("_prev").isNull()).join(before, F.col("_range") == F.col("_of")).withColumn("_prev", F.col("_before"))
    both = seen.filter(F.col("_prev").isNotNull()).unionByName(heads.select(*seen.columns))
    return both.select("line_no", "key", "qname", F.col("_prev.key").alias("prev_key"), F.col("_prev.qname").alias("prev_qname")).filter(F.col("key") < F.col("prev_key"))
