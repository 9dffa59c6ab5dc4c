"""Interval overlap joins in nested bins, without a nested loop.

Bins of several sizes (``SHIFTS``: 16 kbp and eight times larger each) lie over every
contig. An interval belongs to the smallest size that is no shorter than itself, so at its
own size and at every larger one it touches two bins at most, however long it is.

Two intervals are joined at the larger of their two sizes: the one of that size gives its
own bins, the other one the bins it touches there. The overlap of a pair begins at the
larger of their starts, which lies in one bin, and only there the pair counts. So the join
is an equi join on (contig, side that is larger, size, bin) in which every overlapping
pair meets exactly once: no dedupe of pairs, no widest interval measured beforehand.

An interval is repeated for larger sizes that the other side really has: a list of at most
seven numbers that Spark finds as a scalar subquery while the join runs.

Semi and anti joins: an interval with one bin (nearly all short ones) is a plain semi or
anti join. For a semi join those with several bins get an id, by which the bins that hit
become one row again. For an anti join they are counted by content first, marked if any of
their bins hits, and repeated by their count, so equal rows keep their number.

Defined cases: an empty interval (end = start) overlaps what holds it strictly inside; a
null contig, start or end overlaps nothing; empty tables join to nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHIFTS = (14, 17, 20, 23, 26, 29, 32)
_KEYS = ("_who", "_size", "_bin")


def size_of(start0, end0) -> Column:
    """Shift of the smallest bins that are no shorter than the interval."""
    n = F.col(end0).cast("long") - F.col(start0)
    out = F.when(n <= 1 << SHIFTS[0], SHIFTS[0])
    for s in SHIFTS[1:-1]:
        out = out.when(n <= 1 << s, s)
    return out.when(n.isNotNull(), SHIFTS[-1])


def _shift(x: Column, by: Column) -> Column:
    return F.call_function("shiftright", x.cast("long"), by)


def _sizes(df: DataFrame, start0: str, end0: str) -> Column:
    """The sizes that a table's intervals have, as a scalar subquery."""
    return df.select(size_of(start0, end0).alias("s")).agg(F.array_sort(F.collect_set("s"))).scalar()


def _sized(df: DataFrame, start0: str, end0: str, others: Column, first: bool) -> DataFrame:
    """Adds ``_own`` (size), ``_last`` (last position), ``_larger`` (sizes of the other side at
    which the row meets it too, null if there are none) and ``_one`` (only one bin in all)."""
    out = df.withColumns({"_others": others, "_own": size_of(start0, end0),
                          "_last": F.greatest(F.col(end0).cast("long") - 1, F.col(start0).cast("long"))})
    least = F.col("_own") + (1 if first else 0)
    more = F.array_max("_others") >= least
    larger = F.when(more, F.filter("_others", lambda s: s >= least))
    one = ~F.coalesce(more, F.lit(False)) & (_shift(F.col(start0), F.col("_own")) == _shift(F.col("_last"), F.col("_own")))
    return out.withColumns({"_larger": larger, "_one": F.coalesce(one, F.lit(True))}).drop("_others")


def _placed(df: DataFrame, start0: str, names, first: bool) -> DataFrame:
    """A row for every place where a row of ``df`` can meet the other side: who tells whether
    the first (0) or the second side (1) has that size itself."""
    who, size, bin_ = names
    own, other = (0, 1) if first else (1, 0)
    mine = F.array(F.struct(F.lit(own).alias("who"), F.col("_own").alias("size")))
    theirs = F.transform("_larger", lambda s: F.struct(F.lit(other).alias("who"), s.alias("size")))
    out = df.withColumn("_at", F.explode(F.when(F.col("_larger").isNull(), mine).otherwise(F.concat(mine, theirs))))
    out = out.withColumns({who: F.col("_at.who"), size: F.col("_at.size")})
    bins = F.sequence(_shift(F.col(start0), F.col(size)), _shift(F.col("_last"), F.col(size)))
    return out.withColumn(bin_, F.explode(bins)).drop("_at", "_own", "_last", "_larger", "_one")


def overlap_join(probe: DataFrame, build: DataFrame, how: str = "inner",
                 probe_keys=("ref_index", "start0", "end0"),
                 build_keys=("ref_index", "start0", "end0")) -> DataFrame:
    """Join rows of ``probe`` and ``build`` whose 0-based half-open intervals
    overlap on the same contig. ``how``: inner, left, left_semi, left_anti.

    Build columns are prefixed ``b_`` in the output (inner/left).
    """
    pr, ps, pe = probe_keys
    br, bs, be = build_keys
    b = build.select([F.col(c).alias("b_" + c) for c in build.columns])
    b = b.withColumnRenamed("b_" + br, "b_ref").withColumnRenamed("b_" + bs, "b_start0") \
        .withColumnRenamed("b_" + be, "b_end0")
    p = _sized(probe, ps, pe, _sizes(b, "b_start0", "b_end0"), True)
    b = _sized(b, "b_start0", "b_end0", _sizes(probe, ps, pe), False)
    b = _placed(b, "b_start0", ("_bwho", "_bsize", "_bbin"), False)
    meets = ((F.col(pr) == F.col("b_ref")) & (F.col("_who") == F.col("_bwho")) & (F.col("_size") == F.col("_bsize")) & (F.col("_bin") == F.col("_bbin"))
             & (F.col(ps) < F.col("b_end0")) & (F.col("b_start0") < F.col(pe))
             & (_shift(F.greatest(F.col(ps), F.col("b_start0")), F.col("_size")) == F.col("_bin")))
    if how in ("inner", "left"):
        pairs = _placed(p, ps, _KEYS, True).join(b, meets).drop(*_KEYS, "_bwho", "_bsize", "_bbin")
        if how == "inner":
            return pairs
        return pairs.unionByName(overlap_join(probe, build, "left_anti", probe_keys, build_keys), allowMissingColumns=True)

    alone = {"_who": F.lit(0), "_size": F.col("_own"), "_bin": _shift(F.col(ps), F.col("_own"))}
    columns = probe.columns
    plain = p.filter("_one").withColumns(alone).join(b, meets, how).select(*columns)
    several = p.filter("not _one")
    if how == "left_semi":
        found = _placed(several.withColumn("_id", F.monotonically_increasing_id()), ps, _KEYS, True).join(b, meets, how)
        return plain.unionByName(found.dropDuplicates(["_id"]).select(*columns))
    hit = _placed(several, ps, _KEYS, True).join(b, meets, "left_semi").select(*columns).distinct()
    marked = (several.select(*columns, F.lit(1).alias("_n"), F.lit(0).alias("_hit"))
              .unionByName(hit.select("*", F.lit(0).alias("_n"), F.lit(1).alias("_hit")))
              .groupBy(*columns).agg(F.sum("_n").alias("_n"), F.max("_hit").alias("_hit")))
    kept = marked.filter(F.col("_hit") == 0)
    again = kept.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_again")).drop("_again")
    return plain.unionByName(again)


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every overlapping (A, B) pair with the A interval clipped to the overlap
    (``bedtools intersect -a A -b B``); columns of A are prefixed ``b_``."""
    j = overlap_join(b, a, "inner")
    return (j.withColumn("i_start0", F.greatest("start0", "b_start0"))
            .withColumn("i_end0", F.least("end0", "b_end0")))


def semi_join(reads: DataFrame, targets: DataFrame) -> DataFrame:
    """Reads touching any target (each read once)."""
    return overlap_join(reads, targets, "left_semi")


def anti_join(reads: DataFrame, targets: DataFrame) -> DataFrame:
    """Reads touching no target."""
    return overlap_join(reads, targets, "left_anti")
