"""Queries: sort orders, global rank, equal regions, order checks, index statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import coords as co
from ..operators import filters, lookups, order, stats
from .registry import query, sql_end

W = fx.with_clause

COORD_SQL = ("case when ref_index = -1 then 2147483647 else ref_index end, "
             "case when ref_index = -1 then 0 else pos end, (flag & 16) <> 0, qname, flag, mapq")
QNAME_SQL = ("qname, case when (flag & 1) <> 0 then 0 else 1 end, "
             "case when (flag & 1) = 0 then 0 when (flag & 64) <> 0 then 0 when (flag & 128) <> 0 then 2 else 1 end, "
             "(flag & 16) <> 0, (flag & 256) <> 0")
KEPT_SQL = "(flag & 4) = 0 and ref_index > 0 and ref_index <= 24"
N_REGIONS = 8


def _coord_keys():
    return order.coordinate_keys(mate_ref_index=None, mate_pos=None, isize=None)


def _reads(spark, sf_dir):
    return fx.load(spark, sf_dir).reads


def _kept(spark, sf_dir):
    return filters.keep_primary_contigs(_reads(spark, sf_dir))


def _regions(spark, sf_dir):
    return order.equal_split_regions(_kept(spark, sf_dir), _coord_keys(), N_REGIONS)


@query("sort_coordinate", W("reads") + f"""
select qname, cast(row_number() over (order by {COORD_SQL}) - 1 as bigint) as rank from reads""")
def q_sort_coordinate(spark, sf_dir):
    return order.global_rank(_reads(spark, sf_dir), _coord_keys()).select("qname", "rank")


@query("sort_queryname", W("reads") + f"""
select qname, flag, cast(row_number() over (order by {QNAME_SQL}) - 1 as bigint) as rank from reads""")
def q_sort_queryname(spark, sf_dir):
    return order.global_rank(_reads(spark, sf_dir), order.queryname_keys()).select("qname", "flag", "rank")


@query("sort_ref_pos", W("reads") + """
select qname, cast(row_number() over (order by ref_index, pos, qname, flag) - 1 as bigint) as rank from reads""")
def q_sort_ref_pos(spark, sf_dir):
    """Order between pipeline stages: (contig index, start); unplaced (-1) first."""
    keys = order.ref_pos_keys() + [F.col("qname"), F.col("flag")]
    return order.global_rank(_reads(spark, sf_dir), keys).select("qname", "rank")


@query("sort_by_contig", W("reads") + f"""
, c as (select ref_index, count(*) as n from reads where {KEPT_SQL} group by ref_index)
select ref_index, n as n_records, cast(coalesce(sum(n) over (order by ref_index rows between unbounded preceding and 1 preceding), 0) as bigint) as first_rank,
 cast(sum(n) over (order by ref_index rows between unbounded preceding and current row) - 1 as bigint) as last_rank from c""")
def q_sort_by_contig(spark, sf_dir):
    """Contig-keyed sort; each contig's slice of ranks. Later keys only split a
    large contig across range partitions (the contig order is what is promised)."""
    ranked = order.global_rank(_kept(spark, sf_dir), [F.col("ref_index"), F.col("pos"), F.col("qname")])
    return ranked.groupBy("ref_index").agg(F.count(F.lit(1)).alias("n_records"),
                                           F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"))


@query("global_record_index", W("reads") + f"""
select qname, cast(row_number() over (order by {COORD_SQL}) - 1 as bigint) as rank from reads where {KEPT_SQL}""")
def q_global_record_index(spark, sf_dir):
    return order.global_rank(_kept(spark, sf_dir), _coord_keys()).select("qname", "rank")


@query("equal_split_regions", W("reads") + f"""
select qname, cast(ntile({N_REGIONS}) over (order by {COORD_SQL}) - 1 as integer) as region from reads where {KEPT_SQL}""")
def q_equal_split_regions(spark, sf_dir):
    return _regions(spark, sf_dir).select("qname", "region")


_REG_SQL = W("reads") + f"""
, rg as (select qname, qual, cast(row_number() over (order by {COORD_SQL}) - 1 as bigint) as rank,
                cast(ntile({N_REGIONS}) over (order by {COORD_SQL}) - 1 as integer) as region from reads where {KEPT_SQL})
"""


@query("region_histogram", _REG_SQL + "select region, count(*) as n_records from rg group by region")
def q_region_histogram(spark, sf_dir):
    return _regions(spark, sf_dir).groupBy("region").agg(F.count(F.lit(1)).alias("n_records"))


@query("first_record_per_region", _REG_SQL + "select region, arg_min(qname, rank) as qname, min(rank) as rank from rg group by region")
def q_first_record_per_region(spark, sf_dir):
    return _regions(spark, sf_dir).groupBy("region").agg(F.min_by("qname", "rank").alias("qname"),
                                                         F.min("rank").alias("rank"))


@query("group_by_region", _REG_SQL + """
select region, count(*) as n_records, min(rank) as first_rank, max(rank) as last_rank,
 arg_max(qname, rank) as last_qname from rg group by region""")
def q_group_by_region(spark, sf_dir):
    """What a region's records in rank order give, combined before the shuffle: the
    ranked records are never moved to one task per region."""
    return _regions(spark, sf_dir).groupBy("region").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("rank").alias("first_rank"),
        F.max("rank").alias("last_rank"), F.max_by("qname", "rank").alias("last_qname"))


@query("quality_encoding_guess", _REG_SQL + """
select region, cast(arg_min(list_max(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)), rank) as integer) as max_quality,
 case when arg_min(list_max(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)), rank) <= 60 then 'SANGER' else 'ILLUMINA' end as encoding
from rg group by region""")
def q_quality_encoding_guess(spark, sf_dir):
    return stats.quality_encoding_guess(_regions(spark, sf_dir), "region", "rank")


@query("check_sort_order", W("reads") + """
, l as (select qname, row_number() over (order by qname, flag) - 1 as line_no,
               case when ref_index = -1 then 2147483647 else ref_index end as k0, case when ref_index = -1 then 0 else pos end as k1 from reads)
select b.line_no, b.qname, a.qname as prev_qname from l a join l b on b.line_no = a.line_no + 1
where b.k0 < a.k0 or (b.k0 = a.k0 and b.k1 < a.k1)""")
def q_check_sort_order(spark, sf_dir):
    """A name-ordered file checked against the declared coordinate order."""
    lines = order.global_rank(_reads(spark, sf_dir), ["qname", "flag"], rank_col="line_no")
    keys = _coord_keys()[:2]
    bad = order.check_sort_order(lines, keys)
    return bad.select("line_no", "qname", "prev_qname")


@query("check_sort_order_queryname", W("reads") + """
, l as (select qname, row_number() over (order by case when ref_index = -1 then 2147483647 else ref_index end,
               case when ref_index = -1 then 0 else pos end, qname, flag) - 1 as line_no from reads)
select b.line_no, b.qname, a.qname as prev_qname from l a join l b on b.line_no = a.line_no + 1 where b.qname < a.qname""")
def q_check_sort_order_queryname(spark, sf_dir):
    """A position-ordered file checked against name order."""
    lines = order.global_rank(_reads(spark, sf_dir), [*_coord_keys()[:2], "qname", "flag"], rank_col="line_no")
    bad = order.check_sort_order(lines, [F.col("qname")])
    return bad.select("line_no", "qname", "prev_qname")


# --- index statistics ---------------------------------------------------------------

@query("index_stats", W("reads", "contigs") + """
select k as ref_index, cast(sum(al) as bigint) as aligned, cast(sum(un) as bigint) as unaligned from (
 select case when ref_index = -1 or pos = 0 then -1 else ref_index end as k,
  case when (flag & 4) = 0 and ref_index is distinct from -1 and pos <> 0 then 1 else 0 end as al,
  case when (flag & 4) <> 0 or ref_index = -1 or pos = 0 then 1 else 0 end as un from reads
 union all select ref_index, 0, 0 from contigs union all select -1, 0, 0) group by k""")
def q_index_stats(spark, sf_dir):
    f = fx.load(spark, sf_dir)
    return stats.index_stats(f.reads, f.contigs)


@query("record_count", W("reads") + f"""
select count(*) as n_records, count(*) filter (where {KEPT_SQL}) as n_kept from reads""")
def q_record_count(spark, sf_dir):
    r = _reads(spark, sf_dir)
    kept = (F.col("flag").bitwiseAND(4) == 0) & (F.col("ref_index") > 0) & (F.col("ref_index") <= 24)
    return r.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(kept).alias("n_kept"))


@query("genome_length", W("reads", "contigs") + f"""
, obs as (select r.ref_index, cast(greatest(c.length, max({sql_end('r.pos', 'r.cigar', 'r.flag')})) as bigint) as length
          from reads r join contigs c on c.ref_index = r.ref_index group by r.ref_index, c.length)
select cast(sum(length) as bigint) as genome_length, count(*) as n_contigs from obs""")
def q_genome_length(spark, sf_dir):
    """Total length of the dictionary observed in the reads."""
    f = fx.load(spark, sf_dir)
    return stats.genome_length(lookups.observed_dictionary(f.reads, f.contigs))


def _sql_bin():
    from .records import _BIN_SQL
    return _BIN_SQL


_RANKED_SQL = W("reads") + f"""
, rk as (select *, cast(row_number() over (order by {COORD_SQL}) - 1 as bigint) as rank, {sql_end()} as e from reads)
"""


def _ranked(spark, sf_dir):
    return order.global_rank(_reads(spark, sf_dir), _coord_keys())


@query("bin_index", _RANKED_SQL + f"""
select ref_index, cast({_sql_bin()} as integer) as bin, min(rank) as first_rank, max(rank) as last_rank, count(*) as n
from rk where ref_index >= 0 and pos > 0 group by 1, 2""")
def q_bin_index(spark, sf_dir):
    return stats.bin_index(_ranked(spark, sf_dir))


_LINEAR_SQL = """
, pl as (select ref_index, rank,
                case when e = 0 then greatest(pos - 2, 0) >> 14 else greatest(pos - 1, 0) >> 14 end as w0,
                case when e = 0 then greatest(pos - 2, 0) >> 14 else greatest(e - 1, 0) >> 14 end as w1
         from rk where ref_index >= 0 and pos > 0),
per as (select ref_index, rank, unnest(range(w0, w1 + 1)) as win from pl),
mins as (select ref_index, win, min(rank) as min_rank from per group by 1, 2),
dense as (select ref_index, unnest(range(0, mw + 1)) as win from (select ref_index, max(win) as mw from mins group by 1)),
lin as (select d.ref_index, cast(d.win as integer) as "window",
         last_value(m.min_rank ignore nulls) over (partition by d.ref_index order by d.win rows between unbounded preceding and current row) as min_rank
       from dense d left join mins m on m.ref_index = d.ref_index and m.win = d.win)
"""


@query("linear_index", _RANKED_SQL + _LINEAR_SQL + "select * from lin")
def q_linear_index(spark, sf_dir):
    return stats.linear_index(_ranked(spark, sf_dir))


# Region for the chunk query (1-based inclusive).
_CQ = (3, 100_000, 500_000)


@query("coalesce_chunks", _RANKED_SQL + _LINEAR_SQL + f"""
, b as (select ref_index, cast({_sql_bin()} as integer) as bin, min(rank) as first_rank, max(rank) as last_rank
        from rk where ref_index >= 0 and pos > 0 group by 1, 2),
rb as (select 0 as bin
       union all select cast(1 + unnest(range(({_CQ[1]} - 1) >> 26, (({_CQ[2]} - 1) >> 26) + 1)) as integer)
       union all select cast(9 + unnest(range(({_CQ[1]} - 1) >> 23, (({_CQ[2]} - 1) >> 23) + 1)) as integer)
       union all select cast(73 + unnest(range(({_CQ[1]} - 1) >> 20, (({_CQ[2]} - 1) >> 20) + 1)) as integer)
       union all select cast(585 + unnest(range(({_CQ[1]} - 1) >> 17, (({_CQ[2]} - 1) >> 17) + 1)) as integer)
       union all select cast(4681 + unnest(range(({_CQ[1]} - 1) >> 14, (({_CQ[2]} - 1) >> 14) + 1)) as integer)),
ch as (select b.first_rank as s, b.last_rank + 1 as en from b join rb on rb.bin = b.bin
       where b.ref_index = {_CQ[0]} and b.last_rank + 1 > coalesce((select min_rank from lin where ref_index = {_CQ[0]} and "window" = ({_CQ[1]} - 1) >> 14), -1)),
o as (select *, max(en) over (order by s, en rows between unbounded preceding and 1 preceding) as pe from ch),
g as (select *, sum(case when pe is null or s > pe then 1 else 0 end) over (order by s, en rows between unbounded preceding and current row) as gid from o)
select min(s) as start, max(en) as "end" from g group by gid""")
def q_coalesce_chunks(spark, sf_dir):
    """Index plan of a region query: bins of the region -> chunks of those bins,
    minus chunks ending before the linear-index bound, merged."""
    ranked = _ranked(spark, sf_dir)
    ref, s, e = _CQ
    bins = spark.range(1).select(F.explode(co.region_bins(F.lit(s), F.lit(e))).alias("bin"))
    chunks = (stats.bin_index(ranked).filter(F.col("ref_index") == ref)
              .join(F.broadcast(bins), "bin", "left_semi")
              .select("ref_index", F.col("first_rank").alias("start"), (F.col("last_rank") + 1).alias("end")))
    lin = stats.linear_index(ranked).filter((F.col("ref_index") == ref)
                                            & (F.col("window") == (s - 1) >> 14))
    bounded = chunks.join(F.broadcast(lin.select("ref_index", "min_rank")), "ref_index", "left") \
        .withColumn("_min", F.coalesce("min_rank", F.lit(-1)))
    return stats.coalesce_chunks(bounded, F.col("_min"), key=["ref_index"]).select("start", "end")
