"""Queries: region queries, interval joins, lookups, mates, reference comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import coords as co
from ..functions import flags as fl
from ..operators import filters, intervals, lookups, reference
from ..session import scratch_path
from ..sources import header as hd
from ..sources import region_store
from .records import CE_SQL
from .registry import query, sql_end

W = fx.with_clause


def _f(spark, sf_dir):
    return fx.load(spark, sf_dir)


# --- single-region queries -------------------------------------------------------

_QEND = f"(case when {sql_end()} <= 0 then pos else {sql_end()} end)"


@query("query_overlapping", W("reads") + f"""
select qname, pos from reads where ref_index = 5 and pos <= 400000 and {_QEND} >= 100000""")
def q_query_overlapping(spark, sf_dir):
    return filters.query_overlapping(_f(spark, sf_dir).reads, 5, 100_000, 400_000).select("qname", "pos")


@query("query_contained", W("reads") + f"""
select qname, pos from reads where ref_index = 5 and pos >= 100000 and pos <= 400000 and {_QEND} <= 400000""")
def q_query_contained(spark, sf_dir):
    return filters.query_contained(_f(spark, sf_dir).reads, 5, 100_000, 400_000).select("qname", "pos")


@query("query_alignment_start", W("reads") + """
, s as (select ref_index, pos from reads where ref_index >= 0 and pos > 0 group by ref_index, pos having count(*) >= 2)
select r.qname, r.ref_index, r.pos from reads r join s on s.ref_index = r.ref_index and s.pos = r.pos""")
def q_query_alignment_start(spark, sf_dir):
    """Start-position queries for every (contig, start) that holds two or more
    records: the single-start filter applied to a whole set of starts at once,
    as a semi join on (contig, start)."""
    reads = _f(spark, sf_dir).reads
    starts = (reads.filter((F.col("ref_index") >= 0) & (F.col("pos") > 0))
              .groupBy("ref_index", "pos").count().filter(F.col("count") >= 2).drop("count"))
    return reads.join(starts, ["ref_index", "pos"], "left_semi").select("qname", "ref_index", "pos")


@query("query_unmapped", W("reads") + "select qname, flag from reads where ref_index = -1")
def q_query_unmapped(spark, sf_dir):
    return filters.query_unmapped(_f(spark, sf_dir).reads).select("qname", "flag")


@query("query_whole_contig", W("reads") + "select qname, pos from reads where ref_index = 11")
def q_query_whole_contig(spark, sf_dir):
    return filters.query_overlapping(_f(spark, sf_dir).reads, 11, 0, 0).select("qname", "pos")


@query("skip_secondary", W("pairs") + """
select qname, flag from (select qname, case when pos % 3 = 0 then flag | 256 else flag end as flag from pairs) where (flag & 256) = 0""")
def q_skip_secondary(spark, sf_dir):
    p = _f(spark, sf_dir).pairs.withColumn(
        "flag", F.when(F.col("pos") % 3 == 0, fl.set_bit("flag", fl.SECONDARY)).otherwise(F.col("flag")))
    return filters.skip_secondary(p).select("qname", "flag")


@query("region_to_bins", W("targets") + """
, t as (select name, start0, end0, start0 + 1 as s, end0 as e from targets)
select name, start0, end0, cast(0 as integer) as bin from t
union all select name, start0, end0, cast(1 + unnest(range((s - 1) >> 26, ((e - 1) >> 26) + 1)) as integer) as bin from t
union all select name, start0, end0, cast(9 + unnest(range((s - 1) >> 23, ((e - 1) >> 23) + 1)) as integer) as bin from t
union all select name, start0, end0, cast(73 + unnest(range((s - 1) >> 20, ((e - 1) >> 20) + 1)) as integer) as bin from t
union all select name, start0, end0, cast(585 + unnest(range((s - 1) >> 17, ((e - 1) >> 17) + 1)) as integer) as bin from t
union all select name, start0, end0, cast(4681 + unnest(range((s - 1) >> 14, ((e - 1) >> 14) + 1)) as integer) as bin from t""")
def q_region_to_bins(spark, sf_dir):
    t = _f(spark, sf_dir).targets
    return t.select("name", "start0", "end0",
                    F.explode(co.region_bins(F.col("start0") + 1, F.col("end0"))).alias("bin"))


# --- interval joins ------------------------------------------------------------------

_READ_IV = f"""
, ri as (select qname, ref_index, pos - 1 as start0, {sql_end()} as end0 from reads
         where (flag & 4) = 0 and ref_index > 0 and ref_index <= 24)
"""


def _read_intervals(spark, sf_dir):
    r = filters.keep_primary_contigs(_f(spark, sf_dir).reads)
    return r.select("qname", "ref_index", (F.col("pos") - 1).alias("start0"),
                    co.alignment_end("pos", "cigar", "flag").alias("end0"))


@query("interval_intersect", W("reads", "targets") + _READ_IV + """
select t.ref_index, cast(greatest(t.start0, ri.start0) as integer) as i_start0, cast(least(t.end0, ri.end0) as integer) as i_end0,
 t.name, ri.qname
from targets t join ri on t.ref_index = ri.ref_index and t.start0 < ri.end0 and ri.start0 < t.end0""")
def q_interval_intersect(spark, sf_dir):
    j = intervals.intersect(_f(spark, sf_dir).targets, _read_intervals(spark, sf_dir))
    return j.select(F.col("ref_index"), F.col("i_start0").cast("int").alias("i_start0"),
                    F.col("i_end0").cast("int").alias("i_end0"), F.col("b_name").alias("name"), "qname")


@query("interval_semi_join", W("reads", "targets") + _READ_IV + """
select qname, ref_index, start0 from ri where exists (select 1 from targets t where t.ref_index = ri.ref_index and t.start0 < ri.end0 and ri.start0 < t.end0)""")
def q_interval_semi_join(spark, sf_dir):
    return intervals.semi_join(_read_intervals(spark, sf_dir), _f(spark, sf_dir).targets) \
        .select("qname", "ref_index", "start0")


@query("interval_anti_join", W("reads", "targets") + _READ_IV + """
select qname, ref_index, start0 from ri where not exists (select 1 from targets t where t.ref_index = ri.ref_index and t.start0 < ri.end0 and ri.start0 < t.end0)""")
def q_interval_anti_join(spark, sf_dir):
    return intervals.anti_join(_read_intervals(spark, sf_dir), _f(spark, sf_dir).targets) \
        .select("qname", "ref_index", "start0")


_IN_TARGETS = """
select ri.qname, ri.ref_index, cast(ri.start0 + 1 as integer) as pos from ri
where exists (select 1 from targets t where t.ref_index = ri.ref_index and t.start0 < ri.end0 and ri.start0 < t.end0)"""


@query("query_regions", W("reads", "targets") + _READ_IV + _IN_TARGETS)
def q_query_regions(spark, sf_dir):
    """The records of all target regions at once (the ``-L`` interval list)."""
    hits = intervals.semi_join(_read_intervals(spark, sf_dir), _f(spark, sf_dir).targets)
    return hits.select("qname", "ref_index", (F.col("start0") + 1).cast("int").alias("pos"))


@query("query_regions_stored", W("reads", "targets") + _READ_IV + _IN_TARGETS)
def q_query_regions_stored(spark, sf_dir):
    """The same records from a store whose files are pruned by the regions."""
    f = _f(spark, sf_dir)
    path = scratch_path(spark, "regions.parquet")
    region_store.write_region_store(filters.keep_primary_contigs(f.reads), path)
    return region_store.read_regions(spark, path, f.targets).select("qname", "ref_index", "pos")


# --- lookups ---------------------------------------------------------------------------

@query("contig_lookup", W("reads", "contigs") + """
select r.qname, r.ref_index, c.ref_name, c.length as ref_length from reads r left join contigs c on c.ref_index = r.ref_index""")
def q_contig_lookup(spark, sf_dir):
    f = _f(spark, sf_dir)
    return lookups.contig_lookup(f.reads, f.contigs).select("qname", "ref_index", "ref_name", "ref_length")


_RG_OF_READ = "concat('rg', cast(cast(split_part(qname, '_', 2) as bigint) % 200 as varchar(20)))"


def _reads_with_rg(spark, sf_dir):
    r = _f(spark, sf_dir).reads
    part = F.split("qname", "_")[1].cast("long")
    return r.withColumn("rg", F.concat(F.lit("rg"), (part % 200).cast("string")))


_RG_SQL = """
, rgs as (select max(case when key = 'ID' then value end) as id, max(case when key = 'SM' then value end) as sm,
                 max(case when key = 'LB' then value end) as lb
          from firsts where rec_type = 'RG' group by ord)
"""


def _hdr_fields_sql():
    from .io import HDR_BODY
    return W("reads", "header_lines") + HDR_BODY


@query("read_group_lookup", _hdr_fields_sql()
       + _RG_SQL + f"""
select r.qname, {_RG_OF_READ} as rg, g.sm as rg_sm, g.lb as rg_lb from reads r left join rgs g on g.id = {_RG_OF_READ}""")
def q_read_group_lookup(spark, sf_dir):
    groups = lookups.read_groups_from_header(hd.header_table(_f(spark, sf_dir).header_lines))
    j = lookups.read_group_lookup(_reads_with_rg(spark, sf_dir), groups.select("id", "sm", "lb"))
    return j.select("qname", "rg", "rg_sm", "rg_lb")


@query("unknown_read_groups", _hdr_fields_sql()
       + _RG_SQL + f"""
select r.qname, {_RG_OF_READ} as rg from reads r where {_RG_OF_READ} not in (select id from rgs where id is not null)""")
def q_unknown_read_groups(spark, sf_dir):
    groups = lookups.read_groups_from_header(hd.header_table(_f(spark, sf_dir).header_lines))
    r = _reads_with_rg(spark, sf_dir)
    return r.join(F.broadcast(groups.select(F.col("id").alias("rg"))), "rg", "left_anti").select("qname", "rg")


@query("unknown_refs", W("reads", "contigs") + """
select qname, ref_index from reads r where ref_index >= 0 and not exists (select 1 from contigs c where c.ref_index = r.ref_index)""")
def q_unknown_refs(spark, sf_dir):
    f = _f(spark, sf_dir)
    r = f.reads.filter(F.col("ref_index") >= 0)
    return r.join(F.broadcast(f.contigs.select("ref_index")), "ref_index", "left_anti").select("qname", "ref_index")


@query("query_mate", W("pairs") + """
, e as (select *, case when (flag & 64) <> 0 then 1 when (flag & 128) <> 0 then 2 else 0 end as en from pairs where (flag & 1) <> 0)
select a.qname, a.flag, a.ref_index, a.pos, a.mate_pos, min(b.flag) as mate_flag, min(b.pos) as mate_found_pos, count(b.flag) as n_mates
from e a left join e b on a.qname = b.qname and b.en = (case a.en when 1 then 2 when 2 then 1 else -1 end)
 and b.pos = a.mate_pos and b.ref_index = a.ref_index
group by a.qname, a.flag, a.ref_index, a.pos, a.mate_pos""")
def q_query_mate(spark, sf_dir):
    return lookups.query_mate(_f(spark, sf_dir).pairs)


@query("compare_dictionaries", W("reads", "contigs") + f"""
, obs as (select r.ref_index, c.ref_name, cast(greatest(c.length, max({sql_end('r.pos', 'r.cigar', 'r.flag')})) as bigint) as length
          from reads r join contigs c on c.ref_index = r.ref_index group by r.ref_index, c.ref_name, c.length)
select coalesce(a.ref_index, b.ref_index) as ref_index, a.ref_name as a_name, b.ref_name as b_name,
 case when a.ref_name is null then 'missing_in_a' when b.ref_name is null then 'missing_in_b'
      when not (a.length = 0 or b.length = 0 or a.length = b.length) then 'length'
      when a.ref_name <> b.ref_name then 'name' else 'same' end as status
from contigs a full outer join obs b on a.ref_index = b.ref_index""")
def q_compare_dictionaries(spark, sf_dir):
    """The header dictionary vs the one observed in the reads (contig length
    stretched to the furthest read end)."""
    f = _f(spark, sf_dir)
    return lookups.compare_dictionaries(f.contigs, lookups.observed_dictionary(f.reads, f.contigs))


# --- reference comparisons ----------------------------------------------------------

_PER_BASE = CE_SQL + """
, pb as (select rid, read_start + i as ro, ref_start + i as p from (select rid, read_start, ref_start, unnest(range(length)) as i from blk)),
j as (select r.rid, r.flag, upper(substr(r.seq, pb.ro, 1)) as a, upper(substr(t.bases, cast(1 + (pb.p - 1) % 32 as integer), 1)) as g,
             ascii(substr(r.qual, pb.ro, 1)) - 33 as q
      from pb join rr r on r.rid = pb.rid join ref_tiles t on t.ref_index = r.ref_index and t.tile = (pb.p - 1) >> 5),
m as (select rid, a <> g as mm,
             a <> g and not (case when (flag & 16) <> 0 then g = 'G' and a = 'A' else g = 'C' and a = 'T' end) as mm_bs, q from j),
agg as (select rid, sum(case when mm then 1 else 0 end) as n, sum(case when mm_bs then 1 else 0 end) as nb,
               sum(case when mm then q else 0 end) as qs from m group by rid),
per as (select r.qname, r.flag, r.cigar, cast(coalesce(a.n, 0) as integer) as mismatches,
               cast(coalesce(a.nb, 0) as integer) as mismatches_bisulfite, cast(coalesce(a.qs, 0) as integer) as mismatch_qual_sum
        from rr r left join agg a on a.rid = r.rid where (r.flag & 4) = 0)
"""


def _mapped_reads(spark, sf_dir):
    return _f(spark, sf_dir).reads.filter(fl.is_mapped("flag"))


@query("count_mismatches", W("reads", "ref_tiles") + _PER_BASE + """
select qname, flag, mismatches, mismatches_bisulfite from per""")
def q_count_mismatches(spark, sf_dir):
    f = _f(spark, sf_dir)
    return reference.mismatch_stats(_mapped_reads(spark, sf_dir), f.ref_tiles, ["qname", "flag"]) \
        .select("qname", "flag", "mismatches", "mismatches_bisulfite")


@query("sum_mismatch_quals", W("reads", "ref_tiles") + _PER_BASE + """
select qname, mismatch_qual_sum from per""")
def q_sum_mismatch_quals(spark, sf_dir):
    f = _f(spark, sf_dir)
    return reference.mismatch_stats(_mapped_reads(spark, sf_dir), f.ref_tiles, ["qname"], with_quals=True) \
        .select("qname", "mismatch_qual_sum")


@query("nm_tag", W("reads", "ref_tiles") + _PER_BASE + r"""
select qname, cast(mismatches + coalesce(cast(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[ID]', 1),
   lambda x: cast(x as integer))) as integer), 0) as integer) as nm from per""")
def q_nm_tag(spark, sf_dir):
    f = _f(spark, sf_dir)
    return reference.mismatch_stats(_mapped_reads(spark, sf_dir), f.ref_tiles, ["qname"]).select("qname", "nm")

