"""Queries: cleaning, duplicate marking, recalibration, depth, MD sites,
indel targets, region-file merging."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import flags as fl
from ..operators import covariates, islands, pileup, preprocess
from ..sources import text
from .io import _ISLANDS_SQL, _named_islands
from .records import CE_SQL, ce_sql
from .registry import query, sql_end, sql_sum_ops

W = fx.with_clause

_LEAD = r"regexp_extract(cigar, '^((\d+[SH])+)', 1)"
_TRAIL = r"regexp_extract(cigar, '((\d+[SH])+)$', 1)"


# --- clean_reads ----------------------------------------------------------------------

_CLEAN_SQL = W("reads", "contigs") + f"""
, j as materialized (select row_number() over () as rid, r.*, c.length as L, {sql_end('r.pos', 'r.cigar', 'r.flag')} as e from reads r left join contigs c on c.ref_index = r.ref_index),
beyond as (select * from j where (flag & 4) = 0 and L is not null and pos > L),
u as (select qname, cast((case when (flag & 16) <> 0 then flag & ~16 else flag end) & ~(1024 | 256 | 2) | 4 as integer) as flag,
             cast(-1 as integer) as ref_index, cast(0 as integer) as pos, cast(0 as integer) as mapq, '*' as cigar from beyond),
over as (select * from j where (flag & 4) = 0 and L is not null and pos <= L and e > L),
oe as (select rid, pos, L, regexp_extract_all(cigar, '\\d+[MIDNSHP=X]') as els from over),
ce as (select rid, pos, L, cast(i - 1 as integer) as idx, cast(regexp_extract(el, '(\\d+)', 1) as integer) as len,
              regexp_extract(el, '([MIDNSHP=X])', 1) as op
       from (select rid, pos, L, unnest(els) as el, generate_subscripts(els, 1) as i from oe)),
cs as (select *, pos + coalesce(sum(case when op in ('M','=','X','D','N') then len else 0 end)
          over (partition by rid order by idx rows between unbounded preceding and 1 preceding), 0) as g from ce),
pieces as (
  select rid, idx, 0 as sub, cast(greatest(0, least(len, L - g + 1)) as integer) as len, op from cs where op in ('M','=','X','D','N')
  union all select rid, idx, 1 as sub, cast(len - greatest(0, least(len, L - g + 1)) as integer) as len, 'S' as op from cs where op in ('M','=','X')
  union all select rid, idx, 0 as sub, len, case when g > L then 'S' else 'I' end as op from cs where op = 'I'
  union all select rid, idx, 0 as sub, len, op from cs where op in ('S','H','P')),
pc as (select * from pieces where len > 0),
pd as (select p.* from pc p where not (p.op in ('D','N') and not exists (select 1 from pc q where q.rid = p.rid
        and (q.idx > p.idx or (q.idx = p.idx and q.sub > p.sub)) and q.op in ('M','=','X','I')))),
pr as (select *, row_number() over (partition by rid order by idx, sub) as rn from pd),
pl as (select *, lag(op) over (partition by rid order by rn) as prev_op from pr),
pg as (select *, sum(case when prev_op is null or prev_op <> op then 1 else 0 end)
          over (partition by rid order by rn rows between unbounded preceding and current row) as grp from pl),
newc as (select rid, string_agg(cast(l as varchar) || op, '' order by grp) as cigar
         from (select rid, grp, op, sum(len) as l from pg group by rid, grp, op) group by rid)
select j.qname, j.flag, j.ref_index, j.pos,
 cast(case when (j.flag & 4) <> 0 then 0 else j.mapq end as integer) as mapq, coalesce(n.cigar, j.cigar) as cigar
from j left join newc n on n.rid = j.rid
where not ((j.flag & 4) = 0 and j.L is not null and j.pos > j.L)
union all select qname, flag, ref_index, pos, mapq, cigar from u"""


@query("clean_reads", _CLEAN_SQL)
def q_clean_reads(spark, sf_dir):
    f = fx.load(spark, sf_dir)
    return preprocess.clean_reads(f.reads, f.contigs).select("qname", "flag", "ref_index", "pos", "mapq", "cigar")


# --- duplicates ---------------------------------------------------------------------------

_DUP_SQL = W("reads", "pairs") + f"""
, u as (select qname, flag, ref_index, pos, cigar, qual from reads union all select qname, flag, ref_index, pos, cigar, qual from pairs),
m as (select qname, ref_index as r,
        case when (flag & 16) <> 0 then {sql_end()} + {sql_sum_ops(_TRAIL, 'SH')} else pos - {sql_sum_ops(_LEAD, 'SH')} end as p,
        (flag & 16) <> 0 as s,
        coalesce(list_sum(list_filter(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33), lambda q: q >= 15)), 0) as score
      from u where (flag & 4) = 0 and (flag & 2304) = 0),
pn as (select qname, count(*) as n, min({{'r': r, 'p': p, 's': s}}) as e1, max({{'r': r, 'p': p, 's': s}}) as e2, sum(score) as score
       from m group by qname),
bp as (select e1, e2, qname as best from (select *, row_number() over (partition by e1, e2 order by score desc, qname) as rn
        from pn where n >= 2) where rn = 1),
pdup as (select p.qname, p.qname <> b.best as dup from pn p join bp b on b.e1 = p.e1 and b.e2 = p.e2 where p.n >= 2),
pe as (select e1 as e from pn where n >= 2 union select e2 as e from pn where n >= 2),
bf as (select e1, qname as best from (select *, row_number() over (partition by e1 order by score desc, qname) as rn
        from pn where n = 1) where rn = 1),
fdup as (select f.qname, f.qname <> b.best or f.e1 in (select e from pe) as dup from pn f join bf b on b.e1 = f.e1 where f.n = 1),
d as (select * from pdup union all select * from fdup),
mk as (select u.qname, cast(case when (u.flag & 2304) <> 0 then u.flag when coalesce(d.dup, false) then u.flag | 1024 else u.flag & ~1024 end as integer) as flag
       from u left join d on d.qname = u.qname)
"""


def _marked(spark, sf_dir):
    f = fx.load(spark, sf_dir)
    cols = ["qname", "flag", "ref_index", "pos", "cigar", "qual"]
    u = f.reads.select(*cols).unionByName(f.pairs.select(*cols))
    return preprocess.mark_duplicates(u)


@query("mark_duplicates", _DUP_SQL + "select qname, flag from mk")
def q_mark_duplicates(spark, sf_dir):
    return _marked(spark, sf_dir).select("qname", "flag")


@query("duplicate_metrics", _DUP_SQL + """
, per as (select mk.qname, count(*) as n, max(case when (mk.flag & 1024) <> 0 then 1 else 0 end) as dup
          from mk where (mk.flag & 4) = 0 and (mk.flag & 2304) = 0 group by mk.qname)
select 'LIB1' as library, count(*) filter (where n = 1) as unpaired_examined, count(*) filter (where n >= 2) as pairs_examined,
 count(*) filter (where n = 1 and dup = 1) as unpaired_duplicates, count(*) filter (where n >= 2 and dup = 1) as pair_duplicates,
 round((count(*) filter (where n = 1 and dup = 1) + 2 * count(*) filter (where n >= 2 and dup = 1))
       / (count(*) filter (where n = 1) + 2 * count(*) filter (where n >= 2)), 6) as percent_duplication
from per""")
def q_duplicate_metrics(spark, sf_dir):
    return preprocess.duplicate_metrics(_marked(spark, sf_dir))


# --- BQSR ----------------------------------------------------------------------------------

_RG = "'rg' || cast(cast(split_part(qname, '_', 4) as integer) % 3 as varchar)"

_BASES_SQL = W("reads", "ref_tiles", "vcf_lines") + f"""
, mr as (select *, {_RG} as rg from reads where (flag & 4) = 0)
""" + ce_sql("mr") + """
, pb as (select rid, read_start + i as ro, ref_start + i as p from (select rid, read_start, ref_start, unnest(range(length)) as i from blk)),
kn as (select distinct cast(case substr(f[1], 4) when 'X' then 23 when 'Y' then 24 else try_cast(substr(f[1], 4) as integer) end as integer) as ref_index,
              cast(f[2] as integer) as pos from (select string_split(value, chr(9)) as f from vcf_lines)),
b as (select r.rg, r.flag, length(r.seq) as n, pb.ro, r.seq, r.ref_index, pb.p,
             upper(substr(r.seq, pb.ro, 1)) as a, upper(substr(t.bases, cast(1 + (pb.p - 1) % 32 as integer), 1)) as g,
             ascii(substr(r.qual, pb.ro, 1)) - 33 as q
      from pb join rr r on r.rid = pb.rid join ref_tiles t on t.ref_index = r.ref_index and t.tile = (pb.p - 1) >> 5),
c as (select rg, q, cast(case when (flag & 16) <> 0 then n - (ro - 1) else ro end as integer) as cycle,
             case when (flag & 16) <> 0 then case when ro <= n - 1 then reverse(translate(upper(substr(seq, ro, 2)), 'ACGTacgt', 'TGCAtgca')) end
                  else case when ro >= 2 then upper(substr(seq, ro - 1, 2)) end end as context, a, g
      from b where a <> 'N' and not exists (select 1 from kn where kn.ref_index = b.ref_index and kn.pos = b.p)),
t as (select rg, q, cycle, context, count(*) as observations, count(*) filter (where a <> g) as mismatches from c group by rg, q, cycle, context)
"""


def _bqsr_inputs(spark, sf_dir):
    f = fx.load(spark, sf_dir)
    r = f.reads.filter(fl.is_mapped("flag")).withColumn(
        "rg", F.concat(F.lit("rg"), (F.split("qname", "_")[3].cast("int") % 3).cast("string")))
    known = text.parse_vcf_lines(f.vcf_lines).select(F.col("chrom_num").alias("ref_index"), "pos") \
        .filter(F.col("ref_index").isNotNull()).distinct()
    return r, f.ref_tiles, known


@query("bqsr_table", _BASES_SQL + """
select rg, q, cycle, context, observations, mismatches,
 round(-10 * log10((mismatches + 1) / (observations + 2)), 4) as empirical_q from t""")
def q_bqsr_table(spark, sf_dir):
    r, tiles, known = _bqsr_inputs(spark, sf_dir)
    return preprocess.bqsr_table(r, tiles, known)


@query("bqsr_uncovered", _BASES_SQL + """
select rr.rg, count(*) as aligned, count(*) filter (where t.tile is null) as uncovered
from pb join rr on rr.rid = pb.rid left join ref_tiles t on t.ref_index = rr.ref_index and t.tile = (pb.p - 1) >> 5 and t.tile % 5 <> 2
group by rr.rg""")
def q_bqsr_uncovered(spark, sf_dir):
    """Aligned bases that a reference without every fifth tile does not hold."""
    r, tiles, _ = _bqsr_inputs(spark, sf_dir)
    return covariates.uncovered_bases(r, tiles.filter(F.col("tile") % 5 != 2))


_EQ = "-10 * log10((sum(mismatches) + 1) / (sum(observations) + 2))"


@query("bqsr_apply", _BASES_SQL + f"""
, g as (select rg, {_EQ} - sum(q * observations) / sum(observations) as d_rg from t group by rg),
dq as (select t.rg, t.q, {_EQ} - (t.q + g.d_rg) as d_q from t join g on g.rg = t.rg group by t.rg, t.q, g.d_rg),
bq as (select dq.rg, dq.q, dq.q + g.d_rg + dq.d_q as bb from dq join g on g.rg = dq.rg),
dc as (select t.rg, t.q, t.cycle, {_EQ} - bq.bb as d from t join bq on bq.rg = t.rg and bq.q = t.q group by t.rg, t.q, t.cycle, bq.bb),
dx as (select t.rg, t.q, t.context, {_EQ} - bq.bb as d from t join bq on bq.rg = t.rg and bq.q = t.q
       where t.context is not null group by t.rg, t.q, t.context, bq.bb),
ab as (select rid, qname, rg, flag, seq, length(seq) as n, unnest(range(1, length(seq) + 1)) as ro, qual from rr),
ac as (select rid, qname, rg, n, ro, ascii(substr(qual, ro, 1)) - 33 as q,
              cast(case when (flag & 16) <> 0 then n - (ro - 1) else ro end as integer) as cycle,
              case when (flag & 16) <> 0 then case when ro <= n - 1 then reverse(translate(upper(substr(seq, ro, 2)), 'ACGTacgt', 'TGCAtgca')) end
                   else case when ro >= 2 then upper(substr(seq, ro - 1, 2)) end end as context from ab),
nq as (select ac.rid, ac.qname, ac.ro,
              least(greatest(cast(round(ac.q + coalesce(g.d_rg, 0) + coalesce(dq.d_q, 0) + coalesce(dc.d, 0) + coalesce(dx.d, 0)) as integer), 1), 93) as nq
       from ac left join g on g.rg = ac.rg left join dq on dq.rg = ac.rg and dq.q = ac.q
       left join dc on dc.rg = ac.rg and dc.q = ac.q and dc.cycle = ac.cycle
       left join dx on dx.rg = ac.rg and dx.q = ac.q and dx.context = ac.context)
select qname, string_agg(chr(cast(nq + 33 as integer)), '' order by ro) as qual from nq group by rid, qname""")
def q_bqsr_apply(spark, sf_dir):
    r, tiles, known = _bqsr_inputs(spark, sf_dir)
    table = preprocess.bqsr_table(r, tiles, known)
    deltas = preprocess.recalibration_deltas(table)
    return preprocess.bqsr_apply(r, deltas).select("qname", "qual")


# --- depth, MD sites, indel targets, merged regions -------------------------------------------

@query("locus_depth", W("reads") + CE_SQL + """
, pb as (select b.rid, b.read_start + i as ro, b.ref_start + i as p from (select rid, read_start, ref_start, unnest(range(length)) as i from blk) b),
x as (select r.ref_index, pb.p as pos, upper(substr(r.seq, pb.ro, 1)) as base from pb join rr r on r.rid = pb.rid)
select ref_index, cast(pos as integer) as pos, count(*) as depth, count(*) filter (where base = 'A') as n_a,
 count(*) filter (where base = 'C') as n_c, count(*) filter (where base = 'G') as n_g, count(*) filter (where base = 'T') as n_t,
 count(*) filter (where base not in ('A','C','G','T')) as n_n
from x group by ref_index, pos""")
def q_locus_depth(spark, sf_dir):
    return pileup.locus_depth(fx.load(spark, sf_dir).reads)


_MD_TOK = r"regexp_extract_all(md, '(\d+|\^[A-Za-z]+|[A-Za-z])', 1)"


@query("md_sites", W("reads_md") + f"""
, rm as materialized (select row_number() over () as rid, * from reads_md),
tok as (select rid, unnest({_MD_TOK}) as t, generate_subscripts({_MD_TOK}, 1) as ti from rm where cigar <> '*'),
tw as (select *, case when regexp_full_match(t, '\\d+') then cast(t as integer) when starts_with(t, '^') then length(t) - 1 else 1 end as w from tok),
tor as (select *, coalesce(sum(w) over (partition by rid order by ti rows between unbounded preceding and 1 preceding), 0) as o from tw),
ev as (select rid, 'X' as kind, upper(t) as base, o as off from tor where not regexp_full_match(t, '\\d+') and not starts_with(t, '^')
       union all select rid, 'D' as kind, upper(substr(t, i + 1, 1)) as base, o + i - 1 as off
       from (select *, unnest(range(1, length(t))) as i from tor where starts_with(t, '^'))),
els as (select rid, pos, regexp_extract_all(cigar, '\\d+[MIDNSHP=X]') as els from rm where cigar <> '*'),
ce as (select rid, pos, cast(i - 1 as integer) as idx, cast(regexp_extract(el, '(\\d+)', 1) as integer) as len,
              regexp_extract(el, '([MIDNSHP=X])', 1) as op
       from (select rid, pos, unnest(els) as el, generate_subscripts(els, 1) as i from els)),
cs as (select *, coalesce(sum(case when op in ('M','=','X','D') then len else 0 end) over (partition by rid order by idx rows between unbounded preceding and 1 preceding), 0) as md,
              pos + coalesce(sum(case when op in ('M','=','X','D','N') then len else 0 end) over (partition by rid order by idx rows between unbounded preceding and 1 preceding), 0) as g
       from ce),
seg as (select rid, md, g, len from cs where op in ('M','=','X','D')),
okq as (select a.rid from (select rid, sum(w) as l from tw group by rid) a
        join (select rid, sum(len) as l from seg group by rid) b on a.rid = b.rid where a.l = b.l)
select r.ref_index, cast(s.g + e.off - s.md as integer) as locus, e.base, e.kind, count(*) as n
from ev e join okq k on k.rid = e.rid join seg s on s.rid = e.rid and e.off >= s.md and e.off < s.md + s.len
join rm r on r.rid = e.rid group by 1, 2, 3, 4""")
def q_md_sites(spark, sf_dir):
    sites, _errors = preprocess.md_sites(fx.load(spark, sf_dir).reads_md)
    return sites


@query("indel_target_intervals", W("reads", "contigs") + f"""
, rr as materialized (select row_number() over () as rid, * from reads),
els as (select rid, ref_index, pos, regexp_extract_all(cigar, '\\d+[MIDNSHP=X]') as els from rr where (flag & 4) = 0 and ref_index >= 0),
ce as (select rid, ref_index, pos, cast(i - 1 as integer) as idx, cast(regexp_extract(el, '(\\d+)', 1) as integer) as len,
              regexp_extract(el, '([MIDNSHP=X])', 1) as op
       from (select rid, ref_index, pos, unnest(els) as el, generate_subscripts(els, 1) as i from els)),
cs as (select *, pos + coalesce(sum(case when op in ('M','=','X','D','N') then len else 0 end)
          over (partition by rid order by idx rows between unbounded preceding and 1 preceding), 0) as g from ce),
iv as (select ref_index, g - {preprocess.INDEL_WINDOW} as s, g - 1 + {preprocess.INDEL_WINDOW} as e from cs where op = 'I'
       union all select ref_index, g - {preprocess.INDEL_WINDOW} as s, g + len - 1 + {preprocess.INDEL_WINDOW} as e from cs where op = 'D'),
w as (select *, max(e) over (partition by ref_index order by s, e rows between unbounded preceding and 1 preceding) as pm from iv),
f as (select *, sum(case when pm is null or s > pm + 1 then 1 else 0 end) over (partition by ref_index order by s, e rows between unbounded preceding and current row) as iid from w),
i as (select ref_index, greatest(min(s), 1) as s, max(e) as e, count(*) as n from f group by ref_index, iid)
select i.ref_index, cast(i.s as integer) as island_start,
 cast(case when c.length is null then i.e else least(i.e, greatest(c.length, i.s)) end as integer) as island_end, n as n_events
from i left join contigs c on c.ref_index = i.ref_index""")
def q_indel_target_intervals(spark, sf_dir):
    f = fx.load(spark, sf_dir)
    return preprocess.indel_target_intervals(f.reads, contigs=f.contigs)


_OVERLAP = 150


@query("merge_ranges_overlap", W("reads", "contigs") + _ISLANDS_SQL + f"""
, mo as (select ref_name, lower(ref_name) as k, s - {_OVERLAP} as s2, e from named),
mw as (select *, max(e) over (partition by k order by s2, e rows between unbounded preceding and 1 preceding) as pm from mo),
mf as (select *, sum(case when pm is null or s2 >= pm then 1 else 0 end) over (partition by k order by s2, e rows between unbounded preceding and current row) as gid from mw)
select arg_min(ref_name, s2) as name, cast(greatest(min(s2), 1) as integer) as start, max(e) as "end" from mf group by k, gid""")
def q_merge_ranges_overlap(spark, sf_dir):
    """Coverage islands written as a region file with a {overlap}-base overlap."""
    named = _named_islands(spark, sf_dir)
    return islands.merge_ranges(named, _OVERLAP)
