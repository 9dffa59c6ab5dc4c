"""Queries: reports of what is wrong with lines, tags, mates, qualities and dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import bases as bs
from ..functions import tags as tg
from ..operators import islands, lookups, validate
from ..sources import sam
from .registry import query
from .validation import _rules_sql

W = fx.with_clause

_INT = "'[+-]?[0-9]+'"
_FLOAT = "'[+-]?(NaN|Infinity|([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)'"


def _num(i: int) -> str:
    return f"case when regexp_full_match(f[{i}], {_INT}) then try_cast(f[{i}] as integer) end"


_LINE_RULES = [
    ("n < 11", "MISSING_FIELD", "the 11 fixed columns are not complete"),
    ("len(list_filter(f, lambda x: length(x) = 0)) > 0", "EMPTY_FIELD", "a column is empty"),
    ("ok and flag is null", "INVALID_FLAG", "column FLAG holds no number"),
    ("ok and pos is null", "INVALID_ALIGNMENT_START", "column POS holds no number"),
    ("ok and mapq is null", "INVALID_MAPPING_QUALITY", "column MAPQ holds no number"),
    ("ok and mpos is null", "INVALID_MATE_ALIGNMENT_START", "column PNEXT holds no number"),
    ("ok and isize is null", "INVALID_INSERT_SIZE", "column TLEN holds no number"),
    ("ok and starts_with(rname, '=')", "INVALID_REFERENCE_INDEX", "RNAME cannot be ="),
    ("ok and rname <> '*' and string_split(rname, ' ')[1] not in (select ref_name from contigs)", "INVALID_REFERENCE_INDEX", "RNAME is not in the dictionary"),
    ("ok and mrnm not in ('*', '=') and string_split(mrnm, ' ')[1] not in (select ref_name from contigs)", "INVALID_MATE_REF_INDEX",
     "RNEXT is not in the dictionary"),
    ("ok and rname = '*' and (flag & 4) = 0", "MISSING_RNAME", "mapped, column RNAME is *"),
    ("ok and rname <> '*' and pos = 0", "INVALID_ALIGNMENT_START", "RNAME given, POS is 0"),
    ("ok and rname <> '*' and (flag & 4) = 0 and f[6] = '*'", "INVALID_CIGAR", "mapped to RNAME, CIGAR is *"),
    ("ok and rname = '*' and pos <> 0", "INVALID_ALIGNMENT_START", "RNAME is *, POS given"),
    ("ok and rname = '*' and mapq <> 0", "INVALID_MAPPING_QUALITY", "RNAME is *, MAPQ given"),
    ("ok and rname = '*' and f[6] <> '*'", "INVALID_CIGAR", "RNAME is *, CIGAR given"),
    ("ok and mrnm = '*' and (flag & 1) <> 0 and (flag & 8) = 0", "MISSING_MRNM", "mate mapped, column RNEXT is *"),
    ("ok and mrnm <> '*' and (flag & 1) = 0", "INVALID_MATE_REF_INDEX", "RNEXT given, read unpaired"),
    ("ok and mrnm = '=' and rname = '*'", "INVALID_MATE_REF_INDEX", "RNEXT copies an absent RNAME"),
    ("ok and mrnm <> '*' and mpos = 0", "INVALID_MATE_ALIGNMENT_START", "RNEXT given, PNEXT is 0"),
    ("ok and mrnm = '*' and mpos <> 0", "INVALID_MATE_ALIGNMENT_START", "RNEXT is *, PNEXT given"),
    ("ok and mrnm = '*' and isize <> 0", "INVALID_INSERT_SIZE", "RNEXT is *, TLEN given"),
    ("ok and f[10] <> '*' and not regexp_full_match(f[10], '[acmgrsvtwyhkdbnACMGRSVTWYHKDBN.=]+')", "INVALID_READ_BASES",
     "SEQ holds other characters than base codes"),
    ("ok and f[11] <> '*' and f[10] = '*'", "QUAL_WITHOUT_SEQ", "SEQ is *, QUAL given"),
    ("ok and f[11] <> '*' and f[10] <> '*' and length(f[11]) <> length(f[10])", "MISMATCH_READ_LENGTH_AND_QUALS_LENGTH",
     "SEQ and QUAL differ in length"),
]

_RANGE = " ".join(f"when '{k}' then len(list_filter(els, lambda x: not regexp_full_match(x, {_INT}) or coalesce(try_cast(x as hugeint) not between {lo} and {hi}, true))) > 0"
                  for k, (lo, hi) in tg.ARRAY_RANGES.items())

_LINES_SQL = f"""
, s as (select string_split(value, chr(9)) as f from tlines where not starts_with(value, '@')),
t as (select f[1] as qname, f, len(f) as n, len(f) >= 11 as ok, f[3] as rname, f[7] as mrnm, {_num(2)} as flag, {_num(4)} as pos, {_num(5)} as mapq,
 {_num(8)} as mpos, {_num(9)} as isize from s),
tags as (select qname, unnest(f[12:]) as tag from t),
parts as (select qname, tag, len(string_split(tag, ':')) >= 3 as three, split_part(tag, ':', 2) as ty,
 substr(tag, length(split_part(tag, ':', 1)) + length(split_part(tag, ':', 2)) + 3) as v from tags),
arrays as (select *, split_part(v, ',', 1) as el, strpos(v, ',') > 0 as comma,
 string_split(regexp_replace(substr(v, strpos(v, ',') + 1), ',+$', ''), ',') as els from parts),
bad as (select qname, tag, case when not three then 'a tag has three parts'
 when ty = 'Z' then null
 when ty = 'A' then case when length(v) <> 1 then 'A needs one character' end
 when ty = 'i' then case when not regexp_full_match(v, {_INT}) or try_cast(v as integer) is null then 'i needs a signed 32-bit integer' end
 when ty = 'f' then case when not regexp_full_match(v, {_FLOAT}) then 'f needs a float' end
 when ty = 'H' then case when not regexp_full_match(v, '([0-9A-Fa-f][0-9A-Fa-f])*') then 'H needs an even hex string' end
 when ty = 'B' then case when not comma or length(el) <> 1 then 'B needs element type and comma'
   when el = 'f' then case when len(list_filter(els, lambda x: not regexp_full_match(x, {_FLOAT}))) > 0 then 'B:f needs floats' end
   when el in ('c', 'C', 's', 'S', 'i', 'I') then case when case el {_RANGE} end then 'B element out of range' end
   else 'unrecognized array element type' end
 else 'unrecognized tag type' end as why from arrays)
{_rules_sql(_LINE_RULES, "t")}
union all select qname, 'INVALID_TAG', 'ERROR', tag || ': ' || why from bad where why is not null"""


@query("sam_line_errors", W("tlines", "contigs") + _LINES_SQL)
def q_sam_line_errors(spark, sf_dir):
    """All errors of all lines: fixed columns, numbers, contig names and tags."""
    f = fx.load(spark, sf_dir)
    return validate.line_report(f.tlines, f.contigs)


@query("write_sam_tag_types", W("sam_lines") + """
select value || chr(9) || 'XS:i:' || split_part(value, chr(9), 2) || chr(9) || 'XI:i:' || split_part(value, chr(9), 4) as value
from sam_lines""")
def q_write_sam_tag_types(spark, sf_dir):
    """Tags of the binary form's integer types are written as text with type i."""
    f = fx.load(spark, sf_dir)
    r = sam.parse_sam_lines(f.sam_lines, f.contigs)
    tags = tg.set_tag(tg.set_tag("tags", "XS", "S", F.col("flag")), "XI", "I", F.col("pos"))
    return sam.format_sam_lines(r.withColumn("tags", tags))


@query("query_mate_report", W("mpairs") + """
, m as (select *, row_number() over () as rid, (flag & 1) <> 0 as paired, (flag & 64) <> 0 as en1, (flag & 128) <> 0 as en2 from mpairs),
j as (select a.rid, a.qname, a.flag, a.ref_index, a.pos, a.mate_ref_index, a.mate_pos, a.paired, a.en1, a.en2,
  count(case when not b.paired then 1 end) as unpaired,
  count(case when b.paired and not (case when a.en1 then b.en1 else b.en2 end) then 1 end) as mates,
  min(case when b.paired and not (case when a.en1 then b.en1 else b.en2 end) then b.flag end) as mate
 from m a left join m b on b.qname = a.qname and b.ref_index = a.mate_ref_index and (a.mate_ref_index = -1 or b.pos = a.mate_pos)
 group by all),
o as (select *, case when not paired then 'UNPAIRED' when en1 = en2 then 'END_UNCLEAR' when unpaired > 0 then 'PAIRED_AND_UNPAIRED'
  when mates > 1 then 'SEVERAL_MATES' when mates = 1 then 'MATE' else 'NO_MATE' end as outcome from j)
select qname, flag, ref_index, pos, mate_ref_index, mate_pos, case when outcome = 'MATE' then mate end as mate_flag, outcome from o""")
def q_query_mate_report(spark, sf_dir):
    return lookups.mate_report(fx.load(spark, sf_dir).mpairs)


@query("fix_quality_errors", W("reads") + """
, q as (select qname, list_transform(string_split(qual, ''), lambda c: ascii(c) - 64) as over from reads)
select qname, cast(list_position(list_transform(over, lambda x: x < 0), true) as integer) as at,
 cast(list_filter(over, lambda x: x < 0)[1] as integer) as value from q where len(list_filter(over, lambda x: x < 0)) > 0""")
def q_fix_quality_errors(spark, sf_dir):
    """Reads whose qualities cannot be of the shifted encoding: the first one that falls under 0."""
    return bs.quality_errors(fx.load(spark, sf_dir).reads)


@query("compare_dictionaries_m5", W("contigs") + """
select ref_index, ref_name as a_name, case when ref_index % 5 = 1 then lower(ref_name) || 'x' else ref_name end as b_name,
 case when ref_index % 7 = 2 then 'length' when ref_index % 4 = 3 then 'name' when ref_index % 4 = 0 and ref_index % 5 = 1 then 'name' else 'same' end as status
from contigs""")
def q_compare_dictionaries_m5(spark, sf_dir):
    """Checksums decide where both sides have one (renamed contigs are the same, others are not)."""
    c = fx.load(spark, sf_dir).contigs
    i = F.col("ref_index")
    a = c.withColumn("m5", F.md5("ref_name"))
    b = c.select("ref_index", F.when(i % 5 == 1, F.concat(F.lower("ref_name"), F.lit("x"))).otherwise(F.col("ref_name")).alias("ref_name"),
                 F.when(i % 7 == 2, F.col("length") + 1).when(i % 7 == 3, F.lit(0).cast("long")).otherwise(F.col("length")).alias("length"),
                 F.when(i % 4 == 0, F.lit(None).cast("string")).when(i % 4 == 3, F.md5(F.lit("other"))).otherwise(F.md5("ref_name")).alias("m5"))
    return lookups.compare_dictionaries(a, b)


@query("merge_ranges_targets", W("targets", "contigs") + """
, r as (select c.ref_name, t.start0 + 1 as s, t.end0 as e from targets t join contigs c on c.ref_index = t.ref_index),
mw as (select *, max(e) over (partition by ref_name order by s, e rows between unbounded preceding and 1 preceding) as pm from r),
mf as (select *, sum(case when pm is null or s >= pm then 1 else 0 end) over (partition by ref_name order by s, e rows between unbounded preceding and current row) as gid from mw)
select min(ref_name) as name, cast(greatest(min(s), 1) as integer) as start, max(e) as "end" from mf group by ref_name, gid""")
def q_merge_ranges_targets(spark, sf_dir):
    """All target ranges merged without widening."""
    f = fx.load(spark, sf_dir)
    t = f.targets.join(F.broadcast(f.contigs.select("ref_index", "ref_name")), "ref_index")
    return islands.merge_ranges(t.select("ref_name", (F.col("start0") + 1).alias("start"), F.col("end0").alias("end")), 0)
