"""Queries: per-record projections (flags, CIGAR, coordinates, bins, bases, tags)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import bases as bs
from ..functions import cigar as cg
from ..functions import coords as co
from ..functions import flags as fl
from ..functions import tags as tg
from ..operators import records as rec
from .registry import query, sql_end, sql_sum_ops

W = fx.with_clause


def _reads(spark, sf_dir):
    return fx.load(spark, sf_dir).reads


def _mapped(spark, sf_dir):
    return _reads(spark, sf_dir).filter(fl.is_mapped("flag"))


def ce_sql(table: str = "reads", where: str = "(flag & 4) = 0") -> str:
    """DuckDB CTEs over ``table``: ``rr`` (rows with a row id ``rid``, so
    records sharing a name stay apart), ``ce`` (CIGAR elements), ``cs``
    (cumulative read / reference offsets) and ``blk`` (gapless aligned blocks)."""
    return f""", rr as materialized (select row_number() over () as rid, * from {table}),
els as (select rid, qname, pos, regexp_extract_all(cigar, '\\d+[MIDNSHP=X]') as els from rr where {where}),
ce as (select rid, qname, pos, cast(i - 1 as integer) as idx, cast(regexp_extract(el, '(\\d+)', 1) as integer) as len,
              regexp_extract(el, '([MIDNSHP=X])', 1) as op
       from (select rid, qname, pos, unnest(els) as el, generate_subscripts(els, 1) as i from els)),
cs as (select *, coalesce(sum(case when op in ('M','I','S','=','X') then len else 0 end) over (partition by rid order by idx rows between unbounded preceding and 1 preceding), 0) as rd,
              coalesce(sum(case when op in ('M','D','N','=','X') then len else 0 end) over (partition by rid order by idx rows between unbounded preceding and 1 preceding), 0) as rf
       from ce),
blk as (select rid, qname, cast(row_number() over (partition by rid order by idx) - 1 as integer) as block,
               cast(1 + rd as integer) as read_start, cast(pos + rf as integer) as ref_start, len as length
        from cs where op in ('M','=','X'))
"""


CE_SQL = ce_sql()


@query("decode_flags", W("reads") + """
select qname, flag,
 (flag & 1) <> 0 as paired,
 case when (flag & 1) <> 0 then (flag & 2) <> 0 end as proper_pair,
 (flag & 4) <> 0 as unmapped,
 case when (flag & 1) <> 0 then (flag & 8) <> 0 end as mate_unmapped,
 (flag & 16) <> 0 as reverse,
 case when (flag & 1) <> 0 then (flag & 32) <> 0 end as mate_reverse,
 case when (flag & 1) <> 0 then (flag & 64) <> 0 end as first_of_pair,
 case when (flag & 1) <> 0 then (flag & 128) <> 0 end as second_of_pair,
 (flag & 256) <> 0 as secondary, (flag & 512) <> 0 as qc_fail, (flag & 1024) <> 0 as duplicate
from reads""")
def q_decode_flags(spark, sf_dir):
    return _reads(spark, sf_dir).select("qname", "flag", *fl.decode_all("flag"))


@query("set_flags", W("reads") + """
select qname, flag, cast(flag | 1024 as integer) as flag_dup, cast(flag & ~16 as integer) as flag_fwd,
 cast(case when mapq < 20 then flag | 512 else flag & ~512 end as integer) as flag_qc
from reads""")
def q_set_flags(spark, sf_dir):
    r = _reads(spark, sf_dir)
    return r.select("qname", "flag",
                    fl.set_bit("flag", fl.DUPLICATE).alias("flag_dup"),
                    fl.set_bit("flag", fl.REVERSE, False).alias("flag_fwd"),
                    fl.set_bit("flag", fl.QC_FAIL, F.col("mapq") < 20).alias("flag_qc"))


@query("parse_cigar", W("reads") + r"""
select qname, cigar, (cigar = '*' or regexp_matches(cigar, '^([0-9]+[MIDNSHP=X])+$')) as well_formed,
 cast(len(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')) as integer) as n_elements,
 regexp_replace(regexp_replace(cigar, '[0-9]', '', 'g'), '\*', '', 'g') as ops,
 array_to_string(regexp_extract_all(cigar, '(\d+)[MIDNSHP=X]', 1), ',') as lens,
 array_to_string(regexp_extract_all(cigar, '\d+[MIDNSHP=X]'), '') as rebuilt
from reads""")
def q_parse_cigar(spark, sf_dir):
    r = _reads(spark, sf_dir)
    els = cg.elements("cigar")
    return r.select("qname", "cigar", cg.is_well_formed("cigar").alias("well_formed"),
                    cg.element_count("cigar").alias("n_elements"), cg.op_string("cigar").alias("ops"),
                    F.array_join(F.transform(els, lambda e: e["len"].cast("string")), ",").alias("lens"),
                    F.array_join(F.transform(els, lambda e: F.concat(e["len"].cast("string"), e["op"])), "")
                    .alias("rebuilt"))


@query("explode_cigar", W("reads") + CE_SQL + """
select qname, idx, len, op, op in ('M','I','S','=','X') as consumes_read, op in ('M','D','N','=','X') as consumes_ref
from ce""")
def q_explode_cigar(spark, sf_dir):
    return rec.explode_cigar(_mapped(spark, sf_dir)).select(
        "qname", "idx", "len", "op", "consumes_read", "consumes_ref")


@query("cigar_lengths", W("reads") + f"""
select qname, {sql_sum_ops('cigar', 'MDN=X')} as ref_length, {sql_sum_ops('cigar', 'MDN=XP')} as padded_ref_length,
 {sql_sum_ops('cigar', 'MIS=X')} as read_length,
 cast(len(regexp_extract_all(cigar, '\\d+[MIDNSHP=X]')) as integer) as element_count
from reads""")
def q_cigar_lengths(spark, sf_dir):
    return _reads(spark, sf_dir).select(
        "qname", cg.ref_length("cigar").alias("ref_length"),
        cg.padded_ref_length("cigar").alias("padded_ref_length"),
        cg.read_length("cigar").alias("read_length"), cg.element_count("cigar").alias("element_count"))


@query("cigar_indel_bases", W("reads") + f"""
select qname, {sql_sum_ops('cigar', 'I')} as inserted_bases, {sql_sum_ops('cigar', 'D')} as deleted_bases from reads""")
def q_cigar_indel_bases(spark, sf_dir):
    return _reads(spark, sf_dir).select("qname", cg.inserted_bases("cigar").alias("inserted_bases"),
                                        cg.deleted_bases("cigar").alias("deleted_bases"))


@query("cigar_maps_no_bases", W("reads") + """
select qname, cigar, not regexp_matches(cigar, '[M=X]') as maps_no_bases from reads""")
def q_cigar_maps_no_bases(spark, sf_dir):
    return _reads(spark, sf_dir).select("qname", "cigar", cg.maps_no_bases("cigar").alias("maps_no_bases"))


@query("alignment_end", W("reads") + f"""
select qname, pos, cast({sql_end()} as integer) as alignment_end from reads""")
def q_alignment_end(spark, sf_dir):
    return _reads(spark, sf_dir).select("qname", "pos",
                                        co.alignment_end("pos", "cigar", "flag").alias("alignment_end"))


_LEAD = r"regexp_extract(cigar, '^((\d+[SH])+)', 1)"
_TRAIL = r"regexp_extract(cigar, '((\d+[SH])+)$', 1)"


@query("unclipped_coords", W("reads") + f"""
select qname, cast(pos - {sql_sum_ops(_LEAD, 'SH')} as integer) as unclipped_start,
 cast({sql_end()} + {sql_sum_ops(_TRAIL, 'SH')} as integer) as unclipped_end
from reads where (flag & 4) = 0""")
def q_unclipped_coords(spark, sf_dir):
    r = _mapped(spark, sf_dir)
    end = co.alignment_end("pos", "cigar", "flag")
    return r.select("qname", co.unclipped_start("pos", "cigar").alias("unclipped_start"),
                    co.unclipped_end(end, "cigar").alias("unclipped_end"))


@query("alignment_blocks", W("reads") + CE_SQL + "select qname, block, read_start, ref_start, length from blk")
def q_alignment_blocks(spark, sf_dir):
    return rec.explode_blocks(_mapped(spark, sf_dir)).select(
        "qname", "block", "read_start", "ref_start", "length")


@query("ref_position_at_read_offset", W("reads") + CE_SQL + """
, q as (select rid, qname, cast(1 + pos % 32 as integer) as read_offset from rr where (flag & 4) = 0)
select q.qname, q.read_offset, cast(coalesce(max(b.ref_start + q.read_offset - b.read_start), 0) as integer) as ref_pos
from q left join blk b on b.rid = q.rid and q.read_offset between b.read_start and b.read_start + b.length - 1
group by q.rid, q.qname, q.read_offset""")
def q_ref_position_at_read_offset(spark, sf_dir):
    r = _mapped(spark, sf_dir).withColumn("read_offset", (1 + F.col("pos") % 32).cast("int"))
    return r.select("qname", "read_offset",
                    rec.ref_position_at_read_offset("cigar", "pos", "read_offset").alias("ref_pos"))


def _sql_reg2bin(b: str, e: str) -> str:
    # b: 0-based start, e: 0-based exclusive end
    parts = [f"when ({b}) >> {s} = (({e}) - 1) >> {s} then {first} + (({b}) >> {s})"
             for s, first in [(14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)]]
    return "(case " + " ".join(parts) + " else 0 end)"


_BIN_SQL = _sql_reg2bin("pos - 1", f"case when {sql_end()} <= 0 then pos else {sql_end()} end")


@query("indexing_bin", W("reads") + f"""
select qname, cast({_BIN_SQL} as integer) as bin from reads""")
def q_indexing_bin(spark, sf_dir):
    r = _reads(spark, sf_dir)
    end = co.alignment_end("pos", "cigar", "flag")
    return r.select("qname", co.indexing_bin("pos", end).alias("bin"))


@query("linear_window", W("reads") + """
select qname, cast(greatest(pos - 1, 0) >> 14 as integer) as window from reads""")
def q_linear_window(spark, sf_dir):
    return _reads(spark, sf_dir).select("qname", co.linear_window("pos").alias("window"))


@query("bin_geometry", W("reads") + f"""
, b as (select distinct cast({_BIN_SQL} as integer) as bin from reads),
l as (select bin, case when bin >= 4681 then 5 when bin >= 585 then 4 when bin >= 73 then 3 when bin >= 9 then 2 when bin >= 1 then 1 else 0 end as level from b)
select bin, cast(level as integer) as level,
 cast((bin - [0,1,9,73,585,4681][level + 1]) * (1 << (29 - 3*level)) + 1 as integer) as first_locus,
 cast((bin - [0,1,9,73,585,4681][level + 1]) * (1 << (29 - 3*level)) + (1 << (29 - 3*level)) as integer) as last_locus
from l""")
def q_bin_geometry(spark, sf_dir):
    r = _reads(spark, sf_dir)
    end = co.alignment_end("pos", "cigar", "flag")
    bins = r.select(co.indexing_bin("pos", end).alias("bin")).distinct()
    return bins.select("bin", co.bin_level("bin").cast("int").alias("level"),
                       co.bin_first_locus("bin").cast("int").alias("first_locus"),
                       co.bin_last_locus("bin").cast("int").alias("last_locus"))


@query("interval_math", W("pairs") + """
select qname, flag, cast(pos + 31 - pos + 1 as integer) as length,
 (pos <= mate_pos + 31 and mate_pos <= pos + 31) as overlaps,
 (mate_pos >= pos and mate_pos + 31 <= pos + 31) as encloses,
 cast(greatest(0, least(pos + 31, mate_pos + 31) - greatest(pos, mate_pos) + 1) as integer) as overlap_length,
 cast(pos + 31 - 10 + 1 as integer) as start_from_end, cast(pos + 10 - 1 as integer) as end_from_start,
 cast(case when (flag & 16) <> 0 then 32 - 5 else 5 + 1 end as integer) as cycle
from pairs""")
def q_interval_math(spark, sf_dir):
    p = fx.load(spark, sf_dir).pairs
    s1, e1 = F.col("pos"), F.col("pos") + 31
    s2, e2 = F.col("mate_pos"), F.col("mate_pos") + 31
    return p.select("qname", "flag", co.interval_length(s1, e1).alias("length"),
                    co.overlaps(s1, e1, s2, e2).alias("overlaps"),
                    co.encloses(s1, e1, s2, e2).alias("encloses"),
                    co.overlap_length(s1, e1, s2, e2).alias("overlap_length"),
                    co.start_from_end(e1, F.lit(10)).alias("start_from_end"),
                    co.end_from_start(s1, F.lit(10)).alias("end_from_start"),
                    co.sequencing_cycle(F.lit(5), F.lit(32), fl.has("flag", fl.REVERSE)).alias("cycle"))


@query("synthesize_cigar", W("reads") + """
, a as (select qname, cast(pos % 40 - 5 as integer) as s, 32 as rl, cast(20 + mapq % 30 as integer) as gl,
               cast(1 + mapq % 10 as integer) as ip, cast(mapq % 5 - 2 as integer) as il from reads where (flag & 4) = 0),
b as (select *, range(s, s + rl) as spot, range(s, s + ip) as spot1, range(s + ip + greatest(-il, 0), s + rl - il) as spot2 from a),
c as (select *, len(list_filter(spot, lambda x: x < 1)) as lo, len(list_filter(spot, lambda x: x between 1 and gl)) as mid, len(list_filter(spot, lambda x: x > gl)) as hi,
             len(list_filter(spot1, lambda x: x < 1)) as lo1, len(list_filter(spot1, lambda x: x between 1 and gl)) as mid1,
             len(list_filter(spot2, lambda x: x between 1 and gl)) as mid2, len(list_filter(spot2, lambda x: x > gl)) as hi2 from b)
select qname, s as align_start, gl as ref_length, ip as indel_pos, il as indel_len,
 case when mid > 0 then concat(case when lo > 0 then lo || 'S' else '' end, mid, 'M', case when hi > 0 then hi || 'S' else '' end) end as cigar,
 case when mid <= 0 then 'off_contig' end as reason,
 case when il <> 0 and mid1 > 0 and mid2 > 0 then concat(case when lo1 > 0 then lo1 || 'S' else '' end, mid1, 'M',
   abs(il), case when il > 0 then 'I' else 'D' end, mid2, 'M', case when hi2 > 0 then hi2 || 'S' else '' end) end as cigar_indel,
 case when il = 0 then null when mid1 <= 0 and mid2 <= 0 then 'off_contig' when mid1 <= 0 then 'no_base_before_indel'
      when mid2 <= 0 then 'no_base_after_indel' end as reason_indel
from c""")
def q_synthesize_cigar(spark, sf_dir):
    r = _mapped(spark, sf_dir).select(
        "qname", (F.col("pos") % 40 - 5).cast("int").alias("align_start"),
        (20 + F.col("mapq") % 30).cast("int").alias("ref_length"),
        (1 + F.col("mapq") % 10).cast("int").alias("indel_pos"),
        (F.col("mapq") % 5 - 2).cast("int").alias("indel_len"))
    return r.select("qname", "align_start", "ref_length", "indel_pos", "indel_len",
                    rec.clipped_cigar("align_start", F.lit(32), "ref_length").alias("cigar"),
                    rec.clip_reason("align_start", F.lit(32), "ref_length").alias("reason"),
                    F.when(F.col("indel_len") != 0, rec.clipped_indel_cigar(
                        "align_start", F.lit(32), "ref_length", "indel_pos", "indel_len")).alias("cigar_indel"),
                    F.when(F.col("indel_len") != 0, rec.clip_reason(
                        "align_start", F.lit(32), "ref_length", "indel_pos", "indel_len")).alias("reason_indel"))


_QS = "list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)"


@query("phred_decode", W("reads") + f"""
select qname, cast(list_sum({_QS}) as integer) as q_sum, cast(list_min({_QS}) as integer) as q_min,
 cast(list_max({_QS}) as integer) as q_max, cast(len({_QS}) as integer) as q_len from reads""")
def q_phred_decode(spark, sf_dir):
    q = bs.phred_decode("qual")
    return _reads(spark, sf_dir).select(
        "qname", F.aggregate(q, F.lit(0), lambda a, x: a + x).alias("q_sum"),
        F.array_min(q).alias("q_min"), F.array_max(q).alias("q_max"), F.size(q).alias("q_len"))


@query("phred_encode", W("reads") + f"""
select qname, array_to_string(list_transform({_QS}, lambda x: chr(least(x + 5, 93) + 33)), '') as shifted,
 array_to_string(list_transform({_QS}, lambda x: chr(x + 33)), '') = qual as roundtrip
from reads""")
def q_phred_encode(spark, sf_dir):
    # decoded once for both columns
    q = _reads(spark, sf_dir).select("qname", "qual", bs.phred_decode("qual").alias("q"))
    return q.select(
        "qname", bs.phred_encode(F.transform("q", lambda x: F.least(x + 5, F.lit(93)))).alias("shifted"),
        (bs.phred_encode("q") == F.col("qual")).alias("roundtrip"))


@query("original_qualities", W("reads") + """
select qname, case when mapq % 3 = 0 then cast(list_sum(list_transform(string_split(reverse(qual), ''), lambda c: ascii(c) - 33)) as integer) end as oq_sum
from reads""")
def q_original_qualities(spark, sf_dir):
    r = _reads(spark, sf_dir).withColumn("tags", F.create_map().cast(tg.TAGS_TYPE))
    r = r.withColumn("tags", F.when(F.col("mapq") % 3 == 0, tg.set_tag("tags", "OQ", "Z", F.reverse("qual")))
                     .otherwise(F.col("tags")))
    oq = rec.original_qualities("tags")
    return r.select("qname", F.aggregate(oq, F.lit(0), lambda a, x: a + x).alias("oq_sum"))


@query("normalize_bases", W("reads") + """
select qname, replace(upper(replace(lower(seq), 'n', '.')), '.', 'N') as normalized from reads""")
def q_normalize_bases(spark, sf_dir):
    r = _reads(spark, sf_dir)
    messy = F.regexp_replace(F.lower("seq"), "n", ".")
    return r.select("qname", bs.normalize_bases(messy).alias("normalized"))


@query("base_predicates", W("reads") + """
select qname, cast(length(regexp_replace(seq, '[^Nn.]', '', 'g')) as integer) as n_nocall,
 length(regexp_replace(seq, '[ACGTacgt]', '', 'g')) = 0 as all_valid,
 upper(substr(seq, 1, 1)) = upper(lower(substr(seq, 32, 1))) as first_eq_last
from reads""")
def q_base_predicates(spark, sf_dir):
    r = _reads(spark, sf_dir)
    return r.select("qname", bs.no_call_count("seq").alias("n_nocall"),
                    (bs.invalid_base_count("seq") == 0).alias("all_valid"),
                    bs.bases_equal(F.substring("seq", 1, 1), F.lower(F.substring("seq", 32, 1)))
                    .alias("first_eq_last"))


@query("gc_fraction", W("reads") + """
select qname, round(length(regexp_replace(seq, '[^GCgc]', '', 'g')) / length(seq), 6) as gc from reads""")
def q_gc_fraction(spark, sf_dir):
    return _reads(spark, sf_dir).select("qname", F.round(bs.gc_fraction("seq"), 6).alias("gc"))


@query("reverse_complement", W("reads") + """
select qname, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) as rc from reads""")
def q_reverse_complement(spark, sf_dir):
    return _reads(spark, sf_dir).select("qname", bs.reverse_complement("seq").alias("rc"))


@query("reverse_record", W("reads") + """
select qname, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) as seq, reverse(qual) as qual,
 case when mapq % 2 = 0 then qual end as oq,
 case when mapq % 5 = 0 then reverse(translate(substr(seq, 1, 8), 'ACGTacgt', 'TGCAtgca')) end as e2
from reads where (flag & 16) <> 0""")
def q_reverse_record(spark, sf_dir):
    r = _reads(spark, sf_dir).filter(fl.has("flag", fl.REVERSE))
    t = F.create_map().cast(tg.TAGS_TYPE)
    t = F.when(F.col("mapq") % 2 == 0, tg.set_tag(t, "OQ", "Z", F.reverse("qual"))).otherwise(t)
    t = F.when(F.col("mapq") % 5 == 0, tg.set_tag(t, "E2", "Z", F.substring("seq", 1, 8))).otherwise(t)
    out = rec.reverse_record(r.withColumn("tags", t))
    return out.select("qname", "seq", "qual", tg.tag_string("tags", "OQ").alias("oq"),
                      tg.tag_string("tags", "E2").alias("e2"))


_SQ = "cast(('0x' || substr(md5(qname), 1, 2)) as integer)"


@query("sq_tag_decode", W("reads") + f"""
, s as (select qname, {_SQ} as sq from reads)
select qname, sq, substr('ACGT', (sq >> 6) + 1, 1) as sq_base, cast(sq & 63 as integer) as sq_ratio,
 cast(((3 - (sq >> 6)) << 6) | (sq & 63) as integer) as sq_complement,
 cast(least(round(-10 * log10(((1 + sq % 50) / 100.0 / (1 + sq % 7)) / ((1 + sq % 50) / 100.0))), 63) as integer) as scaled
from s""")
def q_sq_tag_decode(spark, sf_dir):
    s = _reads(spark, sf_dir).select(
        "qname", F.conv(F.substring(F.md5("qname"), 1, 2), 16, 10).cast("int").alias("sq"))
    second = (1 + F.col("sq") % 50) / 100.0
    return s.select("qname", "sq", bs.sq_base("sq").alias("sq_base"),
                    bs.sq_prob_ratio("sq").alias("sq_ratio"), bs.sq_complement("sq").alias("sq_complement"),
                    bs.sq_scaled_ratio(second, second / (1 + F.col("sq") % 7)).alias("scaled"))


@query("make_unmapped", W("reads") + """
select qname, cast((case when (flag & 16) <> 0 then flag & ~16 else flag end) & ~(1024 | 256 | 2) | 4 as integer) as flag,
 cast(-1 as integer) as ref_index, cast(0 as integer) as pos, '*' as cigar, cast(0 as integer) as mapq,
 case when (flag & 16) <> 0 then reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) else seq end as seq,
 case when (flag & 16) <> 0 then reverse(qual) else qual end as qual
from reads where mapq < 10""")
def q_make_unmapped(spark, sf_dir):
    r = _reads(spark, sf_dir).filter(F.col("mapq") < 10)
    return rec.make_unmapped(r).select("qname", "flag", "ref_index", "pos", "cigar", "mapq", "seq", "qual")


@query("set_read_group", W("reads") + """
select qname, 'GROUP1' as rg from reads""")
def q_set_read_group(spark, sf_dir):
    r, _groups = rec.set_read_group(_reads(spark, sf_dir).withColumn(
        "tags", F.create_map().cast(tg.TAGS_TYPE)))
    return r.select("qname", tg.tag_string("tags", "RG").alias("rg"))
