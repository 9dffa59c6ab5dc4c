"""Queries over whole tables, beside queries whose SQL reads a part of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import flags as fl
from ..functions import tags as tg
from ..operators import preprocess
from ..operators import records as rec
from ..operators import validate as va
from ..session import scratch_path
from ..sources import header as hd
from ..sources import text
from . import tagsets, validation
from .registry import ORACLES, query, sql_sum_ops

W = fx.with_clause
_ALL_TAG_TEXTS = tagsets._TAG_TEXTS_SQL.replace(" where (flag & 4) = 0", "")


def _reads(spark, sf_dir):
    return fx.load(spark, sf_dir).reads


@query("make_unmapped_all", ORACLES["make_unmapped"].replace("from reads where mapq < 10", "from reads"))
def q_make_unmapped_all(spark, sf_dir):
    return rec.make_unmapped(_reads(spark, sf_dir)).select("qname", "flag", "ref_index", "pos", "cigar", "mapq", "seq", "qual")


@query("reverse_record_all", W("reads") + """
, r as (select *, (flag & 16) <> 0 as rev, substr(seq, 1, 8) as e from reads)
select qname, case when rev then reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) else seq end as seq,
 case when rev then reverse(qual) else qual end as qual,
 case when mapq % 2 = 0 then case when rev then qual else reverse(qual) end end as oq,
 case when mapq % 5 = 0 then case when rev then reverse(translate(e, 'ACGTacgt', 'TGCAtgca')) else e end end as e2 from r""")
def q_reverse_record_all(spark, sf_dir):
    """Reverse-strand records are reversed, the others stay."""
    t = F.create_map().cast(tg.TAGS_TYPE)
    t = F.when(F.col("mapq") % 2 == 0, tg.set_tag(t, "OQ", "Z", F.reverse("qual"))).otherwise(t)
    t = F.when(F.col("mapq") % 5 == 0, tg.set_tag(t, "E2", "Z", F.substring("seq", 1, 8))).otherwise(t)
    r = _reads(spark, sf_dir).withColumn("tags", t)
    changed = ("seq", "qual", "tags")
    out = rec.reverse_record(r.withColumns({f"_{c}": F.col(c) for c in changed}))
    out = out.withColumns({c: F.when(fl.has("flag", fl.REVERSE), F.col(c)).otherwise(F.col(f"_{c}")) for c in changed})
    return out.select("qname", "seq", "qual", tg.tag_string("tags", "OQ").alias("oq"), tg.tag_string("tags", "E2").alias("e2"))


@query("parse_tags_all", ORACLES["parse_tags"].replace(tagsets._TAG_TEXTS_SQL, _ALL_TAG_TEXTS))
def q_parse_tags_all(spark, sf_dir):
    return tagsets.parsed_tags(tagsets.tag_texts(_reads(spark, sf_dir)))


@query("typed_tag_all", ORACLES["typed_tag"].replace(tagsets._TAG_TEXTS_SQL, _ALL_TAG_TEXTS))
def q_typed_tag_all(spark, sf_dir):
    return tagsets.typed_tags(tagsets.tag_texts(_reads(spark, sf_dir)))


@query("write_reads_columnar_all", W("reads") + """
select qname, flag, ref_index, pos, mapq, cigar, seq, qual from reads""")
def q_write_reads_columnar_all(spark, sf_dir):
    """The whole store read back."""
    path = scratch_path(spark, "reads.parquet")
    text.write_reads_columnar(_reads(spark, sf_dir), path)
    return spark.read.parquet(path).select("qname", "flag", "ref_index", "pos", "mapq", "cigar", "seq", "qual")


@query("stringency_mode_all", W("vreads") + validation._VOPS + validation._VBLK + """
, past as (select distinct b.rid, b.qname from blk b join rr r on r.rid = b.rid
           where r.ref_index <> -1 and r.ref_length is not null and b.ref_start + b.length - 1 > r.ref_length),
errs as (""" + validation._rules_sql(validation._ALL_RULES, "v") + """
 union all select qname, 'CIGAR_MAPS_OFF_REFERENCE', 'ERROR', 'aligned bases beyond the contig' from past)
select 'LENIENT' as mode, (select count(*) from vreads) as n_records, (select count(*) from errs) as n_reported
union all select 'SILENT' as mode, (select count(*) from vreads) as n_records, cast(0 as bigint) as n_reported""")
def q_stringency_mode_all(spark, sf_dir):
    return validation.reported_by_mode(validation._vreads(spark, sf_dir), va.record_rules())


@query("duplicate_ids_all", W("header_lines") + """
, ids as (select substr(value, 2, 2) as kind, split_part(split_part(value, chr(9), 2), ':', 2) as id from header_lines
          where starts_with(value, '@RG') or starts_with(value, '@SQ') or starts_with(value, '@PG')
          union all select 'RG', 'rg' || cast(c_custkey % 150 as varchar) from customer
          union all select 'PG', 'bwa' || case when c_custkey % 150 > 0 then cast(c_custkey % 150 as varchar) else '' end from customer)
select kind, id, count(*) as n from ids group by kind, id having count(*) > 1""")
def q_duplicate_ids_all(spark, sf_dir):
    """As duplicate_ids, with program records and a second header's programs."""
    f = fx.load(spark, sf_dir)
    first = hd.header_table(f.header_lines).filter(F.col("rec_type").isin("RG", "SQ", "PG") & F.col("key").isin("ID", "SN"))
    n = F.col("c_custkey") % 150
    extra = f.table("customer").select(F.explode(F.array(
        F.struct(F.lit("RG").alias("kind"), F.concat(F.lit("rg"), n.cast("string")).alias("id")),
        F.struct(F.lit("PG").alias("kind"), F.concat(F.lit("bwa"), F.when(n > 0, n.cast("string")).otherwise("")).alias("id")))).alias("x"))
    both = first.select(F.col("rec_type").alias("kind"), F.col("value").alias("id")).unionByName(extra.select("x.kind", "x.id"))
    return both.groupBy("kind", "id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


@query("md_site_errors", W("reads_md") + f"""
, b as (select qname, cigar, case when ends_with(qname, '7') then md || 'A' else md end as md from reads_md)
select qname, md, cigar from b where cigar <> '*' and {sql_sum_ops('cigar', 'MD=X')} <>
 coalesce(list_sum(list_transform(regexp_extract_all(md, '[0-9]+'), lambda x: cast(x as integer))), 0) + length(regexp_replace(md, '[0-9^]', '', 'g'))""")
def q_md_site_errors(spark, sf_dir):
    """The error rows of md_sites, with some MD values made too long."""
    r = fx.load(spark, sf_dir).reads_md
    broken = F.when(F.col("qname").endswith("7"), F.concat("md", F.lit("A"))).otherwise(F.col("md"))
    return preprocess.md_sites(r.withColumn("md", broken))[1]
