"""Queries: tag parsing and typed access, name/number helpers, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import bases as bs
from ..functions import tags as tg
from ..operators import records
from ..sources import header as hd
from ..sources import sam
from ..sources import text
from .registry import query

W = fx.with_clause

# Extra tags per read, chosen from the read's own values (good and bad ones).
_TAG_TEXTS_SQL = """
, tt as (select qname, mapq, [
   'NM:i:' || cast(mapq % 4 as varchar),
   'XI:i:' || case when mapq % 5 = 0 then 'x' || cast(mapq as varchar) else cast(cast(mapq as bigint) * 100000000 as varchar) end,
   'XA:A:' || substr(seq, 1, 1 + mapq % 2),
   'XH:H:' || upper(substr(md5(qname), 1, 2 + mapq % 2)),
   'XB:B:' || case mapq % 3 when 0 then 'c,1,-5,' || cast(mapq * 3 as varchar) when 1 then 'S,' || cast(mapq as varchar) || ',70000'
                else 'f,1.5,' || cast(mapq as varchar) end,
   case when mapq % 10 = 0 then 'XQ:Q:1' else 'XZ:Z:a:b' end,
   'XF:f:' || cast(mapq as varchar) || '.25'] as tags from reads where (flag & 4) = 0)
"""


def _tag_texts(spark, sf_dir):
    return tag_texts(fx.load(spark, sf_dir).reads.filter(F.col("flag").bitwiseAND(4) == 0))


def tag_texts(r):
    m = F.col("mapq")
    ms = m.cast("string")
    texts = F.array(
        F.concat(F.lit("NM:i:"), (m % 4).cast("string")),
        F.concat(F.lit("XI:i:"), F.when(m % 5 == 0, F.concat(F.lit("x"), ms))
                 .otherwise((m.cast("long") * 100000000).cast("string"))),
        F.concat(F.lit("XA:A:"), F.expr("substr(seq, 1, 1 + mapq % 2)")),
        F.concat(F.lit("XH:H:"), F.upper(F.expr("substr(md5(qname), 1, 2 + mapq % 2)"))),
        F.concat(F.lit("XB:B:"), F.when(m % 3 == 0, F.concat(F.lit("c,1,-5,"), (m * 3).cast("string")))
                 .when(m % 3 == 1, F.concat(F.lit("S,"), ms, F.lit(",70000")))
                 .otherwise(F.concat(F.lit("f,1.5,"), ms))),
        F.when(m % 10 == 0, F.lit("XQ:Q:1")).otherwise(F.lit("XZ:Z:a:b")),
        F.concat(F.lit("XF:f:"), ms, F.lit(".25")))
    return r.select("qname", "mapq", texts.alias("fields"))


_TAG_ERR_SQL = """
case when ty = 'A' then case when length(val) <> 1 then 'A needs one character' end
     when ty = 'i' then case when try_cast(val as integer) is null then 'i needs a signed 32-bit integer' end
     when ty = 'f' then case when try_cast(val as float) is null then 'f needs a float' end
     when ty = 'Z' then null
     when ty = 'H' then case when not regexp_full_match(val, '([0-9A-Fa-f]{2})*') then 'H needs an even hex string' end
     when ty = 'B' then
       case when strpos(val, ',') = 0 or length(split_part(val, ',', 1)) <> 1 then 'B needs element type and comma'
            when split_part(val, ',', 1) = 'f' then case when len(list_filter(string_split(substr(val, strpos(val, ',') + 1), ','), lambda x: try_cast(x as float) is null)) > 0 then 'B:f needs floats' end
            when split_part(val, ',', 1) in ('c','C','s','S','i','I') then
              case when len(list_filter(string_split(substr(val, strpos(val, ',') + 1), ','), lambda x: try_cast(x as bigint) is null
                  or try_cast(x as bigint) < (case split_part(val, ',', 1) when 'c' then -128 when 's' then -32768 when 'i' then -2147483648 else 0 end)
                  or try_cast(x as bigint) > (case split_part(val, ',', 1) when 'c' then 127 when 'C' then 255 when 's' then 32767 when 'S' then 65535
                                                when 'i' then 2147483647 else 4294967295 end))) > 0 then 'B element out of range' end
            else 'unrecognized array element type' end
     else 'unrecognized tag type' end"""


@query("parse_tags", W("reads") + _TAG_TEXTS_SQL + f"""
, x as (select qname, unnest(tags) as t from tt),
p as (select qname, split_part(t, ':', 1) as tag, split_part(t, ':', 2) as ty,
             substr(t, length(split_part(t, ':', 1)) + length(split_part(t, ':', 2)) + 3) as val from x)
select qname, tag, ty as type, val as value, {_TAG_ERR_SQL} as error from p""")
def q_parse_tags(spark, sf_dir):
    return parsed_tags(_tag_texts(spark, sf_dir))


def parsed_tags(texts):
    t = texts.select("qname", F.explode("fields").alias("t"))
    # the parts are a column of their own, so that a tag is split once
    parts = t.select("qname", F.split("t", ":", 3).alias("p"))
    s = parts.select("qname", *[F.get("p", F.lit(i)).alias(name) for i, name in enumerate(("tag", "type", "value"))])
    return s.select("qname", "tag", "type", "value", tg.tag_error("type", "value").alias("error"))


@query("typed_tag", W("reads") + _TAG_TEXTS_SQL + """
, g as (select qname, mapq, list_transform(tags, lambda t: split_part(t, ':', 3)) as v from tt)
select qname, cast(mapq % 4 as integer) as nm, try_cast(v[2] as integer) as xi,
 case when try_cast(v[2] as integer) between -32768 and 32767 then try_cast(v[2] as integer) end as xi_short,
 round(cast(try_cast(v[7] as float) as double), 3) as xf,
 case when length(v[3]) = 1 then v[3] end as xa,
 case when mapq % 2 = 0 then upper(substr(md5(qname), 1, 2)) end as xh,
 case when mapq % 3 = 0 and mapq * 3 <= 127 then '1,-5,' || cast(mapq * 3 as varchar) end as xb,
 case when mapq % 10 = 0 then null else 'a:b' end as xz
from g""")
def q_typed_tag(spark, sf_dir):
    return typed_tags(_tag_texts(spark, sf_dir))


def typed_tags(texts):
    t = texts.withColumn("tags", tg.tags_from_fields("fields"))
    hexed = F.upper(F.hex(tg.tag_bytes("tags", "XH")))
    return t.select("qname", tg.tag_int("tags", "NM").alias("nm"), tg.tag_int("tags", "XI").alias("xi"),
                    tg.tag_in_range("tags", "XI", -32768, 32767).alias("xi_short"),
                    F.round(tg.tag_float("tags", "XF").cast("double"), 3).alias("xf"),
                    tg.tag_char("tags", "XA").alias("xa"),
                    hexed.alias("xh"),
                    F.array_join(tg.tag_int_array("tags", "XB"), ",").alias("xb"),
                    tg.tag_string("tags", "XZ").alias("xz"))


@query("set_tag", W("sam_lines") + """
, s as (select string_split(value, chr(9)) as f from sam_lines)
select f[1] as qname, concat_ws(chr(9), 'RG:Z:GROUP1', 'NM:i:' || cast(cast(f[5] as integer) % 4 + 1 as varchar),
  case when cast(f[5] as integer) % 2 = 0 then 'XS:i:' || f[5] end) as tags from s""")
def q_set_tag(spark, sf_dir):
    """Replace NM, add XS on even mapq (NULL value = no tag), on parsed SAM records."""
    f = fx.load(spark, sf_dir)
    r = sam.parse_sam_lines(f.sam_lines, f.contigs)
    r = r.withColumn("tags", tg.set_tag("tags", "NM", "i", (F.col("mapq") % 4 + 1)))
    r = r.withColumn("tags", tg.set_tag("tags", "XS", "i", F.when(F.col("mapq") % 2 == 0, F.col("mapq"))))
    return r.select("qname", tg.tags_to_text("tags").alias("tags"))


@query("clear_tags", W("sam_lines") + """
, s as (select string_split(value, chr(9)) as f from sam_lines)
select f[1] as qname, 'NM:i:' || cast(cast(f[5] as integer) % 4 as varchar) as kept, '' as cleared from s""")
def q_clear_tags(spark, sf_dir):
    f = fx.load(spark, sf_dir)
    r = sam.parse_sam_lines(f.sam_lines, f.contigs)
    return r.select("qname", tg.tags_to_text(tg.clear_tags("tags", ["RG"])).alias("kept"),
                    tg.tags_to_text(tg.clear_tags("tags")).alias("cleared"))


_Q = "list_transform(string_split(qual, ''), lambda c: ascii(c) - 33 + 31)"


@query("fix_quality_encoding", W("reads") + f"""
, q as (select qname, list_transform({_Q}, lambda x: x - 31) as fixed, list_transform(string_split(qual, ''), lambda c: ascii(c) - 33 - 31) as over from reads)
select qname, cast(list_sum(fixed) as integer) as fixed_sum,
 cast(len(list_filter(over, lambda x: x < 0)) as integer) as n_negative from q""")
def q_fix_quality_encoding(spark, sf_dir):
    """Qualities read as Illumina-1.3 (q + 31) are shifted back; shifting Phred
    values gives negatives, which are flagged."""
    r = fx.load(spark, sf_dir).reads
    q = bs.phred_decode("qual")
    illumina = F.transform(q, lambda x: x + 31)
    fixed = bs.fix_illumina_quals(illumina)
    over = bs.fix_illumina_quals(q)
    return r.select("qname", F.aggregate(fixed, F.lit(0), lambda a, x: a + x).alias("fixed_sum"),
                    F.size(F.filter(over, lambda x: x < 0)).alias("n_negative"))


_VF = "string_split(value, chr(9))"


@query("truncate_ref_name", W("vcf_lines") + f"""
, n as (select case when cast({_VF}[2] as bigint) % 50 = 1 then '=' else {_VF}[1] || ' ' || {_VF}[6] || chr(9) || 'x' end as raw from vcf_lines)
select raw, case when raw = '=' then null else regexp_extract(raw, '^[^\\s]*', 0) end as name, raw <> '=' as valid from n""")
def q_truncate_ref_name(spark, sf_dir):
    v = fx.load(spark, sf_dir).vcf_lines
    f = F.split("value", "\t")
    raw = F.when(f[1].cast("long") % 50 == 1, F.lit("=")).otherwise(
        F.concat(f[0], F.lit(" "), f[5], F.lit("\t"), F.lit("x")))
    d = v.select(raw.alias("raw"))
    return d.select("raw", records.truncate_ref_name("raw").alias("name"), (F.col("raw") != "=").alias("valid"))


@query("chrom_number", W("vcf_lines") + f"""
, c as (select case when cast({_VF}[2] as bigint) % 7 = 0 then 'chrM' when cast({_VF}[2] as bigint) % 11 = 0 then 'chrUn_gl000220'
          else {_VF}[1] end as chrom from vcf_lines)
select chrom, cast(case substr(chrom, 4) when 'X' then 23 when 'Y' then 24 else try_cast(substr(chrom, 4) as integer) end as integer) as chrom_num from c""")
def q_chrom_number(spark, sf_dir):
    v = fx.load(spark, sf_dir).vcf_lines
    f = F.split("value", "\t")
    chrom = (F.when(f[1].cast("long") % 7 == 0, F.lit("chrM"))
             .when(f[1].cast("long") % 11 == 0, F.lit("chrUn_gl000220")).otherwise(f[0]))
    return v.select(chrom.alias("chrom")).select("chrom", text.chrom_number("chrom").alias("chrom_num"))


# --- set operations -------------------------------------------------------------------

@query("union_reads", W("reads", "pairs") + """
select qname, flag, ref_index, pos, 'reads' as source from reads
union all select qname, flag, ref_index, pos, 'pairs' as source from pairs""")
def q_union_reads(spark, sf_dir):
    f = fx.load(spark, sf_dir)
    a = f.reads.select("qname", "flag", "ref_index", "pos").withColumn("source", F.lit("reads"))
    b = f.pairs.select("qname", "flag", "ref_index", "pos").withColumn("source", F.lit("pairs"))
    return a.unionByName(b)


@query("dedupe_by_sort_key", W("pairs") + """
, u as (select * from pairs union all select qname, flag, ref_index, pos, mate_pos, isize, cigar, reverse(qual) as qual from pairs)
select distinct ref_index, pos, (flag & 16) <> 0 as reverse, qname, flag, mate_pos, isize from u""")
def q_dedupe_by_sort_key(spark, sf_dir):
    """Records equal under the full coordinate order collapse to one (their
    sort keys are returned; other fields of equal records may differ)."""
    p = fx.load(spark, sf_dir).pairs
    u = p.unionByName(p.withColumn("qual", F.reverse("qual")))
    keyed = u.select("ref_index", "pos", F.col("flag").bitwiseAND(16).cast("boolean").alias("reverse"),
                     "qname", "flag", "mate_pos", "isize")
    return keyed.dropDuplicates()


@query("duplicate_ids", W("header_lines") + """
, ids as (select 'RG' as kind, split_part(split_part(value, chr(9), 2), ':', 2) as id from header_lines where starts_with(value, '@RG')
          union all select 'SQ' as kind, split_part(split_part(value, chr(9), 2), ':', 2) as id from header_lines where starts_with(value, '@SQ')
          union all select 'RG' as kind, 'rg' || cast(c_custkey % 150 as varchar) as id from customer)
select kind, id, count(*) as n from ids group by kind, id having count(*) > 1""")
def q_duplicate_ids(spark, sf_dir):
    """Header ids merged with a second header's read groups (one per customer
    bucket): ids defined more than once are rejected."""
    f = fx.load(spark, sf_dir)
    table = hd.header_table(f.header_lines)
    first = table.filter(F.col("rec_type").isin("RG", "SQ") & F.col("key").isin("ID", "SN"))
    ids = first.select(F.col("rec_type").alias("kind"), F.col("value").alias("id"))
    extra = f.table("customer").select(F.lit("RG").alias("kind"),
                                       F.concat(F.lit("rg"), (F.col("c_custkey") % 150).cast("string")).alias("id"))
    both = ids.unionByName(extra)
    return both.groupBy("kind", "id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)

