"""Record-level operators built from the column functions (no per-row Python)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import bases as bs
from ..functions import cigar as cg
from ..functions import flags as fl
from ..functions import tags as tg


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def explode_cigar(reads: DataFrame) -> DataFrame:
    """One row per CIGAR element: ``idx, len, op, consumes_read, consumes_ref``."""
    out = reads.select("*", F.posexplode(cg.elements("cigar")).alias("idx", "_e"))
    return out.select(
        *reads.columns, "idx", F.col("_e.len").alias("len"), F.col("_e.op").alias("op"),
        F.col("_e.op").isin(*cg.CONSUMES_READ).alias("consumes_read"),
        F.col("_e.op").isin(*cg.CONSUMES_REF).alias("consumes_ref"))


def explode_blocks(reads: DataFrame) -> DataFrame:
    """One row per gapless aligned block: ``block, read_start, ref_start, length``."""
    out = reads.select("*", F.posexplode(cg.alignment_blocks("cigar", "pos")).alias("block", "_b"))
    return out.select(*reads.columns, "block", "_b.read_start", "_b.ref_start", "_b.length")


def ref_position_at_read_offset(cigar, pos, offset) -> Column:
    """1-based reference position of a 1-based read offset; 0 outside blocks."""
    blocks = cg.alignment_blocks(cigar, pos)
    o = _c(offset)
    hit = F.filter(blocks, lambda b: (o >= b["read_start"]) & (o < b["read_start"] + b["length"]))
    first = F.try_element_at(hit, F.lit(1))
    return F.when(o == 0, F.lit(0)).otherwise(
        F.coalesce(first["ref_start"] + o - first["read_start"], F.lit(0)))


def _on_contig(start: Column, n: Column, length: Column) -> Column:
    """How many of ``n`` bases from ``start`` on lie before, on and after a contig."""
    n = F.greatest(n, F.lit(0))
    before = F.least(F.greatest(1 - start, F.lit(0)), n)
    after = F.least(F.greatest(start + n - 1 - length, F.lit(0)), n)
    return F.struct(before.alias("before"), (n - before - after).alias("on"), after.alias("after"))


def _runs(*runs: tuple[Column, str]) -> Column:
    """CIGAR text of (length, operator) runs; empty runs are left out."""
    return F.concat(*[F.when(n > 0, F.concat(n.cast("string"), F.lit(op))).otherwise(F.lit("")) for n, op in runs])


def clipped_cigar(align_start, read_length, ref_length) -> Column:
    """CIGAR of an ungapped alignment: the read's span cut with the contig, what lies outside
    soft-clipped. NULL when no base lies on the contig (see :func:`clip_reason`)."""
    part = _on_contig(_c(align_start), _c(read_length), _c(ref_length))
    return F.when(part["on"] > 0, _runs((part["before"], "S"), (part["on"], "M"), (part["after"], "S")))


def _around(align_start, read_length, ref_length, indel_pos, indel_len):
    """The aligned parts before and behind an indel, cut with the contig."""
    s, n, at, by, length = (_c(x) for x in (align_start, read_length, indel_pos, indel_len, ref_length))
    inserted, deleted = F.greatest(by, F.lit(0)), F.greatest(-by, F.lit(0))
    return _on_contig(s, at, length), _on_contig(s + at + deleted, n - at - inserted, length)


def clipped_indel_cigar(align_start, read_length, ref_length, indel_pos, indel_len) -> Column:
    """CIGAR with one insertion (len > 0) or deletion (len < 0) after ``indel_pos`` aligned
    bases: both parts are cut with the contig. NULL unless both keep a base there."""
    first, second = _around(align_start, read_length, ref_length, indel_pos, indel_len)
    by = _c(indel_len)
    text = _runs((first["before"], "S"), (first["on"], "M"), (by, "I"), (-by, "D"), (second["on"], "M"), (second["after"], "S"))
    return F.when((first["on"] > 0) & (second["on"] > 0), text)


def clip_reason(align_start, read_length, ref_length, indel_pos=None, indel_len=None) -> Column:
    """Why there is no CIGAR: ``off_contig``, ``no_base_before_indel`` or ``no_base_after_indel``;
    NULL where there is one."""
    if indel_pos is None:
        return F.when(_on_contig(_c(align_start), _c(read_length), _c(ref_length))["on"] <= 0, F.lit("off_contig"))
    first, second = _around(align_start, read_length, ref_length, indel_pos, indel_len)
    return (F.when((first["on"] <= 0) & (second["on"] <= 0), F.lit("off_contig"))
            .when(first["on"] <= 0, F.lit("no_base_before_indel")).when(second["on"] <= 0, F.lit("no_base_after_indel")))


def original_qualities(tags) -> Column:
    """Phred array of the OQ tag; NULL when absent or empty."""
    oq = tg.tag_string(tags, "OQ")
    return F.when(F.length(oq) > 0, bs.phred_decode(oq))


_REVERSED_TEXT_TAGS = ("U2", "OQ")


def reverse_record(reads: DataFrame) -> DataFrame:
    """Reverse-complement bases and reverse qualities, plus the per-base tags:
    E2 reverse-complemented, U2/OQ reversed, SQ bytes reversed with complemented bases."""
    def fix_tag(k, v):
        rev = F.struct(v["type"].alias("type"), F.reverse(v["value"]).alias("value"))
        rc = F.struct(v["type"].alias("type"), bs.reverse_complement(v["value"]).alias("value"))
        return F.when(k.isin(*_REVERSED_TEXT_TAGS), rev).when(k == "E2", rc).when(
            k == "SQ", F.struct(v["type"].alias("type"), _sq_hex_revcomp(v["value"]).alias("value"))
        ).otherwise(v)

    out = reads.withColumn("seq", bs.reverse_complement("seq")).withColumn("qual", F.reverse("qual"))
    if "tags" in reads.columns:
        out = out.withColumn("tags", F.transform_values("tags", fix_tag))
    return out


def _sq_hex_revcomp(hexstr: Column) -> Column:
    """SQ values as hex text (H tag): reverse byte order, complement each base."""
    pairs = F.regexp_extract_all(hexstr, F.lit("([0-9A-Fa-f]{2})"), 1)
    vals = F.transform(F.reverse(pairs), lambda h: F.conv(h, 16, 10).cast("int"))
    return F.array_join(F.transform(vals, lambda v: F.lpad(F.upper(F.hex(bs.sq_complement(v))), 2, "0")), "")


def make_unmapped(reads: DataFrame) -> DataFrame:
    """Turn records into unmapped ones, reverse-complementing reverse-strand reads."""
    rev = fl.has("flag", fl.REVERSE)
    flag = F.when(rev, fl.set_bit("flag", fl.REVERSE, False)).otherwise(F.col("flag"))
    flag = flag.bitwiseAND(F.lit(~(fl.DUPLICATE | fl.SECONDARY | fl.PROPER_PAIR) & 0xFFFF)) \
        .bitwiseOR(F.lit(fl.UNMAPPED))
    out = (reads.withColumn("seq", F.when(rev, bs.reverse_complement("seq")).otherwise(F.col("seq")))
           .withColumn("qual", F.when(rev, F.reverse("qual")).otherwise(F.col("qual")))
           .withColumn("flag", flag.cast("int"))
           .withColumn("ref_index", F.lit(-1)).withColumn("pos", F.lit(0))
           .withColumn("cigar", F.lit("*")).withColumn("mapq", F.lit(0)))
    if "isize" in reads.columns:
        out = out.withColumn("isize", F.lit(0))
    if "ref_name" in reads.columns:
        out = out.withColumn("ref_name", F.lit("*"))
    return out


# Read group stamped on every read before calling.
READ_GROUP = {"ID": "GROUP1", "LB": "LIB1", "PL": "ILLUMINA", "PU": "UNIT1", "SM": "SAMPLE1"}


def set_read_group(reads: DataFrame, group: dict | None = None):
    """Stamp one read group on every read; returns (reads, one-row read_groups table)."""
    g = dict(READ_GROUP if group is None else group)
    spark = reads.sparkSession
    rg = spark.createDataFrame([(g["ID"], g.get("SM"), g.get("LB"), g.get("PL"), g.get("PU"))],
                               "id string, sm string, lb string, pl string, pu string")
    return reads.withColumn("tags", tg.set_tag("tags", "RG", "Z", F.lit(g["ID"]))), rg


def truncate_ref_name(name) -> Column:
    """Sequence name cut at the first whitespace; ``=`` is not a legal name (NULL)."""
    n = _c(name)
    return F.when(n == "=", F.lit(None).cast("string")).otherwise(F.regexp_extract(n, r"^\S*", 0))
