"""SAM text source and sink.

``spark.read.text`` splits files across tasks by byte ranges (one record per
line), so parsing is a per-line projection that scales with the cluster. The
only join is against the sequence dictionary, which is bounded by the header
(thousands of contigs at most), so it is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tags as tg
from . import text

READ_COLUMNS = ["qname", "flag", "ref_index", "ref_name", "pos", "mapq", "cigar",
                "mate_ref_index", "mate_ref_name", "mate_pos", "isize", "seq", "qual", "tags"]
N_REQUIRED_FIELDS = 11


def split_fields(lines: DataFrame, col: str = "value") -> DataFrame:
    """Body lines (not starting with ``@``) -> raw field array + line text."""
    body = lines.filter(~F.col(col).startswith("@"))
    return body.select(F.col(col).alias("line"), F.split(F.col(col), "\t").alias("f"))


def parse_fields(split: DataFrame) -> DataFrame:
    """Typed record columns from the field array; bad numbers become NULL."""
    f = F.col("f")
    ref_name = F.get(f, F.lit(2))
    mate = F.get(f, F.lit(6))
    return split.select(
        "line",
        F.size(f).alias("n_fields"),
        F.get(f, F.lit(0)).alias("qname"),
        F.get(f, F.lit(1)).try_cast("int").alias("flag"),
        ref_name.alias("ref_name"),
        F.get(f, F.lit(3)).try_cast("int").alias("pos"),
        F.get(f, F.lit(4)).try_cast("int").alias("mapq"),
        F.get(f, F.lit(5)).alias("cigar"),
        F.when(mate == "=", ref_name).otherwise(mate).alias("mate_ref_name"),
        F.get(f, F.lit(7)).try_cast("int").alias("mate_pos"),
        F.get(f, F.lit(8)).try_cast("int").alias("isize"),
        F.get(f, F.lit(9)).alias("seq"),
        F.get(f, F.lit(10)).alias("qual"),
        tg.tags_from_fields(F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0)))).alias("tags"),
    )


def attach_ref_index(df: DataFrame, contigs: DataFrame, name_col: str, index_col: str) -> DataFrame:
    """Name -> dictionary index by a broadcast left join; miss (or ``*``) -> -1."""
    d = F.broadcast(contigs.select(F.col("ref_name").alias("_n"), F.col("ref_index").alias("_i")))
    return (df.join(d, df[name_col] == d["_n"], "left")
            .withColumn(index_col, F.coalesce(F.col("_i"), F.lit(-1)).cast("int"))
            .drop("_n", "_i"))


def parse_sam_lines(lines: DataFrame, contigs: DataFrame, col: str = "value",
                    keep_line: bool = False) -> DataFrame:
    """SAM text lines -> ``reads`` (see ``READ_COLUMNS``)."""
    parsed = parse_fields(split_fields(lines, col))
    parsed = attach_ref_index(parsed, contigs, "ref_name", "ref_index")
    parsed = attach_ref_index(parsed, contigs, "mate_ref_name", "mate_ref_index")
    cols = READ_COLUMNS + (["line", "n_fields"] if keep_line else [])
    return parsed.select(*cols)


def read_sam(spark: SparkSession, path: str, contigs: DataFrame) -> DataFrame:
    return parse_sam_lines(spark.read.text(path), contigs)


def read_sam_checked(spark: SparkSession, path: str, contigs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The reads of SAM text and a report of what is wrong with it: file, line_no (0-based),
    qname, type, severity, message. No line is left out of the reads; a value that cannot be
    read is null there and has its row in the report. Both are lazy scans of the text."""
    from ..operators.validate import line_report
    numbered = text.number_lines(spark.read.text(path))
    return read_sam(spark, path, contigs), line_report(numbered, contigs, keep=["file", "line_no"])


def format_sam_lines(reads: DataFrame, contigs: DataFrame | None = None) -> DataFrame:
    """``reads`` -> one ``value`` text column per record.

    The mate reference is written ``=`` when it equals the read's own (non-``*``)
    reference. Missing optional columns take SAM's "absent" values.
    """
    cols = set(reads.columns)
    df = reads
    if "ref_name" not in cols:
        if contigs is None:
            raise ValueError("ref_name missing and no contigs to look it up")
        d = F.broadcast(contigs.select(F.col("ref_index").alias("_i"), F.col("ref_name")))
        df = df.join(d, df["ref_index"] == d["_i"], "left").drop("_i")
        df = df.withColumn("ref_name", F.coalesce("ref_name", F.lit("*")))

    def opt(name, default):
        return F.col(name) if name in cols else F.lit(default)

    mate_name = opt("mate_ref_name", "*")
    mate_out = F.when((mate_name == F.col("ref_name")) & (mate_name != "*"), F.lit("=")).otherwise(mate_name)
    fields = [F.col("qname"), F.col("flag").cast("string"), F.col("ref_name"),
              F.col("pos").cast("string"), F.col("mapq").cast("string"), F.col("cigar"),
              mate_out, opt("mate_pos", 0).cast("string"), opt("isize", 0).cast("string"),
              opt("seq", "*"), opt("qual", "*")]
    body = F.concat_ws("\t", *fields)
    if "tags" in cols:
        tag_text = tg.tags_to_text("tags")
        body = F.when(F.length(tag_text) > 0, F.concat_ws("\t", body, tag_text)).otherwise(body)
    return df.select(body.alias("value"))


def write_sam(reads: DataFrame, path: str, header_lines: DataFrame | None = None,
              contigs: DataFrame | None = None, mode: str = "overwrite") -> None:
    """Write SAM text: the header as its own leading file, then the body parts."""
    body = format_sam_lines(reads, contigs)
    if header_lines is not None:
        # Header lines are few (bounded by the dictionary), one small file.
        header_lines.select("value").coalesce(1).write.mode(mode).text(f"{path}/0-header")
        body.write.mode(mode).text(f"{path}/1-body")
    else:
        body.write.mode(mode).text(path)
