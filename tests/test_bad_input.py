"""Lines that break their format give nulls, not failed jobs."""

from pyspark.sql import functions as F

from helixdf.functions import tags
from helixdf.sources import sam, text


def test_short_record_line(spark):
    lines = spark.createDataFrame([("r1\t0\tchr1\t5",), ("r2\tx\tchr1\t7\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i",)], "value string")
    rows = {r["qname"]: r for r in sam.parse_fields(sam.split_fields(lines)).collect()}
    assert rows["r1"]["pos"] == 5 and rows["r1"]["qual"] is None and rows["r1"]["n_fields"] == 4
    assert rows["r2"]["flag"] is None and rows["r2"]["seq"] == "ACGT"


def test_short_tag(spark):
    row = spark.range(1).select(tags.split_tag(F.lit("NM:i")).alias("t")).first()["t"]
    assert (row["tag"], row["type"], row["value"], row["three_fields"]) == ("NM", "i", None, False)


def test_sites_only_vcf(spark):
    lines = spark.createDataFrame([("#CHROM",), ("chr2\t10\trs1\tA\tC\t.\tPASS\tX=1",), ("chrX\t3",)], "value string")
    rows = {r["chrom"]: r for r in text.parse_vcf_lines(lines).collect()}
    assert rows["chr2"]["chrom_num"] == 2 and rows["chr2"]["sample"] is None
    assert rows["chrX"]["chrom_num"] == 23 and rows["chrX"]["pos"] == 3 and rows["chrX"]["info"] is None
