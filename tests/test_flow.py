"""The composed preparation flow runs end to end and keeps every kept read."""

from pyspark.sql import functions as F

from helixdf import fixtures as fx
from helixdf.operators import filters
from helixdf.plans.flow import prepare_for_calling
from helixdf.sources import text

from .conftest import SF_SMALL


def test_prepare_for_calling(spark):
    f = fx.load(spark, SF_SMALL)
    known = (text.parse_vcf_lines(f.vcf_lines).select(F.col("chrom_num").alias("ref_index"), "pos")
             .filter(F.col("ref_index").isNotNull()))
    out = prepare_for_calling(f.reads, f.contigs, f.ref_tiles, known, n_regions=4, targets=f.targets)
    kept = filters.keep_primary_contigs(f.reads).count()
    reads = out["reads"]
    assert reads.count() == kept
    assert {r.region for r in reads.select("region").distinct().collect()} == {0, 1, 2, 3}
    assert reads.filter(F.col("rg") != "GROUP1").count() == 0
    assert reads.filter(F.length("qual") != F.length("seq")).count() == 0
    assert out["depth"].count() > 0
    assert out["regions"].count() > 0
    assert out["duplicate_metrics"].count() == 1
    assert out["recal_table"].count() > 0
    assert "i_start0" in out["region_targets"].columns
