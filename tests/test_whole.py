"""Queries over whole tables read every row, also of unmapped reads (sf0.01 has some)."""

import pytest

from helixdf import fixtures as fx
from helixdf.fixtures import DRIVER_TABLES
from helixdf.plans import ORACLES, QUERIES
from helixdf.plans.compare import compare, duck_connect

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["make_unmapped_all", "reverse_record_all", "typed_tag_all", "write_reads_columnar_all"])
def test_every_read_is_kept(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() == fx.load(spark, SF).reads.count()
    problems = compare(df, duck_connect(SF, DRIVER_TABLES), ORACLES[name])
    assert not problems, problems


def test_programs_and_md_errors_are_reported(spark):
    ids = QUERIES["duplicate_ids_all"](spark, SF)
    assert ids.filter("kind = 'PG' and id = 'bwa'").count() == 1
    assert QUERIES["md_site_errors"](spark, SF).count() > 0
