"""Every registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from helixdf.plans import ORACLES, QUERIES
from helixdf.plans.compare import compare

from .conftest import SF_SMALL


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["ref_index", "island_start", "island_end", "n_reads"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    problems = compare(df, duck, ORACLES[name])
    assert not problems, problems
