"""Text queries that SQL can express equal their SQL, on driver tables and on awkward ones."""

import pytest

from helixdf.llm.queries import ORACLES, QUERIES
from helixdf.plans.compare import compare, duck_connect

from ..conftest import SF_SMALL
from .test_operators import corpus

TABLES = ("documents", "benchmark", "pages", "labels")
URLS = ["https://A.Example.NET/en/1?y", "http://b.org/fr/2", None, "", "no scheme", "x://net", "http://a.example.com/de/3#f",
        "http://good.com/4", "http://good.com/4", "a://b://c/d#e", "http://good.com/99999999999999999999", "ftp://q.de:80",
        "http://slash.com/1/", "http://slash.com/2/?q", "http://slash.com/3/#f"]


def check(spark, folder, name):
    problems = compare(QUERIES[name](spark, folder), duck_connect(folder, TABLES), ORACLES[name])
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    check(spark, SF_SMALL, name)


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_tables_match_sql(spark, tmp_path, empty):
    """Nulls, empty and repeated texts and ids, extra columns with clashing names, no rows."""
    texts = corpus()
    rows = {
        "documents": ([(d, t, "a", "b", True, None if i % 5 == 0 else f"s{i % 3}", None if i % 4 else "en", i if i % 7 else None, "x", "y") for i, (d, t) in enumerate(texts)]
                      + [(70, "#a $B!!\n\nx\nx\r\nx\n x\nx THE", "a", None, None, "é", "fr", 1, "x", "y")],
                      "doc_id long, text string, host string, n_words string, kept boolean, source string, lang string, n_chars long, score string, leaf string"),
        "benchmark": ([(1, texts[7][1]), (2, "AB!"), (3, None), (4, "..."), (5, "ab"), (5, "ab")], "item_id long, text string"),
        "pages": ([(i, u, "h", "v", 1) for i, u in enumerate(URLS)] + [(None, URLS[0], None, None, None)],
                  "page_id long, url string, host string, verdict string, good int"),
        "labels": ([(1, 1, 0), (2, 0, 0), (3, None, 0), (4, 1, 1), (4, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")}
    for name, (data, schema) in rows.items():
        df = spark.createDataFrame(data, schema)
        (df.limit(0) if empty else df).write.parquet(f"{tmp_path}/{name}.parquet/")
    for name in sorted(ORACLES):
        con = duck_connect_folder(tmp_path)
        problems = compare(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name])
        assert not problems, (name, problems)


def duck_connect_folder(folder):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
    return con
