"""Compare a Spark query with its DuckDB oracle (tests and scripts/oracle_check.py).

Checks column names, column types and the order-insensitive multiset of rows
(floats rounded to 6 decimals).
"""

from __future__ import annotations

import math
from collections import Counter

SPARK_TYPES = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE",
               "StringType": "VARCHAR", "BooleanType": "BOOLEAN", "ShortType": "SMALLINT",
               "ByteType": "TINYINT", "FloatType": "FLOAT", "BinaryType": "BLOB"}


def duck_connect(sf_dir: str, tables):
    import duckdb
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def compare(df, con, sql: str) -> list[str]:
    """Problems found (empty list = match)."""
    rows = df.collect()
    cols = df.columns
    stypes = [SPARK_TYPES.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in df.schema.fields]
    res = con.execute(sql)
    orows = res.fetchall()
    ocols = [d[0] for d in res.description]
    otypes = [str(d[1]) for d in res.description]
    problems = []
    if sorted(cols) != sorted(ocols):
        return [f"columns spark={cols} duck={ocols}"]
    st, ot = dict(zip(cols, stypes)), dict(zip(ocols, otypes))
    tdiff = [(c, st[c], ot[c]) for c in cols if st[c] != ot[c]]
    if tdiff:
        problems.append(f"types {tdiff}")
    if len(rows) != len(orows):
        problems.append(f"rows spark={len(rows)} duck={len(orows)}")
    order = sorted(cols)
    si = [cols.index(c) for c in order]
    oi = [ocols.index(c) for c in order]
    a = Counter(tuple(_norm(r[i]) for i in si) for r in rows)
    b = Counter(tuple(_norm(r[i]) for i in oi) for r in orows)
    if a != b:
        problems.append(f"values differ; spark-only {list((a - b).items())[:3]}; "
                        f"duck-only {list((b - a).items())[:3]}")
    return problems
