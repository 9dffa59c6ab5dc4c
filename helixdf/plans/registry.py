"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` that reads the
driver's tables (through the fixture SQL) and runs one library operator.
The oracle is an independent SQL formulation of the same result over the same
tables; both sides alias every computed column identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# --- SQL text helpers for the oracle side (DuckDB dialect) --------------------

def sql_sum_ops(col: str, ops: str) -> str:
    """Sum of CIGAR run lengths whose operator is in ``ops``."""
    return (f"coalesce(cast(list_sum(list_transform(regexp_extract_all({col}, '(\\d+)[{ops}]', 1), "
            f"lambda x: cast(x as integer))) as integer), 0)")


def sql_ref_len(col: str = "cigar") -> str:
    return sql_sum_ops(col, "MDN=X")


def sql_end(pos: str = "pos", cigar: str = "cigar", flag: str = "flag") -> str:
    return f"(case when ({flag} & 4) <> 0 then 0 else {pos} + {sql_ref_len(cigar)} - 1 end)"
