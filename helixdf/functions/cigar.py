"""CIGAR column expressions.

A CIGAR string such as ``10M2I20M`` is a list of (length, operator) runs. All
functions here are JVM-side expressions (regex extraction + higher-order array
functions), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# CIGAR operators and which sequence each consumes.
OPS = "MIDNSHP=X"
CONSUMES_READ = "MIS=X"
CONSUMES_REF = "MDN=X"
ALIGNS = "M=X"                     # consumes both read and reference
VALID_CIGAR_REGEX = r"^([0-9]+[MIDNSHP=X])+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _sum_lengths(cigar, ops: str) -> Column:
    """Sum of run lengths whose operator is in ``ops`` (``*`` -> 0)."""
    pattern = r"(\d+)[" + ops + "]"
    runs = F.regexp_extract_all(_c(cigar), F.lit(pattern), 1)
    return F.aggregate(runs, F.lit(0), lambda acc, x: acc + x.cast("int"))


def ref_length(cigar) -> Column:
    """Reference bases covered: M, D, N, =, X."""
    return _sum_lengths(cigar, CONSUMES_REF)


def padded_ref_length(cigar) -> Column:
    """Reference length including padding (P)."""
    return _sum_lengths(cigar, CONSUMES_REF + "P")


def read_length(cigar) -> Column:
    """Read bases consumed: M, I, S, =, X."""
    return _sum_lengths(cigar, CONSUMES_READ)


def inserted_bases(cigar) -> Column:
    return _sum_lengths(cigar, "I")


def deleted_bases(cigar) -> Column:
    return _sum_lengths(cigar, "D")


def element_count(cigar) -> Column:
    return F.size(F.regexp_extract_all(_c(cigar), F.lit(r"(\d+[MIDNSHP=X])"), 1))


def op_string(cigar) -> Column:
    """Operators only, e.g. ``10M2I20M`` -> ``MIM`` (``*`` -> empty)."""
    return F.regexp_replace(F.regexp_replace(_c(cigar), r"[0-9]", ""), r"\*", "")


def is_well_formed(cigar) -> Column:
    """``*`` or a non-empty run list."""
    c = _c(cigar)
    return (c == F.lit("*")) | c.rlike(VALID_CIGAR_REGEX)


def maps_no_bases(cigar) -> Column:
    """True when no element consumes both read and reference bases."""
    return ~_c(cigar).rlike("[M=X]")


def elements(cigar) -> Column:
    """``ARRAY<STRUCT<len INT, op STRING>>``; ``*`` -> empty array."""
    c = _c(cigar)
    lens = F.regexp_extract_all(c, F.lit(r"(\d+)[MIDNSHP=X]"), 1)
    ops = F.regexp_extract_all(c, F.lit(r"\d+([MIDNSHP=X])"), 1)
    return F.zip_with(lens, ops, lambda n, o: F.struct(n.cast("int").alias("len"), o.alias("op")))


def leading_clip(cigar) -> Column:
    """Sum of the leading run of S/H elements."""
    head = F.regexp_extract(_c(cigar), r"^((\d+[SH])+)", 1)
    return _sum_lengths(head, "SH")


def trailing_clip(cigar) -> Column:
    tail = F.regexp_extract(_c(cigar), r"((\d+[SH])+)$", 1)
    return _sum_lengths(tail, "SH")


def alignment_blocks(cigar, pos) -> Column:
    """Gapless aligned runs as ``ARRAY<STRUCT<read_start, ref_start, length>>``.

    1-based; M/=/X open a block; S and I advance the read; D and N advance the
    reference; H and P change nothing.
    """
    init = F.struct(F.lit(1).alias("r"), _c(pos).alias("g"),
                    F.array().cast("array<struct<read_start:int,ref_start:int,length:int>>").alias("b"))

    def step(acc, e):
        n, op = e["len"], e["op"]
        is_block = op.isin("M", "=", "X")
        blocks = F.when(is_block, F.concat(acc["b"], F.array(F.struct(
            acc["r"].alias("read_start"), acc["g"].alias("ref_start"), n.alias("length"))))
        ).otherwise(acc["b"])
        r = F.when(op.isin("M", "=", "X", "S", "I"), acc["r"] + n).otherwise(acc["r"])
        g = F.when(op.isin("M", "=", "X", "D", "N"), acc["g"] + n).otherwise(acc["g"])
        return F.struct(r.alias("r"), g.alias("g"), blocks.alias("b"))

    return F.aggregate(elements(cigar), init, step, lambda acc: acc["b"])
