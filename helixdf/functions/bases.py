"""Base and base-quality column expressions (no per-row Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Phred+33 text encoding; highest storable quality.
PHRED_OFFSET = 33
MAX_PHRED = 93
# Illumina 1.3+ to Phred shift and the "reasonable Sanger" cap.
ILLUMINA_TO_PHRED = 31
SANGER_MAX = 60
# SQ tag layout (2nd-best base in the top 2 bits, A=0 C=1 G=2 T=3).
SQ_BASE_SHIFT = 6
SQ_QUALITY_MASK = 63
SQ_BASES = "ACGT"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def chars(s) -> Column:
    """String -> array of one-character strings (empty string -> empty array).

    ``split(s, '')`` yields the characters; only the empty string needs care
    (it splits to ``['']``). No lambda, so it stays in generated code.
    """
    c = _c(s)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ""))


def phred_decode(qual) -> Column:
    """Phred+33 text -> ``ARRAY<INT>``; ``*`` -> empty; NULL if any char is out of 33..126."""
    q = _c(qual)
    arr = F.transform(chars(q), lambda ch: F.ascii(ch) - PHRED_OFFSET)
    in_range = q.rlike("^[!-~]*$")          # characters 33..126, checked by a regex
    return F.when(q == "*", F.array().cast("array<int>")).when(in_range, arr)


def phred_encode(quals) -> Column:
    """``ARRAY<INT>`` 0..93 -> Phred+33 text; NULL if any value is out of range."""
    def encoded(a):
        bad = F.exists(a, lambda x: (x < 0) | (x > MAX_PHRED))
        return F.when(~bad, F.array_join(F.transform(a, lambda x: F.char(x + PHRED_OFFSET)), ""))

    # inside a list of one the argument is worked out once for both uses
    return F.get(F.transform(F.array(_c(quals)), encoded), F.lit(0))


def fix_illumina_quals(quals) -> Column:
    """Shift Illumina-1.3 qualities to Phred (negative results stay, for flagging)."""
    return F.transform(_c(quals), lambda x: x - ILLUMINA_TO_PHRED)


def quality_errors(reads):
    """Reads of which a quality falls under 0 when shifted from Illumina-1.3 to Phred: qname,
    ``at`` (1-based place of the first such quality) and ``value`` (what it becomes). Reads
    with null or absent qualities have none."""
    low = F.transform(fix_illumina_quals(phred_decode("qual")), lambda x: F.when(x < 0, x))
    at = F.array_position(F.transform(low, lambda x: x.isNotNull()), True).cast("int")
    return reads.select("qname", at.alias("at"), low.alias("_low")).filter(F.col("at") > 0).select(
        "qname", "at", F.get("_low", F.col("at") - 1).alias("value"))


def normalize_bases(seq) -> Column:
    return F.translate(F.upper(_c(seq)), ".", "N")


def reverse_complement(seq) -> Column:
    """Complement A/C/G/T (either case) and reverse; other symbols unchanged."""
    return F.reverse(F.translate(_c(seq), "ACGTacgt", "TGCAtgca"))


def no_call_count(seq) -> Column:
    return F.length(F.regexp_replace(_c(seq), "[^Nn.]", ""))


def invalid_base_count(seq) -> Column:
    return F.length(F.regexp_replace(_c(seq), "[ACGTacgt]", ""))


def bases_equal(a, b) -> Column:
    return F.upper(_c(a)) == F.upper(_c(b))


def gc_fraction(seq) -> Column:
    """(G + C) / length, case-insensitive; NULL for empty sequences."""
    s = _c(seq)
    gc = F.length(F.regexp_replace(s, "[^GCgc]", ""))
    return F.when(F.length(s) > 0, gc / F.length(s))


def sq_base(sq) -> Column:
    """2nd-best base letter of an SQ byte (0..255)."""
    idx = F.shiftright(_c(sq).bitwiseAND(0xFF), SQ_BASE_SHIFT)
    return F.substring(F.lit(SQ_BASES), 1, 4).substr(idx + 1, F.lit(1))


def sq_prob_ratio(sq) -> Column:
    return _c(sq).bitwiseAND(SQ_QUALITY_MASK)


def sq_encode(base_ordinal, prob_ratio) -> Column:
    return F.shiftleft(_c(base_ordinal), SQ_BASE_SHIFT).bitwiseOR(
        F.least(_c(prob_ratio), F.lit(SQ_QUALITY_MASK)))


def sq_scaled_ratio(second, third) -> Column:
    """round(-10 log10(third / second)) capped at 63; NULL when out of range."""
    s, t = _c(second), _c(third)
    ok = (s < 1.0) & (t > 0) & (t <= s)
    return F.when(ok, F.least(F.round(-10.0 * F.log10(t / s)).cast("int"), F.lit(SQ_QUALITY_MASK)))


def sq_complement(sq) -> Column:
    """Complement the base of an SQ byte, keep its probability bits."""
    ordinal = F.shiftright(_c(sq).bitwiseAND(0xFF), SQ_BASE_SHIFT)
    return sq_encode(F.lit(3) - ordinal, sq_prob_ratio(sq))
