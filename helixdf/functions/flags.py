"""SAM flag word as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SAM flag bits (name, bit).
PAIRED = 0x1
PROPER_PAIR = 0x2
UNMAPPED = 0x4
MATE_UNMAPPED = 0x8
REVERSE = 0x10
MATE_REVERSE = 0x20
FIRST_OF_PAIR = 0x40
SECOND_OF_PAIR = 0x80
SECONDARY = 0x100
QC_FAIL = 0x200
DUPLICATE = 0x400
SUPPLEMENTARY = 0x800

FLAG_BITS = {
    "paired": PAIRED, "proper_pair": PROPER_PAIR, "unmapped": UNMAPPED,
    "mate_unmapped": MATE_UNMAPPED, "reverse": REVERSE, "mate_reverse": MATE_REVERSE,
    "first_of_pair": FIRST_OF_PAIR, "second_of_pair": SECOND_OF_PAIR,
    "secondary": SECONDARY, "qc_fail": QC_FAIL, "duplicate": DUPLICATE,
}
# Only meaningful for paired reads; the record model refuses to answer otherwise.
PAIR_ONLY = ("proper_pair", "mate_unmapped", "mate_reverse", "first_of_pair", "second_of_pair")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has(flag, bit: int) -> Column:
    return (_c(flag).bitwiseAND(F.lit(bit)) != 0)


def flag_column(flag, name: str) -> Column:
    """Boolean for one named bit; NULL for pair-only bits of unpaired reads."""
    value = has(flag, FLAG_BITS[name])
    if name in PAIR_ONLY:
        return F.when(has(flag, PAIRED), value)
    return value


def decode_all(flag="flag") -> list[Column]:
    return [flag_column(flag, n).alias(n) for n in FLAG_BITS]


def set_bit(flag, bit: int, on=True) -> Column:
    """Set (``on`` true) or clear a bit; ``on`` may be a boolean Column."""
    f = _c(flag)
    cleared = f.bitwiseAND(F.lit(~bit & 0xFFFF))
    if isinstance(on, bool):
        return f.bitwiseOR(F.lit(bit)) if on else cleared
    return F.when(on, f.bitwiseOR(F.lit(bit))).otherwise(cleared)


def is_primary(flag) -> Column:
    """Neither a secondary nor a supplementary record."""
    return ~has(flag, SECONDARY | SUPPLEMENTARY)


def is_mapped(flag) -> Column:
    return ~has(flag, UNMAPPED)


def is_paired(flag) -> Column:
    return has(flag, PAIRED)
