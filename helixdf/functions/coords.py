"""Coordinate arithmetic: alignment end, clipping, genomic bins, interval math.

Positions are 1-based inclusive unless a name says ``0`` (0-based) — the BAI
binning scheme from the SAM specification works on 0-based half-open ranges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cigar as cg
from .flags import UNMAPPED

# BAI binning scheme (SAM spec). Level k covers 2^(29-3k) bp
# bins; first bin id of each level; linear-index window is 16 kbp.
LEVEL_SHIFTS = (26, 23, 20, 17, 14)
LEVEL_FIRST_BIN = (0, 1, 9, 73, 585, 4681)
MAX_BIN = 37450
LINEAR_SHIFT = 14


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def alignment_end(pos, cigar, flag) -> Column:
    """1-based inclusive end; 0 for unmapped reads."""
    return F.when(_c(flag).bitwiseAND(UNMAPPED) != 0, F.lit(0)) \
        .otherwise(_c(pos) + cg.ref_length(cigar) - 1)


def unclipped_start(pos, cigar) -> Column:
    return _c(pos) - cg.leading_clip(cigar)


def unclipped_end(end, cigar) -> Column:
    return _c(end) + cg.trailing_clip(cigar)


def reg2bin(beg0, end0) -> Column:
    """Smallest bin fully containing 0-based half-open [beg0, end0)."""
    b, e = _c(beg0), _c(end0) - 1
    # The finest level whose bin holds both ends wins; level 0 (bin 0) otherwise.
    chain = None
    for shift, first in zip(reversed(LEVEL_SHIFTS), reversed(LEVEL_FIRST_BIN[1:])):
        cond = F.shiftright(b, shift) == F.shiftright(e, shift)
        val = F.lit(first) + F.shiftright(b, shift)
        chain = F.when(cond, val) if chain is None else chain.when(cond, val)
    return chain.otherwise(F.lit(0))


def indexing_bin(pos, end) -> Column:
    """Bin of a record: [pos-1, end) with unaligned records taken as one base."""
    beg0 = _c(pos) - 1
    end0 = F.when(_c(end) <= 0, beg0 + 1).otherwise(_c(end))
    return reg2bin(beg0, end0)


def linear_window(pos) -> Column:
    """16 kbp linear-index window of a 1-based position."""
    return F.shiftright(F.greatest(_c(pos) - 1, F.lit(0)), LINEAR_SHIFT)


def bin_level(bin_) -> Column:
    b = _c(bin_)
    return (F.when(b >= 4681, 5).when(b >= 585, 4).when(b >= 73, 3)
            .when(b >= 9, 2).when(b >= 1, 1).otherwise(0))


def _level_lookup(values, lvl) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in values]), lvl + 1)


def bin_size(bin_) -> Column:
    """Bases covered by one bin of the bin's level (2^29 at level 0 ... 2^14)."""
    return _level_lookup([1 << (29 - 3 * k) for k in range(6)], bin_level(bin_))


def bin_first_locus(bin_) -> Column:
    """1-based first locus covered by a bin."""
    b = _c(bin_)
    return (b - _level_lookup(LEVEL_FIRST_BIN, bin_level(b))) * bin_size(b) + 1


def bin_last_locus(bin_) -> Column:
    return bin_first_locus(bin_) + bin_size(bin_) - 1


def max_bin_for_length(length) -> Column:
    return F.lit(4681) + F.shiftright(_c(length), 14)


def region_bins(start1, end1) -> Column:
    """Every bin that may hold a record overlapping 1-based [start1, end1]."""
    beg0 = _c(start1) - 1
    end0 = _c(end1) - 1            # inclusive 0-based end
    parts = [F.array(F.lit(0))]
    for shift, first in [(26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)]:
        parts.append(F.sequence(F.lit(first) + F.shiftright(beg0, shift),
                                F.lit(first) + F.shiftright(end0, shift)))
    return F.flatten(F.array(*parts))


# --- interval math over 1-based inclusive coordinates -------------------------

def interval_length(start, end) -> Column:
    return _c(end) - _c(start) + 1


def start_from_end(end, length) -> Column:
    return _c(end) - _c(length) + 1


def end_from_start(start, length) -> Column:
    return _c(start) + _c(length) - 1


def overlaps(s1, e1, s2, e2) -> Column:
    return (_c(s1) <= _c(e2)) & (_c(s2) <= _c(e1))


def encloses(outer_s, outer_e, inner_s, inner_e) -> Column:
    return (_c(inner_s) >= _c(outer_s)) & (_c(inner_e) <= _c(outer_e))


def overlap_length(s1, e1, s2, e2) -> Column:
    return F.greatest(F.lit(0), F.least(_c(e1), _c(e2)) - F.greatest(_c(s1), _c(s2)) + 1)


def sequencing_cycle(offset0, read_length, negative_strand) -> Column:
    """1-based machine cycle of a 0-based read offset (reversed on the minus strand)."""
    return F.when(_c(negative_strand), _c(read_length) - _c(offset0)).otherwise(_c(offset0) + 1)
