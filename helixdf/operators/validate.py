"""Record, CIGAR, line, header and mate validation.

Every rule is a column predicate; a record's failures are collected in one
array (``array_compact`` of ``when(rule, struct)``) and exploded, so all rules
run in a single pass over the data. Output rows: ``qname, type, severity,
message``. A stringency policy then decides what happens to them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..functions import flags as fl
from ..functions import tags as tg
from ..sources import header as hd

# Validation error types reported as warnings, not errors.
WARNING_TYPES = ("INVALID_QUALITY_FORMAT", "PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND",
                 "ADJACENCT_INDEL_IN_CIGAR", "MISSING_TAG_NM", "RECORD_MISSING_READ_GROUP",
                 "E2_BASE_EQUALS_PRIMARY_BASE", "BAM_FILE_MISSING_TERMINATOR_BLOCK", "INVALID_DATE_STRING")
# Largest |insert size|; bases accepted in SEQ (IUPAC, '.', '=').
MAX_INSERT_SIZE = 1 << 29
N_REQUIRED_FIELDS = 11
VALID_BASES_REGEX = "^[acmgrsvtwyhkdbnACMGRSVTWYHKDBN.=]+$"



class Rule(NamedTuple):
    """One validation rule: a boolean column, its error type and message."""
    cond: Column
    type: str
    message: str

    def column(self) -> Column:
        return F.when(self.cond, F.struct(F.lit(self.type).alias("type"), F.lit(self.message).alias("message")))


def _e(cond: Column, type_: str, message: str) -> Rule:
    return Rule(cond, type_, message)


def severity(type_col) -> Column:
    t = F.col(type_col) if isinstance(type_col, str) else type_col
    return F.when(t.isin(*WARNING_TYPES), F.lit("WARNING")).otherwise(F.lit("ERROR"))


def explode_errors(df: DataFrame, rules: list[Rule], keep: list[str] | None = None) -> DataFrame:
    """One row per broken rule per record: ``keep`` + type, severity, message."""
    keep = keep or ["qname"]
    errs = F.array_compact(F.array(*[r.column() for r in rules]))
    out = df.select(*keep, F.explode(errs).alias("_e"))
    return out.select(*keep, F.col("_e.type").alias("type"), severity(F.col("_e.type")).alias("severity"),
                      F.col("_e.message").alias("message"))


# --- rule sets ------------------------------------------------------------------------

def flag_rules() -> list[Column]:
    f = F.col("flag")
    unpaired = ~fl.has(f, fl.PAIRED)
    paired = fl.has(f, fl.PAIRED)
    no_mate_ref = F.col("mate_ref_index") == -1
    return [
        _e(unpaired & fl.has(f, fl.PROPER_PAIR), "INVALID_FLAG_PROPER_PAIR", "bit 0x2 needs bit 0x1"),
        _e(unpaired & fl.has(f, fl.MATE_UNMAPPED), "INVALID_FLAG_MATE_UNMAPPED", "bit 0x8 needs bit 0x1"),
        _e(unpaired & fl.has(f, fl.MATE_REVERSE), "INVALID_FLAG_MATE_NEG_STRAND", "bit 0x20 needs bit 0x1"),
        _e(unpaired & fl.has(f, fl.FIRST_OF_PAIR), "INVALID_FLAG_FIRST_OF_PAIR", "bit 0x40 needs bit 0x1"),
        _e(unpaired & fl.has(f, fl.SECOND_OF_PAIR), "INVALID_FLAG_SECOND_OF_PAIR", "bit 0x80 needs bit 0x1"),
        _e(unpaired & ~no_mate_ref, "INVALID_MATE_REF_INDEX", "a mate contig needs bit 0x1"),
        _e(paired & no_mate_ref & ~fl.has(f, fl.MATE_UNMAPPED), "INVALID_FLAG_MATE_UNMAPPED",
           "bit 0x8 is off but the mate has no contig"),
        _e(paired & ~fl.has(f, fl.FIRST_OF_PAIR) & ~fl.has(f, fl.SECOND_OF_PAIR),
           "PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND", "bit 0x1 without bit 0x40 or 0x80"),
        _e(fl.has(f, fl.UNMAPPED) & fl.has(f, fl.SECONDARY), "INVALID_FLAG_NOT_PRIM_ALIGNMENT",
           "bits 0x4 and 0x100 exclude each other"),
    ]


def position_rules(mate: bool = False) -> list[Column]:
    """Reference / start consistency; needs ``ref_length`` (NULL = not in the
    dictionary) and, for mates, ``mate_ref_length``."""
    p = "mate_" if mate else ""
    who = "mate " if mate else ""
    ref, pos, length = F.col(p + "ref_index"), F.col(p + "pos"), F.col(p + "ref_length")
    has_ref = ref != -1
    rules = [
        _e(~has_ref & (pos != 0), "INVALID_ALIGNMENT_START", who + "position given, contig absent"),
        _e(has_ref & (pos == 0), "INVALID_ALIGNMENT_START", who + "contig given, position absent"),
        _e(has_ref & length.isNull(), "INVALID_REFERENCE_INDEX", who + "contig index unknown to the header"),
        _e(has_ref & length.isNotNull() & (pos > length), "INVALID_ALIGNMENT_START", who + "position beyond the contig"),
    ]
    if mate:
        return [Rule(fl.has("flag", fl.PAIRED) & r.cond, r.type, r.message) for r in rules]
    rules.append(_e(~fl.has("flag", fl.UNMAPPED) & ~has_ref, "INVALID_FLAG_READ_UNMAPPED",
                    "bit 0x4 is off but there is no contig"))
    return rules


def range_rules() -> list[Column]:
    unmapped = fl.has("flag", fl.UNMAPPED)
    return [
        _e(F.abs(F.col("isize")) > MAX_INSERT_SIZE, "INVALID_INSERT_SIZE", "template length beyond 2^29"),
        _e(unmapped & (F.col("mapq") != 0), "INVALID_MAPPING_QUALITY", "unmapped with a mapping quality"),
        _e(~unmapped & (F.col("mapq") >= 256), "INVALID_MAPPING_QUALITY", "mapping quality does not fit a byte"),
    ]


def cigar_rules() -> list[Column]:
    """Structural CIGAR rules as regular expressions on the operator string
    (one row per broken rule; all checks run in generated code)."""
    ops = cg.op_string("cigar")
    real = "MIDN=X"
    mapped = ~fl.has("flag", fl.UNMAPPED)
    non_empty = F.col("cigar") != "*"
    checked = mapped & non_empty
    # between the hard clips at the ends, a soft clip is the first or the last run
    unclipped = F.regexp_replace(ops, "^H|H$", "")
    return [
        _e(mapped & ~non_empty, "INVALID_CIGAR", "mapped, yet no CIGAR"),
        _e(checked & ops.rlike("^.+H.+$"), "INVALID_CIGAR", "H between other runs"),
        _e(checked & unclipped.rlike(".S."), "INVALID_CIGAR", "S between other runs"),
        _e(checked & ops.rlike("I[^MX=NP]*I"), "INVALID_CIGAR", "insertions not kept apart by an aligned run"),
        _e(checked & ops.rlike("D[^MX=NP]*D"), "INVALID_CIGAR", "deletions not kept apart by an aligned run"),
        _e(checked & ops.rlike(".P$"), "INVALID_CIGAR", "P closes the CIGAR"),
        _e(checked & (ops.rlike(f"[^{real}]P") | ops.rlike(f".P[^{real}]")), "INVALID_CIGAR",
           "P next to a clip"),
        _e(checked & ~ops.rlike(f"[{real}]"), "INVALID_CIGAR", "only clips and padding"),
    ]


def off_reference_rules() -> list[Column]:
    """An aligned block ends past the contig end (needs ``ref_length``)."""
    # Block ends grow along the CIGAR, so the last aligned run decides.
    upto_last = F.regexp_extract("cigar", r"^(.*[M=X])", 1)
    past = (F.length(upto_last) > 0) & (F.col("pos") + cg.ref_length(upto_last) - 1 > F.col("ref_length"))
    return [_e(~fl.has("flag", fl.UNMAPPED) & (F.col("ref_index") != -1) & F.col("ref_length").isNotNull() & past,
               "CIGAR_MAPS_OFF_REFERENCE", "aligned bases beyond the contig")]


#: Tags of colour-space reads, which may come without bases.
COLOUR_TAGS = ("FZ", "CS", "CQ")


def sequence_rules(tags: str | None = None) -> list[Column]:
    """Bases against qualities. With ``tags`` (name of a tag map column) a read without bases
    is in order if it has a colour-space tag."""
    colour = F.lit(False) if tags is None else F.coalesce(F.exists(F.map_keys(tags), lambda k: k.isin(*COLOUR_TAGS)), F.lit(False))
    seq_len = F.when(F.col("seq") == "*", F.lit(0)).otherwise(F.length("seq"))
    qual_len = F.when(F.col("qual") == "*", F.lit(0)).otherwise(F.length("qual"))
    return [
        _e((seq_len == 0) & ~fl.has("flag", fl.SECONDARY) & ~colour, "EMPTY_READ", "no bases and no colour-space tag"),
        _e((seq_len != qual_len) & (F.col("qual") != "*"), "MISMATCH_READ_LENGTH_AND_QUALS_LENGTH",
           "bases and qualities differ in number"),
    ]


# --- line-level (SAM text) checks --------------------------------------------------------

def line_rules() -> list[Column]:
    """Checks of one SAM text line; needs ``f`` (field array) and ``n_fields``."""
    f = F.col("f")
    n = F.size(f)
    text = [F.get(f, F.lit(i)) for i in range(11)]
    flag, pos, mapq, mpos, isize = (tg.whole_number(text[i]) for i in (1, 3, 4, 7, 8))
    rname, cigar, mrnm, seq, qual = (text[i] for i in (2, 5, 6, 9, 10))
    mapped = flag.bitwiseAND(fl.UNMAPPED) == 0
    paired = flag.bitwiseAND(fl.PAIRED) != 0
    mate_unmapped = flag.bitwiseAND(fl.MATE_UNMAPPED) != 0
    ok = n >= 11
    mate_set = mrnm != "*"
    return [
        _e(n < 11, "MISSING_FIELD", "the 11 fixed columns are not complete"),
        _e(F.exists(f, lambda x: F.length(x) == 0), "EMPTY_FIELD", "a column is empty"),
        _e(ok & flag.isNull(), "INVALID_FLAG", "column FLAG holds no number"),
        _e(ok & (rname == "*") & mapped, "MISSING_RNAME", "mapped, column RNAME is *"),
        _e(ok & (rname != "*") & (pos == 0), "INVALID_ALIGNMENT_START", "RNAME given, POS is 0"),
        _e(ok & (rname != "*") & mapped & (cigar == "*"), "INVALID_CIGAR", "mapped to RNAME, CIGAR is *"),
        _e(ok & (rname == "*") & (pos != 0), "INVALID_ALIGNMENT_START", "RNAME is *, POS given"),
        _e(ok & (rname == "*") & (mapq != 0), "INVALID_MAPPING_QUALITY", "RNAME is *, MAPQ given"),
        _e(ok & (rname == "*") & (cigar != "*"), "INVALID_CIGAR", "RNAME is *, CIGAR given"),
        _e(ok & ~mate_set & paired & ~mate_unmapped, "MISSING_MRNM", "mate mapped, column RNEXT is *"),
        _e(ok & mate_set & ~paired, "INVALID_MATE_REF_INDEX", "RNEXT given, read unpaired"),
        _e(ok & (mrnm == "=") & (rname == "*"), "INVALID_MATE_REF_INDEX", "RNEXT copies an absent RNAME"),
        _e(ok & mate_set & (mpos == 0), "INVALID_MATE_ALIGNMENT_START", "RNEXT given, PNEXT is 0"),
        _e(ok & ~mate_set & (mpos != 0), "INVALID_MATE_ALIGNMENT_START", "RNEXT is *, PNEXT given"),
        _e(ok & ~mate_set & (isize != 0), "INVALID_INSERT_SIZE", "RNEXT is *, TLEN given"),
        _e(ok & (seq != "*") & ~seq.rlike(VALID_BASES_REGEX), "INVALID_READ_BASES", "SEQ holds other characters than base codes"),
        _e(ok & (qual != "*") & (seq == "*"), "QUAL_WITHOUT_SEQ", "SEQ is *, QUAL given"),
        _e(ok & (qual != "*") & (seq != "*") & (F.length(qual) != F.length(seq)),
           "MISMATCH_READ_LENGTH_AND_QUALS_LENGTH", "SEQ and QUAL differ in length"),
    ]


def validate_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    body = lines.filter(~F.col(col).startswith("@")).select(
        F.split(F.col(col), "\t")[0].alias("qname"), F.split(F.col(col), "\t").alias("f"))
    return explode_errors(body, line_rules())


#: Columns that hold a number: place, name, error type.
NUMBERS = ((1, "FLAG", "INVALID_FLAG"), (3, "POS", "INVALID_ALIGNMENT_START"), (4, "MAPQ", "INVALID_MAPPING_QUALITY"),
           (7, "PNEXT", "INVALID_MATE_ALIGNMENT_START"), (8, "TLEN", "INVALID_INSERT_SIZE"))


def grammar_rules(dictionary: bool) -> list[Rule]:
    """Numbers and contig names of a line; needs ``f``, and with ``dictionary`` also
    ``rname_known`` and ``rnext_known``."""
    f = F.col("f")
    ok = F.size(f) >= N_REQUIRED_FIELDS
    rname, rnext = F.get(f, F.lit(2)), F.get(f, F.lit(6))
    rules = [_e(ok & tg.whole_number(F.get(f, F.lit(i))).isNull(), kind, f"column {name} holds no number")
             for i, name, kind in NUMBERS if name != "FLAG"]
    rules.append(_e(ok & rname.startswith("="), "INVALID_REFERENCE_INDEX", "RNAME cannot be ="))
    if dictionary:
        rules += [_e(ok & (rname != "*") & ~F.col("rname_known"), "INVALID_REFERENCE_INDEX", "RNAME is not in the dictionary"),
                  _e(ok & ~rnext.isin("*", "=") & ~F.col("rnext_known"), "INVALID_MATE_REF_INDEX", "RNEXT is not in the dictionary")]
    return rules


def tag_errors() -> Column:
    """Array of (type, message), one for each malformed tag of a line (``f``)."""
    # one step after the other, so that a tag is split and judged once
    def judged(text):
        t = F.split(text, ":", 3)
        return F.struct(text.alias("text"), t.alias("p"))

    def reason(t):
        p = t["p"]
        why = F.when(F.size(p) != 3, F.lit("a tag has three parts")).otherwise(tg.tag_error(F.get(p, F.lit(1)), F.get(p, F.lit(2))))
        return F.struct(t["text"].alias("text"), why.alias("why"))

    def named(t):
        return F.struct(F.lit("INVALID_TAG").alias("type"), F.concat(t["text"], F.lit(": "), t["why"]).alias("message"))

    f = F.col("f")
    rest = F.slice(f, N_REQUIRED_FIELDS + 1, F.greatest(F.size(f) - N_REQUIRED_FIELDS, F.lit(0)))
    wrong = F.filter(F.transform(F.transform(rest, judged), reason), lambda t: t["why"].isNotNull())
    return F.transform(wrong, named)


def line_report(lines: DataFrame, contigs: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Every error of SAM text lines: columns, numbers, contig names and the grammar of all tags.

    Returns ``keep`` (columns of ``lines``), qname, type, severity, message, one row per error.
    Header lines and null lines have none; without contigs names are not looked up. The
    dictionary is header-bounded and broadcast; a line is read once for all rules."""
    keep = keep or []
    body = lines.select(*keep, F.split(F.col(col), "\t").alias("f"))
    body = body.withColumn("qname", F.get("f", F.lit(0)))
    dictionary = not contigs.isEmpty()
    if dictionary:
        for place, out in ((2, "rname_known"), (6, "rnext_known")):
            names = F.broadcast(contigs.select(F.col("ref_name").alias("_name"), F.lit(True).alias(out)).distinct())
            # a name ends at its first blank
            name = F.regexp_extract(F.get("f", F.lit(place)), r"^(\S*)", 1)
            body = body.join(names, name == F.col("_name"), "left").drop("_name").withColumn(out, F.coalesce(out, F.lit(False)))
    # Nulls (rules that hold) are dropped as rows: a filter of the array would take its rules out of generated code.
    # Header lines are left out here and not by a filter before: Spark would move that below the columns that
    # make up the line and work them out once more for every use.
    fixed = F.array(*[r.column() for r in line_rules() + grammar_rules(dictionary)])
    out = body.select(*keep, "qname", F.explode(F.when(~F.col("qname").startswith("@"), F.concat(fixed, tag_errors()))).alias("_e")).filter(F.col("_e").isNotNull())
    return out.select(*keep, "qname", F.col("_e.type").alias("type"), severity(F.col("_e.type")).alias("severity"),
                      F.col("_e.message").alias("message"))


def validate_header(header_lines: DataFrame) -> DataFrame:
    errs = hd.header_errors(header_lines)
    return errs.select("ord", "type", severity(F.col("type")).alias("severity"))


def validate_read_groups(reads: DataFrame, read_groups: DataFrame, rg_col: str = "rg") -> DataFrame:
    """Reads whose RG is not a header read group (broadcast: header-bounded)."""
    ids = F.broadcast(read_groups.select(F.col("id").alias(rg_col)))
    bad = reads.filter(F.col(rg_col).isNotNull()).join(ids, rg_col, "left_anti")
    return bad.select("qname", F.lit("READ_GROUP_NOT_FOUND").alias("type"), F.lit("ERROR").alias("severity"),
                      F.concat(F.lit("read group absent from the header: "), F.col(rg_col)).alias("message"))


def validate_mates(reads: DataFrame) -> DataFrame:
    """Mate consistency for paired reads.

    Records are first reduced to one row per (qname, end) (primary record +
    count), then the two ends of a name meet in one join: a name with many
    records never produces all pairs.
    """
    paired = reads.filter(fl.has("flag", fl.PAIRED))
    end = F.when(fl.has("flag", fl.FIRST_OF_PAIR), 1).when(fl.has("flag", fl.SECOND_OF_PAIR), 2).otherwise(0)
    order_key = F.struct(fl.has("flag", fl.SECONDARY).cast("int"), F.col("pos"), F.col("flag"))
    ends = (paired.withColumn("_end", end).groupBy("qname", "_end")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min_by(F.struct("flag", "ref_index", "pos", "mate_ref_index", "mate_pos"), order_key).alias("r")))
    a = ends.select(F.col("qname"), F.col("_end").alias("a_end"), F.col("n").alias("a_n"), F.col("r").alias("a_r"))
    b = ends.select(F.col("qname").alias("b_qname"), F.col("_end").alias("b_end"), F.col("r").alias("b_r"))
    j = a.join(b, (a["qname"] == b["b_qname"]) & (a["a_end"] != b["b_end"]), "left")
    me, mate = F.col("a_r"), F.col("b_r")
    found = F.col("b_qname").isNotNull()
    rules = [
        _e(~found & (F.col("a_n") == 1), "MATE_NOT_FOUND", "no record of the other end"),
        _e(F.col("a_n") > 1, "MATES_ARE_SAME_END", "several records of one end"),
        _e(found & (fl.has(me["flag"], fl.MATE_UNMAPPED) != fl.has(mate["flag"], fl.UNMAPPED)),
           "MISMATCH_FLAG_MATE_UNMAPPED", "bit 0x8 differs from bit 0x4 of the other end"),
        _e(found & (fl.has(me["flag"], fl.MATE_REVERSE) != fl.has(mate["flag"], fl.REVERSE)),
           "MISMATCH_FLAG_MATE_NEG_STRAND", "bit 0x20 differs from bit 0x10 of the other end"),
        _e(found & (me["mate_ref_index"] != mate["ref_index"]), "MISMATCH_MATE_REF_INDEX",
           "mate contig differs from that of the other end"),
        _e(found & (me["mate_pos"] != mate["pos"]), "MISMATCH_MATE_ALIGNMENT_START",
           "mate position differs from that of the other end"),
    ]
    return explode_errors(j, rules)


def validate_records(reads: DataFrame) -> DataFrame:
    """All record-level rule sets in one pass (needs ref_length, mate_ref_length,
    mate_ref_index, mate_pos, isize)."""
    return explode_errors(reads, record_rules())


def summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("type", "severity").agg(F.count(F.lit(1)).alias("n"))


def record_rules() -> list[Rule]:
    return (flag_rules() + position_rules() + position_rules(mate=True) + range_rules()
            + cigar_rules() + off_reference_rules() + sequence_rules())


def summary_counts(reads: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Errors by (type, severity) without materialising error rows: one
    aggregation with a counter per rule (combined map-side), unpivoted."""
    rules = rules if rules is not None else record_rules()
    counts = reads.agg(*[F.count_if(r.cond).alias(f"c{i}") for i, r in enumerate(rules)])
    pairs = ", ".join(f"'{r.type}', c{i}" for i, r in enumerate(rules))
    rows = counts.selectExpr(f"stack({len(rules)}, {pairs}) as (type, n)")
    return (rows.groupBy("type").agg(F.sum("n").cast("long").alias("n"))
            .filter(F.col("n") > 0).select("type", severity(F.col("type")).alias("severity"), "n"))


# --- stringency ------------------------------------------------------------------------

def assert_valid(reads: DataFrame, rules: list[Rule]) -> DataFrame:
    """``reads`` with every record checked as it passes: the action that first reads a record
    breaking a rule of severity ERROR fails and names it. A filter, so no later column
    pruning takes the check away, and nothing runs before that action."""
    broken = F.array_compact(F.array(*[r.column() for r in rules if r.type not in WARNING_TYPES]))
    said = F.concat(F.lit("SAM validation error: "), F.try_element_at(broken, F.lit(1))["type"], F.lit(" on "), F.coalesce("qname", F.lit("?")))
    return reads.filter(F.when(F.size(broken) > 0, F.raise_error(said).cast("boolean")).otherwise(F.lit(True)))


def apply_stringency(reads: DataFrame, errors: DataFrame, mode: str, rules: list[Rule] | None = None):
    """STRICT: the returned reads fail at the first bad record that an action reads
    (``rules``: those that ``errors`` was made with, all record rules by default);
    LENIENT: keep every record, return the errors as a side table;
    SILENT: keep every record, no report. Returns (reads, errors or None)."""
    mode = mode.upper()
    if mode == "SILENT":
        return reads, None
    if mode == "LENIENT":
        return reads, errors
    if mode == "STRICT":
        return assert_valid(reads, record_rules() if rules is None else rules), errors
    raise ValueError(f"unknown stringency {mode}")
