"""Literal edge cases and properties (no driver data needed)."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from helixdf.functions import bases as bs
from helixdf.functions import cigar as cg
from helixdf.functions import coords as co
from helixdf.functions import flags as fl
from helixdf.operators import intervals, islands, order, preprocess, records, stats
from helixdf.operators import validate as va
from helixdf.sources import header as hd

READ_SCHEMA = "qname string, flag int, ref_index int, pos int, mapq int, cigar string, seq string, qual string"


def _reads(spark, rows):
    return spark.createDataFrame(rows, READ_SCHEMA)


# --- CIGAR ------------------------------------------------------------------------

CIGAR_CASES = {
    "*": {"mapped, yet no CIGAR"},
    "0M": set(),
    "5S10M": set(),
    "5M5S5M": {"S between other runs"},
    "3H2S10M2S3H": set(),
    "10M2D2D10M": {"deletions not kept apart by an aligned run"},
    "2P10M": set(),
    "10M2P": {"P closes the CIGAR"},
    "10M1I1P1I10M": set(),
    "10M1I1I10M": {"insertions not kept apart by an aligned run"},
    "5M3H5M": {"H between other runs"},
    "5S5H": {"only clips and padding"},
}


def test_cigar_validation_edge_cases(spark):
    rows = [(c, 0, 1, 100, 30, c, "A", "I") for c in CIGAR_CASES]
    errs = va.explode_errors(_reads(spark, rows), va.cigar_rules()).collect()
    got = {c: set() for c in CIGAR_CASES}
    for r in errs:
        got[r.qname].add(r.message)
    assert got == CIGAR_CASES


def test_cigar_lengths_and_blocks(spark):
    df = spark.createDataFrame([("3S10M1D10M1I8M", 100)], "cigar string, pos int")
    r = df.select(cg.ref_length("cigar").alias("rl"), cg.read_length("cigar").alias("ql"),
                  cg.padded_ref_length("cigar").alias("pl"), cg.element_count("cigar").alias("n"),
                  cg.alignment_blocks("cigar", "pos").alias("b")).first()
    assert (r.rl, r.ql, r.pl, r.n) == (29, 32, 29, 6)
    assert [(b.read_start, b.ref_start, b.length) for b in r.b] == [(4, 100, 10), (14, 111, 10), (25, 121, 8)]


def test_reg2bin_matches_spec(spark):
    def reg2bin(beg, end):
        end -= 1
        for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
            if beg >> shift == end >> shift:
                return first + (beg >> shift)
        return 0
    random.seed(7)
    cases = [(b, b + random.choice([1, 50, 20000, 300000, 5000000, 100000000]))
             for b in (random.randrange(0, 1 << 29) for _ in range(300))]
    df = spark.createDataFrame(cases, "b int, e int")
    got = [r[0] for r in df.select(co.reg2bin("b", "e")).collect()]
    assert got == [reg2bin(b, e) for b, e in cases]


# --- flags ---------------------------------------------------------------------------

def test_flag_rules(spark):
    rows = [("unpaired_first", 64, -1), ("paired_no_end", 1, -1), ("unmapped_secondary", 4 | 256, -1),
            ("proper_unpaired", 2, -1), ("ok_pair", 1 | 8 | 64, -1), ("ok_single", 16, -1)]
    df = spark.createDataFrame(rows, "qname string, flag int, mate_ref_index int")
    errs = {(r.qname, r.type) for r in va.explode_errors(df, va.flag_rules()).collect()}
    assert ("unpaired_first", "INVALID_FLAG_FIRST_OF_PAIR") in errs
    assert ("paired_no_end", "PAIRED_READ_NOT_MARKED_AS_FIRST_OR_SECOND") in errs
    assert ("unmapped_secondary", "INVALID_FLAG_NOT_PRIM_ALIGNMENT") in errs
    assert ("proper_unpaired", "INVALID_FLAG_PROPER_PAIR") in errs
    assert not any(q in ("ok_pair", "ok_single") for q, _ in errs)


def test_decode_flags_pair_only_null(spark):
    df = spark.createDataFrame([(64,), (65,)], "flag int")
    r = df.select(*fl.decode_all("flag")).collect()
    assert r[0].first_of_pair is None and r[1].first_of_pair is True


# --- qualities and bases --------------------------------------------------------------------

def test_phred_round_trip_and_range(spark):
    df = spark.createDataFrame([("!~I",), ("A B",), ("*",)], "q string")
    r = df.select(bs.phred_decode("q").alias("d")).collect()
    assert r[0].d == [0, 93, 40]
    assert r[1].d is None                     # ' ' is below 33
    assert r[2].d == []
    back = df.select(bs.phred_encode(bs.phred_decode("q")).alias("e")).first().e
    assert back == "!~I"


def test_quality_encoding_threshold(spark):
    df = spark.createDataFrame([("a", 0, chr(60 + 33)), ("b", 0, chr(61 + 33))], "g string, o int, qual string")
    got = {r.g: r.encoding for r in stats.quality_encoding_guess(df, "g", "o").collect()}
    assert got == {"a": "SANGER", "b": "ILLUMINA"}


def test_reverse_complement_involution(spark):
    df = spark.createDataFrame([("ACGTNacgtn.",)], "s string")
    r = df.select(bs.reverse_complement("s").alias("rc"),
                  bs.reverse_complement(bs.reverse_complement("s")).alias("rr")).first()
    assert r.rc == ".nacgtNACGT" and r.rr == "ACGTNacgtn."


# --- islands -------------------------------------------------------------------------------

def test_islands_gap_rule(spark):
    rows = [(1, 1, 10), (1, 61, 70),          # 61 <= 10 + 51 joins
            (1, 122, 130),                    # 122 > 70 + 51 splits
            (1, 125, 126), (1, 122, 124),     # contained / equal start
            (2, 5, 5)]
    df = spark.createDataFrame(rows, "ref_index int, start int, end int")
    got = sorted(tuple(r) for r in islands.islands(df).collect())
    assert got == [(1, 1, 70, 2), (1, 122, 130, 3), (2, 5, 5, 1)]


def test_islands_two_phase_equals_single_pass(spark):
    random.seed(3)
    rows = []
    for _ in range(3000):
        s = random.randrange(1, 400000)
        rows.append((random.randrange(1, 4), s, s + random.choice([0, 30, 150, 20000])))
    df = spark.createDataFrame(rows, "ref_index int, start int, end int")
    got = sorted(tuple(r) for r in islands.islands(df).collect())
    exp = []
    for ref in sorted({r[0] for r in rows}):
        cur = None
        for _, s, e in sorted(r for r in rows if r[0] == ref):
            if cur and s <= cur[1] + 51:
                cur = [cur[0], max(cur[1], e), cur[2] + 1]
            else:
                if cur:
                    exp.append((ref, *cur))
                cur = [s, e, 1]
        exp.append((ref, *cur))
    assert got == sorted(exp)


# --- ranks and regions ------------------------------------------------------------------------

@pytest.mark.parametrize("n,k", [(3, 8), (8, 8), (21, 8), (0, 4), (100, 7)])
def test_equal_split_closed_form(spark, n, k):
    if n == 0:
        df = spark.createDataFrame([], "x int")
        assert order.equal_split_regions(df, ["x"], k).count() == 0
        return
    df = spark.createDataFrame([(i,) for i in range(n)], "x int")
    got = [r.region for r in order.equal_split_regions(df, ["x"], k).orderBy("x").collect()]
    exp = []
    q, m = divmod(n, k)
    for i in range(k):
        exp += [i] * (q + (1 if i < m else 0))
    assert got == exp


def test_global_rank_equals_row_number(spark):
    random.seed(5)
    rows = [(random.randrange(0, 50), random.randrange(0, 10 ** 6), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    got = {r.c: r.rank for r in order.global_rank(df, ["a", "b", "c"], num_partitions=7).collect()}
    exp = {c: i for i, (_, _, c) in enumerate(sorted(rows))}
    assert got == exp


# --- interval join vs brute force ----------------------------------------------------------------

def test_binned_overlap_join_equals_nested_loop(spark):
    random.seed(11)
    a = [(random.randrange(1, 3), s, s + random.choice([1, 40, 300, 70000]), f"t{i}")
         for i, s in enumerate(random.randrange(0, 300000) for _ in range(200))]
    b = [(random.randrange(1, 3), s, s + random.choice([1, 32, 150, 40000]), f"r{i}")
         for i, s in enumerate(random.randrange(0, 300000) for _ in range(2000))]
    A = spark.createDataFrame(a, "ref_index int, start0 int, end0 int, name string")
    B = spark.createDataFrame(b, "ref_index int, start0 int, end0 int, qname string")
    got = sorted((r.b_name, r.qname) for r in intervals.overlap_join(B, A).collect())
    exp = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert got == exp
    semi = {r.qname for r in intervals.semi_join(B, A).collect()}
    assert semi == {q for _, q in exp}


# --- header --------------------------------------------------------------------------------------

def test_header_cases(spark):
    lines = [(0, "@HD\tVN:1.0\tVN:1.0"), (1, "@SQ\tSN:chr1\tLN:5\tLN:6"), (2, "@SQ\tSN:chr2"),
             (3, "@RG\tID:a\tSM:s\tDS:x:y"), (4, "@ZZ\tID:1")]
    df = spark.createDataFrame(lines, "ord long, value string")
    errs = {(r.ord, r.type) for r in hd.header_errors(df).collect()}
    assert errs == {(1, "HEADER_TAG_MULTIPLY_DEFINED"), (2, "HEADER_RECORD_MISSING_REQUIRED_TAG"),
                    (4, "UNRECOGNIZED_HEADER_TYPE")}
    table = {(r.ord, r.key): r.value for r in hd.header_table(df).collect()}
    assert table[(1, "LN")] == "5" and table[(3, "DS")] == "x:y"


# --- preprocessing pieces ---------------------------------------------------------------------------

def test_clip_cigar_at_contig_end(spark):
    df = spark.createDataFrame([("20M", 90), ("5M10D10M", 90), ("2S10M", 95), ("10M", 120)],
                               "cigar string, pos int")
    got = [r[0] for r in df.select(preprocess.clip_cigar_at("cigar", "pos", F.lit(100))).collect()]
    assert got == ["11M9S", "5M10S", "2S6M4S", "10S"]


def test_md_events(spark):
    df = spark.createDataFrame([("10^T0A17",), ("27T0",)], "md string")
    r = df.select(preprocess.md_events("md").alias("e")).collect()
    assert [(e.kind, e.base, e.off) for e in r[0].e] == [("D", "T", 10), ("X", "A", 11)]
    assert [(e.kind, e.base, e.off) for e in r[1].e] == [("X", "T", 27)]


def test_mark_duplicates_small(spark):
    hi, lo = "I" * 10, "5" * 10
    rows = [("p1", 99, 1, 100, 60, "10M", "A" * 10, hi), ("p1", 147, 1, 300, 60, "10M", "A" * 10, hi),
            ("p2", 99, 1, 100, 60, "10M", "A" * 10, lo), ("p2", 147, 1, 300, 60, "10M", "A" * 10, lo),
            ("f1", 0, 1, 100, 60, "10M", "A" * 10, hi),          # at a pair end -> duplicate
            ("f2", 0, 1, 500, 60, "10M", "A" * 10, lo), ("f3", 0, 1, 500, 60, "10M", "A" * 10, hi)]
    out = {(r.qname, r.flag & 0x400 != 0) for r in preprocess.mark_duplicates(_reads(spark, rows)).collect()}
    assert out == {("p1", False), ("p2", True), ("f1", True), ("f2", True), ("f3", False)}


def test_mark_duplicates_secondary_and_libraries(spark):
    hi, lo = "I" * 10, "5" * 10
    rows = [("a", 0, 1, 100, 60, "10M", "A" * 10, lo), ("a", 256, 1, 900, 60, "10M", "A" * 10, hi),
            ("b", 0, 1, 100, 60, "10M", "A" * 10, hi)]
    out = {(r.qname, r.flag) for r in preprocess.mark_duplicates(_reads(spark, rows)).collect()}
    assert out == {("a", 0x400), ("a", 256), ("b", 0)}
    two = [("n", 0, 1, 100, 60, "10M", "A" * 10, hi), ("n", 0, 1, 500, 60, "10M", "A" * 10, lo)]
    lib = F.when(F.col("pos") == 100, F.lit("L1"))  # the second library is null
    marked = preprocess.mark_duplicates(_reads(spark, two), lib)
    assert sorted((r.pos, r.flag) for r in marked.collect()) == [(100, 0), (500, 0)]
    assert marked.columns == _reads(spark, two).columns


def test_index_stats_counts_every_read(spark):
    contigs = spark.createDataFrame([(0,), (1,)], "ref_index int")
    reads = spark.createDataFrame([(1, 10, 0), (1, 0, 0), (-1, 0, 4), (7, 5, 0), (None, 5, 0), (1, 3, 4), (1, None, 0)], "ref_index int, pos int, flag int")
    got = {r.ref_index: (r.aligned, r.unaligned) for r in stats.index_stats(reads, contigs).collect()}
    assert got == {0: (0, 0), 1: (1, 1), -1: (0, 3), 7: (1, 0), None: (1, 0)}
    assert {r.ref_index for r in stats.index_stats(reads.limit(0), contigs).collect()} == {0, 1, -1}


def test_indel_targets_stay_on_the_contig(spark):
    rows = [("a", 0, 0, 5, 60, "1M1I8M", "A" * 10, "I" * 10), ("b", 0, 0, 95, 60, "2M2D2M", "A" * 4, "I" * 4),
            ("c", 0, 9, 95, 60, "2M2D2M", "A" * 4, "I" * 4)]
    contigs = spark.createDataFrame([(0, 100)], "ref_index int, length int")
    out = preprocess.indel_target_intervals(_reads(spark, rows), contigs=contigs)
    assert sorted(tuple(r) for r in out.select("ref_index", "island_start", "island_end").collect()) == [(0, 1, 25), (0, 77, 100), (9, 77, 118)]


def test_missing_reference_tiles_are_reported(spark):
    from helixdf.operators import reference
    tiles = spark.createDataFrame([(0, 0, "A" * 32)], "ref_index int, tile int, bases string")
    rows = [("a", 0, 0, 30, 60, "8M", "AAAAAAAA", "I" * 8), ("b", 0, 0, 1, 60, "4M", "ACAA", "I" * 4), ("c", 4, -1, 0, 0, "*", "A", "I")]
    out = reference.mismatch_stats(_reads(spark, rows), tiles, ["qname"])
    assert sorted((r.qname, r.mismatches, r.uncovered) for r in out.collect()) == [("a", 0, 5), ("b", 1, 0), ("c", 0, 0)]


def test_list_chunks_keeps_empty_files(spark, tmp_path):
    from helixdf.sources import text
    (tmp_path / "part-2").write_text("a\nb\n")
    (tmp_path / "part-1").write_text("")
    (tmp_path / "other").write_text("x\n")
    got = [(r["name"], r.n_lines) for r in text.list_chunks(spark, str(tmp_path)).collect()]
    assert got == [("part-1", 0), ("part-2", 2)]


def test_fastq_records_keep_their_file(spark, tmp_path):
    from helixdf.sources import text
    for k in "ab":
        (tmp_path / f"{k}.fq").write_text(f"@{k}1\nAC\n+\nII\n")
    out = text.parse_fastq_lines(text.number_lines(spark.read.text(str(tmp_path))), per_file=True)
    assert sorted((r.file[-4:], r.chunk_id, r["name"]) for r in out.collect()) == [("a.fq", 0, "a1"), ("b.fq", 0, "b1")]


def test_bqsr_apply_salted_like_broadcast(spark):
    reads = spark.createDataFrame([(f"q{i}", i % 2 * 16, "ACGTN"[i % 5] * 4, "I5I5", None if i == 3 else "g") for i in range(12)],
                                  "qname string, flag int, seq string, qual string, rg string")
    deltas = spark.createDataFrame([("g", 1.5, [0.5] * 94, [0.25] * 94 * 5, [-3.0] * 94 * 25, 5)],
                                   "rg string, d_rg double, a_q array<double>, a_cycle array<double>, a_ctx array<double>, cycle_width int")
    rows = [sorted(map(tuple, preprocess.bqsr_apply(reads, deltas, delta_bytes=b).select("qname", "qual").collect())) for b in (1 << 20, 0)]
    assert rows[0] == rows[1] and len(rows[0]) == 12


def test_strict_stringency_raises(spark):
    df = spark.createDataFrame([("r", 4 | 256, -1)], "qname string, flag int, mate_ref_index int")
    errs = va.explode_errors(df, va.flag_rules())
    with pytest.raises(Exception):
        strict, _ = va.apply_stringency(df, errs, "STRICT", va.flag_rules())  # nothing runs yet
        strict.select("pos").count()
    kept, rep = va.apply_stringency(df, errs, "LENIENT")
    assert kept.count() == 1 and rep.count() == 1


# --- streaming ------------------------------------------------------------------------------------

def test_streaming_ingest_matches_batch(spark):
    from helixdf import fixtures as fx
    from helixdf.operators import filters
    from helixdf.sources import sam
    from helixdf.streaming import start_ingest, stream_primary_reads
    f = fx.load(spark, "/root/testdata/sf0.001")
    base = tempfile.mkdtemp(prefix="helixdf-stream-", dir="/tmp")
    src = os.path.join(base, "in")
    f.sam_lines.write.text(src)
    batch = filters.keep_primary_contigs(sam.parse_sam_lines(f.sam_lines, f.contigs)).count()
    q = start_ingest(stream_primary_reads(spark, src, f.contigs), os.path.join(base, "out"),
                     os.path.join(base, "ckpt"))
    q.awaitTermination(120)
    assert spark.read.parquet(os.path.join(base, "out")).count() == batch


def test_set_nm_writes_tag(spark):
    from helixdf import fixtures as fx
    from helixdf.functions import tags as tg
    from helixdf.operators import reference
    from helixdf.sources import sam
    f = fx.load(spark, "/root/testdata/sf0.001")
    reads = sam.parse_sam_lines(f.sam_lines, f.contigs).filter(fl.is_mapped("flag"))
    out = reference.set_nm(reads, f.ref_tiles)
    assert out.count() == reads.count()
    assert out.filter(tg.tag_int("tags", "NM").isNull()).count() == 0


def test_tags_last_value_wins_and_excess_colons(spark):
    from helixdf.functions import tags as tg
    df = spark.createDataFrame([(["NM:i:1", "XZ:Z:a:b", "NM:i:2"],), (["RG:Z:g"],), ([],)], "f array<string>")
    rows = df.select(tg.tags_from_fields("f").alias("t")).collect()
    assert {k: (v.type, v.value) for k, v in rows[0].t.items()} == {"NM": ("i", "2"), "XZ": ("Z", "a:b")}
    assert rows[1].t["RG"].value == "g" and rows[2].t == {}


def test_bin_geometry_levels(spark):
    rows = [(0,), (1,), (8,), (9,), (72,), (73,), (584,), (585,), (4680,), (4681,), (37449,)]
    df = spark.createDataFrame(rows, "bin int")
    got = [(r.l, r.f, r.e) for r in df.select(co.bin_level("bin").alias("l"), co.bin_first_locus("bin").alias("f"),
                                               co.bin_last_locus("bin").alias("e")).collect()]
    size = {0: 1 << 29, 1: 1 << 26, 2: 1 << 23, 3: 1 << 20, 4: 1 << 17, 5: 1 << 14}
    first = {0: 0, 1: 1, 2: 9, 3: 73, 4: 585, 5: 4681}
    for (b,), (lvl, f, e) in zip(rows, got):
        assert f == (b - first[lvl]) * size[lvl] + 1 and e == f + size[lvl] - 1
    assert [r[0] for r in spark.createDataFrame([(249250621,)], "n long")
            .select(co.max_bin_for_length("n")).collect()] == [4681 + (249250621 >> 14)]


def test_strict_names_the_bad_record_and_lets_good_ones_pass(spark):
    rules = va.flag_rules()
    df = spark.createDataFrame([("good", 0, -1), ("bad", 2, -1), ("fine", 16, -1)], "qname string, flag int, mate_ref_index int")
    assert va.assert_valid(df.filter("qname <> 'bad'"), rules).count() == 2
    with pytest.raises(Exception, match="INVALID_FLAG_PROPER_PAIR on bad"):
        va.assert_valid(df, rules).select("flag").collect()


def test_soft_clips_lie_inside_hard_clips_only(spark):
    ops = ["5S5M", "5M5S", "5H5S5M5S5H", "5M5S5M", "5S5S5M", "5H5M5S5M", "5M5S5H", "5H5H5S5M"]
    df = spark.createDataFrame([(c, 0, c) for c in ops], "qname string, flag int, cigar string")
    bad = va.explode_errors(df, va.cigar_rules()).filter("message = 'S between other runs'")
    assert sorted(r.qname for r in bad.collect()) == sorted(["5M5S5M", "5S5S5M", "5H5M5S5M", "5H5H5S5M"])


def test_colour_space_reads_may_be_empty(spark):
    df = spark.sql("select * from values ('a', 0, '*', '*', map('CS', 'x')), ('b', 0, '*', '*', map('NM', 'x')), ('c', 0, '*', '*', null) t(qname, flag, seq, qual, tags)")
    assert sorted(r.qname for r in va.explode_errors(df, va.sequence_rules("tags")).collect()) == ["b", "c"]


@pytest.mark.parametrize("lines", [1 << 16, 3, 1])
def test_sort_order_across_ranges_and_gaps(spark, lines):
    from helixdf.operators import order
    keys = [5, 6, 6, 2, 9, 1, 1, 4, 3]
    rows = [(10 * i, k, f"q{i}") for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "line_no long, k int, qname string").repartition(3)
    got = sorted((r.line_no, r.prev_qname) for r in order.check_sort_order(df, ["k"], lines=lines).collect())
    assert got == [(10 * i, f"q{i - 1}") for i in range(1, len(keys)) if keys[i] < keys[i - 1]]
    assert order.check_sort_order(df.limit(0), ["k"], lines=lines).count() == 0


def test_clipped_cigars_and_reasons(spark):
    df = spark.sql("select * from values (-3, 10, 50, 6, 2), (45, 10, 50, 3, -2), (60, 10, 50, 2, 1), (-20, 10, 50, 2, 1), (1, 10, 50, 10, 1), (-8, 12, 50, 4, -1) t(s, n, len, at, by)")
    out = df.select(records.clipped_cigar("s", "n", "len"), records.clip_reason("s", "n", "len"),
                    records.clipped_indel_cigar("s", "n", "len", "at", "by"), records.clip_reason("s", "n", "len", "at", "by")).collect()
    assert [tuple(r) for r in out] == [
        ("4S6M", None, "4S2M2I2M", None), ("6M4S", None, "3M2D1M6S", None), (None, "off_contig", None, "off_contig"),
        (None, "off_contig", None, "off_contig"), ("10M", None, None, "no_base_after_indel"), ("9S3M", None, None, "no_base_before_indel")]
