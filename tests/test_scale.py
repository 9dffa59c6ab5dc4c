"""Steps rewritten to scale, against their plainer forms."""

import random

from pyspark.sql import functions as F

from helixdf.functions import bases, tags
from helixdf.operators import preprocess, validate
from helixdf.sources import region_store, text


def test_qualities_of_odd_reads(spark):
    rng = random.Random(4)
    cells = "".join(chr(33 + q) for q in range(94))
    rows = []
    for i in range(300):
        n = rng.choice((1, 2, 30, 60))
        seq = "".join(rng.choice("ACGTNacgtn.") for _ in range(n))
        qual = "".join(rng.choice(cells) for _ in range(n))
        rows.append((f"q{i}", rng.choice((0, 16, None)), rng.choice(("a", "b", "unknown", None)), seq, qual))
    rows += [("star", 0, "a", "*", "*"), ("null", 16, "a", "AC", None), ("none", 16, "a", "", ""), ("low", 0, "a", "ACG", "I I"),
             ("odd", 0, "b", "ACG", "I\u00e9I"), ("wide", 16, "a", "A\u00e9G", "III")]
    schema = "qname string, flag int, rg string, seq string, qual string"
    reads = spark.createDataFrame(rows, schema)
    table = spark.createDataFrame([(g, q, c, rng.choice(("AC", "CA", "GT", "NA", None)), 50 + q, rng.randrange(0, 40))
                                   for g in "ab" for q in range(0, 94, 3) for c in range(1, 50)],
                                  "rg string, q int, cycle int, context string, observations long, mismatches long")
    deltas = preprocess.recalibration_deltas(table)
    out = [sorted(map(tuple, preprocess.bqsr_apply(reads, deltas, delta_bytes=b).select("qname", "qual").collect())) for b in (1 << 24, 0)]
    assert out[0] == out[1]
    new = dict(out[0])
    assert new["star"] == "" and new["null"] is new["low"] is new["odd"] is None and new["none"] == ""
    # a base without a letter has no cycle and no context
    short = spark.createDataFrame([("s", 0, "a", "AC", "IIII"), ("s", 16, "a", None, "III")], schema)
    found = [r.qual for r in preprocess.bqsr_apply(short, deltas).collect()]
    assert [len(q) for q in found] == [4, 3] and found[0][2] == found[0][3] == found[1][0]
    assert "lambdafunction" not in preprocess.bqsr_apply(reads, deltas).filter(F.lit(True))._jdf.queryExecution().optimizedPlan().toString()


def test_a_region_store_of_large_contigs_has_few_folders(spark, tmp_path):
    rng = random.Random(6)
    spots = [(f"q{i}", 0, rng.randint(0, 20), rng.randint(1, 1_500_000_000), rng.choice(("100M", "50M3000000N50M"))) for i in range(6000)]
    spots += spots[:500]
    reads = spark.createDataFrame(spots, "qname string, flag int, ref_index int, pos int, cigar string").withColumn("tags", F.create_map(F.lit("a"), "qname"))
    path = f"{tmp_path}/store"
    region_store.write_region_store(reads, path)
    folders = spark.read.parquet(path).select(*region_store.PARTITIONS).distinct().count()
    assert folders <= 2 * region_store.FOLDERS
    regions = [(r, s, s + n) for r in range(-1, 22) for s, n in ((rng.randint(0, 1_400_000_000), rng.choice((0, 1, 200_000, 90_000_000))) for _ in range(30))]
    df = spark.createDataFrame(regions, "ref_index int, start0 int, end0 int")
    end = {"100M": 99, "50M3000000N50M": 3_000_099}
    want = sorted(q for q, _, r, p, c in spots if any(r == x[0] and x[1] < x[2] and p - 1 < x[2] and x[1] < p + end[c] for x in regions))
    out = region_store.read_regions(spark, path, df)
    assert sorted(r.qname for r in out.collect()) == want and want
    assert out.columns == ["qname", "flag", "ref_index", "pos", "cigar", "tags"]
    assert region_store.region_tiles(df.unionAll(df), (24, 32)).count() < 3 * 21 * 120


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_line_is_worked_out_once(spark):
    lines = spark.createDataFrame([("@HD\tVN:1",), ("r\t0\tchr1\t1\t0\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:x\tXX\tNM:i:1",), (None,)], "value string")
    made = lines.withColumn("value", F.when(F.md5("value") != "x", F.col("value")))
    contigs = spark.createDataFrame([("chr1",)], "ref_name string")
    report = validate.line_report(made, contigs)
    assert _plan(report).count("md5(") == 1
    found = {(r.type, r.message) for r in report.collect()}
    assert found == {("INVALID_TAG", "NM:i:x: i needs a signed 32-bit integer"), ("INVALID_TAG", "XX: a tag has three parts")}


def test_tag_maps_without_repeats_need_no_fold(spark):
    df = spark.createDataFrame([(["NM:i:1", "XZ:Z:a:b", "XA"],), (["NM:i:1", "XZ:Z:a", "NM:i:2"],), ([],), (None,)], "f array<string>")
    made = df.select(tags.tags_from_fields("f").alias("t"))
    found = [r.e and [tuple(x) for x in r.e] for r in made.select(F.transform(F.map_entries("t"), lambda e: F.struct(e["key"], e["value"]["type"], e["value"]["value"])).alias("e")).collect()]
    assert found[0] == [("NM", "i", "1"), ("XZ", "Z", "a:b"), ("XA", None, None)] and found[1] == [("XZ", "Z", "a"), ("NM", "i", "2")]
    assert not found[2] and found[3] is None
    assert "map_from_entries" in _plan(df.select(tags.tags_from_fields("f")))


def test_encoding_works_its_argument_out_once(spark):
    df = spark.createDataFrame([([0, 40, 93],), ([94],), ([-1, None],), ([1, None],), ([],), (None,)], "q array<int>")
    out = df.select(bases.phred_encode(F.reverse("q")).alias("t"))
    assert [r.t for r in out.collect()] == ["~I!", None, None, None, "", None]
    assert _plan(out).count("reverse(") == 1


def test_fastq_mates_come_from_one_sort(spark):
    from helixdf.plans import io
    p1, p2 = io._write_fastq(spark, "/root/testdata/sf0.001")
    assert p1.rsplit("/", 1)[0] == p2.rsplit("/", 1)[0]
    records = [sorted(map(tuple, text.read_fastq(spark, p).select("chunk_id", "name", "seq", "qual").collect())) for p in (p1, p2)]
    assert [r[1] for r in records[0]] == sorted(r[1] for r in records[0]) == [r[1] for r in records[1]]
    back = str.maketrans("ACGT", "TGCA")
    assert [(s.translate(back)[::-1], q[::-1]) for *_, s, q in records[0]] == [(s, q) for *_, s, q in records[1]]


def test_only_duplicates_are_joined_back(spark):
    rows = [("a", 0, 1, 100, "4M", "IIII"), ("b", 0, 1, 100, "4M", "5555"), ("c", 1024, 1, 200, "4M", "IIII"), ("d", 4, -1, 0, "*", "IIII")]
    out = preprocess.mark_duplicates(spark.createDataFrame(rows, "qname string, flag int, ref_index int, pos int, cigar string, qual string"))
    assert sorted((r.qname, r.flag) for r in out.collect()) == [("a", 0), ("b", 1024), ("c", 0), ("d", 4)]


def test_ends_and_scores_are_worked_out_once(spark):
    cols = "qname string, flag int, ref_index int, pos int, cigar string, qual string"
    rng = random.Random(8)
    rows = [(f"n{i}", rng.choice((0, 16)), rng.choice((0, 3, None)), rng.choice((1, 900, -5)), rng.choice(("4M", "2H3S4M1D2M5S1H", "*", None, "3S", "7Q2M", "")),
             rng.choice(("IIII", "!+5~", "Ié?", "*", "", None))) for i in range(300)]
    df = spark.createDataFrame(rows, cols)
    plain = df.select("qname", preprocess.end_key("ref_index", preprocess.five_prime(), F.col("flag") == 16).alias("end"), preprocess.read_score("qual").alias("score"))
    assert sorted(map(str, preprocess.read_ends(df, []).collect())) == sorted(map(str, plain.collect()))
    # the scan stands in the plan for the flags only, not for each of the five uses of the names
    plan = _plan(preprocess.mark_duplicates(df.withColumn("flag", F.when(F.md5("qname") != "x", F.col("flag")))))
    assert plan.count("md5(") == 1 and "lambdafunction" not in plan


def test_marks_by_library_and_taken_fragments(spark):
    cols = "qname string, lib string, flag int, ref_index int, pos int, cigar string, qual string"
    rows = [("p", "a", 99, 1, 100, "4M", "IIII"), ("p", "a", 147, 1, 300, "4M", "IIII"), ("q", "a", 99, 1, 100, "4M", "III5"), ("q", "a", 147, 1, 300, "4M", "IIII"),
            ("f", "a", 0, 1, 100, "4M", "~~~~"), ("g", "a", 0, 1, 100, "4M", "IIII"), ("f", "b", 0, 1, 100, "4M", "~~~~"), ("h", None, 0, 1, 100, "4M", "IIII")]
    df = spark.createDataFrame(rows, cols)
    marked = preprocess.mark_duplicates(df, F.col("lib"))
    assert sorted((r.qname, r.lib or "", r.flag >= 1024) for r in marked.collect()) == sorted(
        [("p", "a", False)] * 2 + [("q", "a", True)] * 2 + [("f", "a", True), ("g", "a", True), ("f", "b", False), ("h", "", False)])
    found = {r.library: (r.unpaired_examined, r.pairs_examined, r.unpaired_duplicates, r.pair_duplicates) for r in preprocess.duplicate_metrics(marked, F.col("lib")).collect()}
    assert found == {"a": (2, 2, 2, 1), "b": (1, 0, 0, 0), "": (1, 0, 0, 0)}
