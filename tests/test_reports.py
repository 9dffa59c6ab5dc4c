"""Line, tag and mate reports, FASTQ without moving lines, and range merging, on small literal cases."""

import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helixdf.functions import bases as bs
from helixdf.functions import tags as tg
from helixdf.operators import islands, lookups
from helixdf.operators import validate as va
from helixdf.sources import sam, text

CONTIGS = [(0, "chr1", 1000), (1, "chr2", 500)]


def _contigs(spark, rows=CONTIGS):
    return spark.createDataFrame(rows, "ref_index int, ref_name string, length long")


def _line(flag="0", rname="chr1", pos="5", mapq="9", cigar="4M", rnext="*", pnext="0", tlen="0", seq="ACGT", qual="IIII", *tags):
    return "\t".join(["r", flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, *tags])


LINES = [
    (_line(), []),
    (_line(flag="x"), ["column FLAG holds no number"]),
    (_line(pos="1.5"), ["column POS holds no number"]),
    (_line(pos=" 5"), ["column POS holds no number"]),
    (_line(pos="+5"), []),
    (_line(mapq="99999999999"), ["column MAPQ holds no number"]),
    (_line(pnext="?"), ["column PNEXT holds no number"]),
    (_line(tlen="1e2"), ["column TLEN holds no number"]),
    (_line(rname="chr9"), ["RNAME is not in the dictionary"]),
    (_line(rname="chr1 alt"), []),
    (_line(rname="="), ["RNAME cannot be =", "RNAME is not in the dictionary"]),
    (_line(flag="1", rnext="chr9", pnext="7"), ["RNEXT is not in the dictionary"]),
    (_line(flag="1", rnext="=", pnext="7"), []),
    ("r\t0\tchr1", ["the 11 fixed columns are not complete"]),
    ("", ["the 11 fixed columns are not complete", "a column is empty"]),
    ("@CO\tx", []),
    (None, []),
]


def test_line_report(spark):
    lines = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(LINES)], "line_no int, value string")
    found = va.line_report(lines, _contigs(spark), keep=["line_no"]).collect()
    for i, (value, want) in enumerate(LINES):
        assert sorted(r["message"] for r in found if r["line_no"] == i) == sorted(want), value


def test_line_report_without_dictionary(spark):
    lines = spark.createDataFrame([(_line(rname="chr9"),)], "value string")
    assert va.line_report(lines, _contigs(spark, [])).count() == 0
    assert va.line_report(lines.limit(0), _contigs(spark)).count() == 0


TAGS = [
    ("NM:i:4", None), ("NM:i:-2147483648", None), ("NM:i:2147483648", "i needs"), ("NM:i: 4", "i needs"), ("NM:i", "three parts"), ("", "three parts"),
    ("XA:A:x", None), ("XA:A:", "A needs"), ("XA:A:xy", "A needs"), ("XF:f:1.5", None), ("XF:f:.5e-3", None), ("XF:f:NaN", None), ("XF:f:1.", None),
    ("XF:f:e5", "f needs"), ("XF:f:", "f needs"), ("XH:H:", None), ("XH:H:0aFF", None), ("XH:H:0", "H needs"), ("XH:H:0g", "H needs"),
    ("XB:B:c,-128,127", None), ("XB:B:c,128", "out of range"), ("XB:B:C,255", None), ("XB:B:C,-1", "out of range"), ("XB:B:S,65536", "out of range"),
    ("XB:B:I,4294967295", None), ("XB:B:i,4294967295", "out of range"), ("XB:B:f,1,2.5", None), ("XB:B:f,1,x", "floats"), ("XB:B:c", "comma"),
    ("XB:B:c,", "out of range"), ("XB:B:c,1,,", None), ("XB:B:c,1,,2", "out of range"), ("XB:B:cc,1", "comma"), ("XB:B:x,1", "element type"),
    ("XZ:Z:", None), ("XZ:Z:a:b", None), ("XX:x:1", "unrecognized"),
]


def test_tag_grammar(spark):
    lines = spark.createDataFrame([(i, _line("0", "chr1", "5", "9", "4M", "*", "0", "0", "ACGT", "IIII", t)) for i, (t, _) in enumerate(TAGS)], "i int, value string")
    found = {r["i"]: r["message"] for r in va.line_report(lines, _contigs(spark), keep=["i"]).filter("type = 'INVALID_TAG'").collect()}
    for i, (tag, want) in enumerate(TAGS):
        assert (want is None) == (i not in found) and (want is None or want in found[i]), (tag, found.get(i))


def test_arrays_of_tags(spark):
    df = spark.createDataFrame([(["F1:B:f,1,2.5", "I1:B:S,7,65535", "I2:B:c,200"],)], "t array<string>").select(tg.tags_from_fields("t").alias("tags"))
    row = df.select(tg.tag_float_array("tags", "F1").alias("f"), tg.tag_int_array("tags", "I1").alias("i"), tg.tag_int_array("tags", "I2").alias("bad"),
                    tg.tag_float_array("tags", "I1").alias("none")).first()
    assert (row["f"], row["i"], row["bad"], row["none"]) == ([1.0, 2.5], [7, 65535], None, None)


def test_integer_tags_are_written_as_i(spark):
    tags = tg.tags_from_fields(F.array(*[F.lit(t) for t in ("A1:c:-5", "A2:S:65535", "A3:I:2147483647", "A4:Z:x")]))
    row = spark.range(1).select(tg.tags_to_text(tags).alias("v")).first()
    assert row["v"] == "A1:i:-5\tA2:i:65535\tA3:i:2147483647\tA4:Z:x"
    with pytest.raises(PySparkException, match="A3 does not fit"):
        spark.range(1).select(tg.tags_to_text(tg.tags_from_fields(F.array(F.lit("A3:I:2147483648"))))).collect()


def test_sam_text_and_its_report(spark, tmp_path):
    for name, lines in (("a.sam", ["@HD\tVN:1.0", _line(), _line(pos="x")]), ("b.sam", [_line(rname="chr9"), _line()])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    reads, errors = sam.read_sam_checked(spark, str(tmp_path), _contigs(spark))
    assert reads.count() == 4
    got = {(os.path.basename(r["file"]), r["line_no"], r["message"]) for r in errors.collect()}
    assert got == {("a.sam", 2, "column POS holds no number"), ("b.sam", 0, "RNAME is not in the dictionary")}


MATES = [
    # name, flag, ref, pos, mate ref, mate pos, outcome, mate flag
    ("ok", 99, 0, 10, 0, 50, "MATE", 147), ("ok", 147, 0, 50, 0, 10, "MATE", 99),
    ("gone", 99, 0, 10, 0, 50, "NO_MATE", None),
    ("moved", 99, 0, 10, 0, 51, "NO_MATE", None), ("moved", 147, 0, 50, 0, 10, "MATE", 99),
    ("two", 99, 0, 10, 0, 50, "SEVERAL_MATES", None), ("two", 147, 0, 50, 0, 10, "MATE", 99), ("two", 403, 0, 50, 0, 10, "MATE", 99),
    ("mixed", 99, 0, 10, 0, 50, "PAIRED_AND_UNPAIRED", None), ("mixed", 16, 0, 50, -1, 0, "UNPAIRED", None),
    ("both", 193, 0, 10, 0, 50, "END_UNCLEAR", None), ("neither", 1, 0, 10, 0, 50, "END_UNCLEAR", None),
    ("loose", 77, -1, 0, -1, 0, "MATE", 141), ("loose", 141, -1, 0, -1, 0, "MATE", 77),
    ("same", 99, 0, 10, 0, 10, "MATE", 147), ("same", 147, 0, 10, 0, 10, "MATE", 99),
    (None, 99, 0, 10, 0, 50, "NO_MATE", None), ("null", None, None, None, None, None, None, None),
]


def test_mate_report(spark):
    schema = "qname string, flag int, ref_index int, pos int, mate_ref_index int, mate_pos int"
    df = spark.createDataFrame([m[:6] for m in MATES], schema)
    got = sorted((tuple(r) for r in lookups.mate_report(df).collect() if r["flag"] is not None), key=repr)
    assert got == sorted((m[:6] + (m[7], m[6]) for m in MATES if m[1] is not None), key=repr)
    assert lookups.mate_report(df.limit(0)).count() == 0
    assert lookups.mate_report(df).count() == len(MATES)


def test_qualities_that_cannot_be_shifted(spark):
    df = spark.createDataFrame([("a", "hh"), ("b", "h?"), ("c", "*"), ("d", None), ("e", "")], "qname string, qual string")
    assert [tuple(r) for r in bs.quality_errors(df).collect()] == [("b", 2, -1)]


def _fastq(n, rnd):
    return [(f"@x{i}" if rnd.random() < 0.3 else f"x{i}", "A" * rnd.randint(1, 60), "@" * rnd.randint(1, 60)) for i in range(n)]


@pytest.mark.parametrize("split", [17, 64, 1000, 1 << 20])
def test_fastq_over_many_splits(spark, tmp_path, split):
    rnd = random.Random(split)
    files = [_fastq(n, rnd) for n in (7, 0, 1, 30)]
    for i, records in enumerate(files):
        (tmp_path / f"p{i}.fq").write_text("".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in records))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = text.read_fastq(spark, str(tmp_path)).orderBy("chunk_id").collect()
        want = [r for f in files for r in f]
        assert [(r["chunk_id"], r["name"], r["seq"], r["qual"]) for r in got] == [(i, *r) for i, r in enumerate(want)]
        got = text.read_fastq(spark, str(tmp_path), mate=2, per_file=True).orderBy("file", "chunk_id").collect()
        assert [(r["chunk_id"], r["name"], r["mate"]) for r in got] == [(i, r[0], 2) for f in files for i, r in enumerate(f)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_fastq_plan_moves_no_whole_records(spark, tmp_path):
    (tmp_path / "a.fq").write_text("@a\nA\n+\nI\n" * 50)
    plan = text.read_fastq(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # the one exchange by key is that of the lines at split borders
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("BroadcastHashJoin") == 2 and "MapInArrow" in plan
    assert "chunk_id" in plan[plan.index("Exchange hashpartitioning"):].split("\n")[0]


def _merged(rows, overlap):
    out, by = [], {}
    for name, s, e in rows:
        by.setdefault(name.lower(), []).append((s - overlap, e, name))
    for ranges in by.values():
        reach, here = None, []
        for s, e, name in sorted(ranges):
            if reach is None or s >= reach:
                here.append([name, s, e])
            else:
                here[-1][2] = max(here[-1][2], e)
            reach = e if reach is None else max(reach, e)
        out += [(n, max(s, 1), e) for n, s, e in here]
    return sorted(out)


@pytest.mark.parametrize("overlap", [0, 1, 150])
@pytest.mark.parametrize("span", [40, 60_000, 80_000_000])
def test_merge_ranges(spark, overlap, span):
    rnd = random.Random(span + overlap)
    rows = []
    for _ in range(400):
        s = rnd.randint(1, span)
        rows.append((rnd.choice(["chr1", "chr2"]), s, s + rnd.choice([0, 0, 1, 30, span // 50])))
    rows += rows[:40]
    rows.append(("chr3", 1, 20_000_000))
    df = spark.createDataFrame(rows, "ref_name string, start int, end int")
    got = sorted(tuple(r) for r in islands.merge_ranges(df, overlap).select("name", "start", "end").collect())
    assert got == _merged(rows, overlap)


def test_merge_ranges_names_nulls_and_empty(spark):
    df = spark.createDataFrame([("Chr1", 5, 9), ("chr1", 7, 12), (None, 1, 2), ("chr1", None, 3)], "ref_name string, start int, end int")
    assert [tuple(r) for r in islands.merge_ranges(df, 0).select("name", "start", "end").collect()] == [("Chr1", 5, 12)]
    assert islands.merge_ranges(df.limit(0), 10).count() == 0


def test_merging_reads_its_ranges_once(spark):
    df = spark.createDataFrame([("chr1", 5, 9, 1), ("chr1", 40_000, 40_001, 1)], "ref_name string, start int, end int, n int")
    made = df.withColumn("ref_name", F.when(F.md5("ref_name") != "x", F.col("ref_name")))
    out = islands.merge_ranges(made, 0)
    assert "md5(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r) for r in out.collect()) == [("chr1", 5, 9), ("chr1", 40_000, 40_001)]


def test_an_island_over_many_buckets(spark):
    # a range over three buckets takes in what starts under it and nothing behind it
    df = spark.createDataFrame([(1, 10, 50_000), (1, 20_000, 20_100), (1, 40_000, 70_000), (1, 69_000, 69_010), (1, 70_052, 70_060), (2, 5, 6)],
                               "ref_index int, start int, end int")
    assert sorted(map(tuple, islands.islands(df).collect())) == [(1, 10, 70_000, 4), (1, 70_052, 70_060, 1), (2, 5, 6, 1)]
    plan = islands.islands(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
