"""Joins of nested bins, the region store and tile pile-ups against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixdf.operators import intervals, pileup
from helixdf.sources import region_store


def table(spark, rows):
    return spark.createDataFrame(rows, "ref_index int, start0 int, end0 int, name string")


def drawn(rng, n, most):
    out = []
    for i in range(n):
        start = rng.randrange(0, 200_000_000)
        if i % 3 == 0:
            start = (start >> 20) << 20  # on borders of bins
        out.append((rng.randint(1, 2), start, start + rng.choice((0, 1, 50, 16_384, 16_385, 200_000, most)), f"n{i % 50}"))
    return out


@pytest.mark.parametrize("most", [300, 70_000_000])
def test_all_kinds_of_joins(spark, most):
    rng = random.Random(most)
    a, b = drawn(rng, 150, most) * 2 + [(1, None, 5, "x"), (None, 0, 9, "y")], drawn(rng, 120, most) + [(1, 0, 200_000_000, "all"), (2, 5, 5, "e")]
    hits = lambda x, y: x[0] is not None and x[0] == y[0] and None not in x[:3] and x[1] < y[2] and y[1] < x[2]
    A, B = table(spark, a), table(spark, b)
    pairs = Counter((x[:3] + (x[3],), y[3]) for x in a for y in b if hits(x, y))
    got = Counter(((r.ref_index, r.start0, r.end0, r.name), r.b_name) for r in intervals.overlap_join(A, B).collect())
    assert got == pairs
    semi = Counter(x for x in a if any(hits(x, y) for y in b))
    assert Counter(map(tuple, intervals.semi_join(A, B).collect())) == semi
    assert Counter(map(tuple, intervals.anti_join(A, B).collect())) == Counter(a) - semi
    left = Counter((r.ref_index, r.start0, r.end0, r.name) for r in intervals.overlap_join(A, B, "left").collect())
    assert left == Counter(x[0] for x in pairs.elements()) + (Counter(a) - semi)


def test_a_long_interval_stays_a_few_rows(spark):
    long_ = table(spark, [(1, 1_000, 200_000_000, "long")])
    short = table(spark, [(1, i * 190_000, i * 190_000 + 100, f"t{i}") for i in range(1000)])
    for one, other in ((long_, short), (short, long_)):
        sizes = intervals._sizes(other, "start0", "end0")
        sized = intervals._sized(one, "start0", "end0", sizes, True)
        placed = intervals._placed(sized, "start0", ("who", "size", "bin"), True)
        assert placed.groupBy("name").count().agg(F.max("count")).first()[0] <= 4
    assert intervals.overlap_join(short, long_).count() == 999
    assert intervals.overlap_join(short, long_.limit(0)).count() == 0
    assert intervals.anti_join(short.limit(0), long_).count() == 0


def stored_reads(spark, path, n=4000):
    rng = random.Random(2)
    rows = [(f"q{i}", 0 if i % 50 else 4, rng.randint(-1, 3), rng.randint(1, 30_000_000), rng.choice(("100M", "50M2000000N50M", "10M5D90M"))) for i in range(n)]
    df = spark.createDataFrame(rows, "qname string, flag int, ref_index int, pos int, cigar string")
    region_store.write_region_store(df, path)
    return rows


def test_region_store_reads_few_files(spark, tmp_path):
    path = f"{tmp_path}/store"
    rows = stored_reads(spark, path)
    rng = random.Random(3)
    regions = [(rng.randint(0, 3), s, s + 100_000, f"r{i}") for i, s in enumerate(rng.sample(range(0, 29_000_000, 1000), 10))]
    span = {"100M": 100, "50M2000000N50M": 2_000_100, "10M5D90M": 105}
    inside = lambda r: any(x[0] == r[2] and r[3] - 1 < x[2] and x[1] < r[3] - 1 + (1 if r[1] & 4 else span[r[4]]) for x in regions)
    out = region_store.read_regions(spark, path, table(spark, regions).filter("end0 > 0"))
    assert sorted(map(tuple, out.collect())) == sorted(r for r in rows if r[2] >= 0 and inside(r))
    plan = out._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
    read = out.select(F.input_file_name()).distinct().count() if out.count() else 0
    assert 0 < read <= 80 < len(spark.read.parquet(path).inputFiles())
    assert out.columns == ["qname", "flag", "ref_index", "pos", "cigar"]


def plain_depth(rows):
    import re
    out = {}
    for flag, ref, pos, cigar, seq in rows:
        if flag & 4:
            continue
        r, g = 0, pos
        for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
            n = int(n)
            if op in "M=X":
                for k, base in enumerate(seq[r:r + n]):
                    c = out.setdefault((ref, g + k), [0] * 5)
                    c["ACGT".find(base.upper())] += 1
            r += n if op in "M=XIS" else 0
            g += n if op in "M=XDN" else 0
    return sorted((*k, sum(c), *c) for k, c in out.items())


@pytest.mark.parametrize("cells", [1 << 21, 500])
def test_depth_of_150_base_reads(spark, monkeypatch, cells):
    monkeypatch.setattr(pileup, "CELLS", cells)
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        pos = 1000 if i % 3 == 0 else rng.randint(1, 4000)  # a third of the reads at one place
        cigar = rng.choice(("150M", "10S140M", "70M3I77M", "60M500N90M", "100M2D50M", "50M"))
        rows.append((0 if i % 40 else 4, rng.randint(0, 2), pos, cigar, "".join(rng.choice("ACGTNacgt") for _ in range(150 if i % 70 else 90))))
    df = spark.createDataFrame(rows, "flag int, ref_index int, pos int, cigar string, seq string").repartition(4)
    assert sorted(map(tuple, pileup.locus_depth(df).collect())) == plain_depth(rows)
    assert pileup.locus_depth(df.limit(0)).count() == 0


def test_depth_reads_cigars_in_batches_and_packs_its_vectors(spark):
    df = spark.createDataFrame([(0, 0, 4090, "10M0M2I5M", "ACGTACGTACGTTTTAAéC"), (0, 0, 4090, "*", "A"), (0, 0, 4090, None, "A"), (0, 0, 9, "3M", None)],
                               "flag int, ref_index int, pos int, cigar string, seq string")
    out = pileup.locus_depth(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and "binary" in pileup._VECTOR  # CIGARs are not folded row by row; 4 bytes a cell
    assert sorted((r.pos, r.depth, r.n_n) for r in out.collect()) == [(p, 1, 0) for p in range(4090, 4105)]
    deep, n = pileup._packed(np.array([5, 9]), np.array([200_000, 3]))
    assert n.tolist() == [4, 1] and (deep & 0xFFFF).sum() == 200_003 and (deep >> 16).tolist() == [5, 5, 5, 5, 9]
    vector = pileup._vectors(np.array([(1 << 39) | 8, (1 << 39) | 10]), np.array([200_000, 70_000]))
    rows = [r for b in pileup._merged(iter([vector, vector])) for r in b.to_pylist()]
    assert [(r["ref_index"], r["pos"], r["depth"], r["n_a"], r["n_g"]) for r in rows] == [(0, 1, 540_000, 400_000, 140_000)]
