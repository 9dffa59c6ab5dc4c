"""Mismatches and covariates against a plain walk over the bases."""

import random
import re
from collections import Counter

from helixdf.operators import covariates, reference

SCHEMA = "qname string, flag int, ref_index int, pos int, cigar string, seq string, qual string, rg string"


def _case(n=120):
    """Reads of many shapes over a reference of 40 tiles, of which some are missing and one is short."""
    rng = random.Random(5)
    text = "".join(rng.choice("ACGTacgtN") for _ in range(1280))
    tiles = {t: text[32 * t:32 * t + 32] for t in range(40) if t not in (3, 15, 16, 31)}
    tiles[20] = tiles[20][:10]
    reads = []
    for k in range(n):
        cigar = rng.choice(["150M", "20S60M5I50M", "40M3D60M2I10M4S", "30M600N30M", "1M", "12M", "5H7M1P8M", "700M"])
        size = sum(int(c) for c, op in re.findall(r"(\d+)([A-Z=])", cigar) if op in "MIS=X")
        pos = rng.randrange(1, 1200)
        seq = "".join(rng.choice("ACGTNacg") for _ in range(size))
        qual = "".join(chr(33 + rng.randrange(0, 94)) for _ in range(size))
        if k % 11 == 0:
            qual = "*"
        if k % 13 == 0:
            seq = seq[:size // 2 + 1]
        reads.append((f"r{k // 2}", rng.choice([0, 16]), 0, pos, cigar, seq, qual, rng.choice(["a", "b", None])))
    reads += [("null", 0, 0, 5, "9M", None, None, "a"), ("none", 4, -1, 0, "*", "*", "*", "a"), ("none", 4, -1, 0, None, "", "", "b")]
    known = sorted(rng.sample(range(1, 1281), 200))
    return reads, tiles, known


def _walk(read):
    """(read offset, reference position) of aligned bases, both from 1."""
    at, ref = 1, read[3]
    for size, op in re.findall(r"(\d+)([A-Z=])", read[4] or ""):
        size = int(size)
        if op in "M=X":
            yield from ((at + i, ref + i) for i in range(size))
        at += size if op in "MIS=X" else 0
        ref += size if op in "MDN=X" else 0


def _ref(tiles, p):
    return tiles.get((p - 1) // 32, "")[(p - 1) % 32:(p - 1) % 32 + 1].upper()


def _tables(spark):
    reads, tiles, known = _case()
    rows = [(0, t, s) for t, s in tiles.items()]
    # repeated tiles and sites count once
    return (reads, tiles, known, spark.createDataFrame(reads, SCHEMA), spark.createDataFrame(rows + rows[:5], "ref_index int, tile int, bases string"),
            spark.createDataFrame([(0, p) for p in known + known[:9]], "ref_index int, pos int"))


def test_mismatches_equal_a_plain_walk(spark):
    reads, tiles, _, df, ref, _ = _tables(spark)
    want = Counter()
    for r in reads:
        n = nb = gaps = quality = 0
        for o, p in _walk(r):
            g = _ref(tiles, p)
            if not g:
                gaps += 1
                continue
            a = g if r[5] is None else r[5][o - 1:o].upper()
            if a != g:
                n += 1
                nb += (g, a) != (("G", "A") if r[1] & 16 else ("C", "T"))
                quality += max(ord((r[6] or "")[o - 1:o] or "!") - 33, 0)
        want[r[0], n, nb, gaps, quality] += 1
    out = reference.mismatch_stats(df, ref, ["qname"], with_quals=True)
    got = Counter((r.qname, r.mismatches, r.mismatches_bisulfite, r.uncovered, r.mismatch_qual_sum) for r in out.collect())
    assert got == want


def test_covariates_equal_a_plain_walk(spark):
    reads, tiles, known, df, ref, sites = _tables(spark)
    other = str.maketrans("ACGT", "TGCA")
    seen, wrong, aligned, gaps = Counter(), Counter(), Counter(), Counter()
    for r in reads:
        seq, qual = (r[5] or "").upper(), "" if r[6] == "*" and len(r[5]) != 1 else r[6] or ""
        for o, p in _walk(r):
            g = _ref(tiles, p)
            aligned[r[7]] += 1
            gaps[r[7]] += not g
            if not g or p in known or o > len(seq) or o > len(qual) or seq[o - 1] == "N":
                continue
            if r[1] & 16:
                cycle, context = len(seq) - o + 1, seq[o - 1:o + 1].translate(other)[::-1] if o < len(seq) else None
            else:
                cycle, context = o, seq[o - 2:o] if o >= 2 else None
            key = (r[7], ord(qual[o - 1]) - 33, cycle, context)
            seen[key] += 1
            wrong[key] += seq[o - 1] != g
    out = covariates.count_covariates(df, ref, sites).collect()
    assert {(r.rg, r.q, r.cycle, r.context): (r.observations, r.mismatches) for r in out} == {k: (seen[k], wrong[k]) for k in seen}
    assert len(out) == len(seen)
    found = {r.rg: (r.aligned, r.uncovered) for r in covariates.uncovered_bases(df, ref).collect()}
    assert found == {k: (aligned[k], gaps[k]) for k in aligned}


def test_keys_that_do_not_fit_are_counted_in_halves(spark):
    import pyarrow as pa
    long = 1 << 30
    n = 1 << 11
    batch = pa.record_batch({"rg": [str(k) for k in range(n)], "read_cut": ["CAG"] * n, "qual_cut": ["I"] * n, "ref_cut": ["C"] * n, "neg": [True] * n,
                             "n": pa.array([long] * n, pa.int32()), "seg_read": pa.array([1] * n, pa.int32()), "seg_ref": pa.array([1] * n, pa.int32()),
                             "known": pa.array([None] * n, pa.list_(pa.int32()))})
    rows = [r for part in covariates._counted(batch) for r in part.to_pylist()]
    assert len(rows) == n and {(r["q"], r["cycle"], r["context"], r["observations"], r["mismatches"]) for r in rows} == {(40, long, "CT", 1, 1)}


def test_empty_tables(spark):
    _, _, _, df, ref, sites = _tables(spark)
    assert reference.mismatch_stats(df.limit(0), ref, ["qname"]).count() == 0
    assert {r.mismatches for r in reference.mismatch_stats(df, ref.limit(0), ["qname"]).collect()} == {0}
    assert covariates.count_covariates(df, ref.limit(0), sites).count() == 0
    assert covariates.count_covariates(df, ref, sites.limit(0)).count() > 0


def test_tiles_built_from_bits_are_the_tiles_of_the_sql(spark):
    from helixdf import fixtures as fx
    f = fx.load(spark, "/root/testdata/sf0.001")
    f.reads.createOrReplaceTempView("reads")
    plain, made = spark.sql(fx.REF_TILES_SQL), f.ref_tiles
    assert plain.dtypes == made.dtypes and sorted(map(tuple, plain.collect())) == sorted(map(tuple, made.collect()))
    odd = spark.range(7).selectExpr("1 as ref_index", "cast(array(0, 1, 32 * 58 + 1, 32 * 59, 32 * 60, 32 * 63 + 1, 2000)[id] as int) as pos")
    odd.createOrReplaceTempView("reads")
    want = {((p - 1) >> 5) + k for p in (0, 1, 1857, 1888, 1920, 2017, 2000) for k in range(6)}
    assert sorted(r.tile for r in spark.sql(fx.SPARK_SQL["ref_tiles"]).collect()) == sorted(want)


def test_a_read_in_one_chunk_is_one_narrow_row(spark):
    reads = spark.createDataFrame([("a", 0, 0, 5, "10M2I20M30N20M", "ACGT" * 13, "I" * 52), ("b", 0, 0, 500, "52M", "ACGTN" * 10 + "xA", "I" * 52),
                                   ("c", 4, -1, 0, "*", "*", "*")], "qname string, flag int, ref_index int, pos int, cigar string, seq string, qual string")
    rows = reference.segments(reads, ["qname"]).collect()
    assert sorted((r.qname, r.alone, len(r.parts) // 4, len(r.read_cut)) for r in rows) == [("a", True, 3, 25), ("b", False, 1, 7), ("b", False, 1, 39), ("c", True, 0, 0)]
    tiles = spark.createDataFrame([(0, 0, "acgt" * 8), (0, 1, "ACGN" * 8), (0, 18, "ACG")], "ref_index int, tile int, bases string")
    chunk, last = sorted(reference.chunks(tiles).collect(), key=lambda r: r.chunk)
    assert chunk.p0 == int("0123" * 8, 4) and chunk.p1 is None and chunk.odd[32:64] == "ACGN" * 8
    assert last.odd == " " * 64 + "ACG" + " " * 445


def test_packed_bases_come_back():
    import numpy as np
    size = np.array([0, 1, 3, 4, 5, 2])
    text = np.frombuffer(b"N" + b"ACG" + b"TTNK" + b"ACx=A" + b"\x1fA", dtype=np.uint8)
    packed = reference.packed_bases(text, size)
    assert [len(b) for b in packed.to_pylist()] == [0, 1, 2, 2, 5, 1]
    assert bytes(reference.unpacked_bases(packed, size)) == bytes(text)
