"""FASTQ on disk and in exchanges: compressed, in order, and the same text."""

import glob
import gzip
import os
import random

import pytest

from helixdf.plans import io
from helixdf.sources import text


def _shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [files.apply(i).getPath() for i in range(files.size())]
    return sum(os.path.getsize(p) for p in paths if os.path.basename(p).startswith("shuffle_") and os.path.exists(p))


def _plain(r1, r2):
    """chunk_id -> text: records by mate, then by text; lines that are null are left out."""
    out = {}
    for mate, rows in ((1, r1), (2, r2)):
        for c, name, seq, qual in rows:
            rec = "\n".join(x for x in (None if name is None else "@" + name, seq, "+", qual) if x is not None)
            out.setdefault(c, []).append((mate, rec))
    return {c: "\n".join(rec for _, rec in sorted(rs)) for c, rs in out.items()}


@pytest.mark.parametrize("block", [1, 3, 2048])
@pytest.mark.parametrize("kind", ["long", "int"])
def test_interleaving_odd_records(spark, monkeypatch, block, kind):
    monkeypatch.setattr(text, "BLOCK", block)
    r1 = [(i, f"n{i}", "ACGT", "II+é") for i in range(12)] + [(3, "n0", "AC", "@\n"), (3, "n0", "", ""), (30, None, "A", "I"), (31, "x", None, None), (None, "lost", "A", "I"), (-5, "m", "A", "I")]
    r2 = [(i, f"n{i}", "TT", "##") for i in range(11, 0, -1)] + [(40, "only", "T", "#"), (None, "lost2", "A", "I"), (31, None, None, None)]
    random.Random(1).shuffle(r1)
    cols = f"chunk_id {kind}, name string, seq string, qual string"
    out = text.interleave_fastq(spark.createDataFrame(r1, cols).repartition(3), spark.createDataFrame(r2, cols))
    got = [(r.chunk_id, r.value) for r in out.collect()]
    assert len(got) == len(dict(got)) and dict(got) == _plain(r1, r2)
    assert out.dtypes == [("chunk_id", {"long": "bigint"}.get(kind, kind)), ("value", "string")]
    empty = spark.createDataFrame([], cols)
    assert text.interleave_fastq(empty, empty).count() == 0


def test_interleaving_exchanges_compressed_blocks(spark, tmp_path):
    rnd = random.Random(2)
    for mate in "12":
        records = (f"@r{i}_{rnd.randrange(10 ** 6)}\n{''.join(rnd.choices('ACGT', k=100))}\n+\n{''.join(rnd.choices('!+5:?ABC', k=100))}\n" for i in range(5000))
        os.mkdir(tmp_path / mate)
        (tmp_path / mate / "a.fq").write_text("".join(records))
    out = text.interleave_fastq(*(text.read_fastq(spark, str(tmp_path / mate)) for mate in "12"))
    before = _shuffle_bytes(spark)
    out.write.format("noop").mode("overwrite").save()
    assert _shuffle_bytes(spark) - before < 0.5 * sum(os.path.getsize(p) for p in glob.glob(f"{tmp_path}/*/a.fq"))


def test_fastq_files_are_compressed_bounded_and_in_order(spark, monkeypatch):
    monkeypatch.setattr(io, "FASTQ_RECORDS", 100)
    before = _shuffle_bytes(spark)
    p1, p2 = io._write_fastq(spark, "/root/testdata/sf0.001")
    names = []
    for p in (p1, p2):
        files = sorted(glob.glob(p.replace("file:", "") + "/part-*"))
        lines = [gzip.open(f, "rt").read().split("\n")[:-1] for f in files]
        assert len(files) >= 60 and max(map(len, lines)) == 400
        names.append([x for f in lines for x in f[::4]])
    assert names[0] == sorted(names[0]) == names[1]
    assert _shuffle_bytes(spark) - before < 40 * len(names[0])
