"""What steps leave on disk, and which texts they exchange."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helixdf import session
from helixdf.llm import common, jaccard

from . import brute
from .test_operators import frame, got


def _texts(n, words=300, seed=5):
    """Texts without common words, but each tenth has a near copy of the one before."""
    rnd, out = random.Random(seed), []
    for i in range(n):
        own = [f"w{i}x{rnd.randrange(10 ** 6)}" for _ in range(words)]
        out.append(" ".join([*out[-1].split()[:-3], "other", "end"] if i % 10 == 1 else own))
    return out


def _shuffle_bytes(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [files.apply(i).getPath() for i in range(files.size())]
    return sum(os.path.getsize(p) for p in paths if os.path.basename(p).startswith("shuffle_") and os.path.exists(p))


def test_near_duplicates_leave_few_shuffle_files(spark):
    rows = list(enumerate(_texts(400)))
    docs = frame(spark, rows)
    before, off = _shuffle_bytes(spark), spark.conf.get(session._DROP)
    out = jaccard.near_duplicates(docs)
    left = _shuffle_bytes(spark) - before
    assert left < sum(len(r[1]) for r in rows) / 4
    assert spark.conf.get(session._DROP) == off
    assert got(out, "doc_id", "n_shingles", "component_id") == brute.jaccard(rows)


@pytest.mark.parametrize("words", [1, 3, 1 << 18])
def test_a_sieve_loses_no_key(spark, monkeypatch, words):
    monkeypatch.setattr(common, "SIEVE", words)
    rows = spark.createDataFrame([(i if i % 50 else None, f"t{i}") for i in range(1000)], "id long, t string")
    keys = [None, *range(1, 1000, 7), -1, 5000]
    bits = common.sieve(spark.createDataFrame([(k,) for k in keys], "k long"), F.col("k"))
    passed = {r.t for r in common.sifted(rows, F.col("id"), bits).collect()}
    rest = {r.t for r in common.sifted(rows, F.col("id"), bits, "left_anti").collect()}
    assert {r.t for r in rows.collect() if r.id in keys} <= passed
    assert passed | rest == {f"t{i}" for i in range(1000)} and not passed & rest
    assert words < 1 << 18 or len(passed) < 180


def test_texts_without_copies_are_not_exchanged(spark):
    docs = spark.createDataFrame(list(enumerate(_texts(60))), "doc_id long, text string")
    plan = jaccard.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    union = plan[plan.index("Union"):].split("\n")
    alone = next(k for k, line in enumerate(union) if "BroadcastHashJoin" in line)
    assert "LeftAnti" in union[alone] and not any("Exchange" in line for line in union[:alone])


@pytest.mark.parametrize("words,narrow", [(1, 0), (1 << 18, 20)])
def test_one_row_of_repeated_ids_and_copies_stays(spark, monkeypatch, words, narrow):
    monkeypatch.setattr(common, "SIEVE", words)
    monkeypatch.setattr(jaccard, "NARROW", narrow)
    t = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    near = t.replace("z", "zz")
    rows = [(3, t), (3, near), (3, t), (4, near), (None, t), (None, "alone here"), (None, "alone here"), (7, "one two three four five six"), (7, None),
            (3, ""), (8, "  "), (8, "of its own"), (8, "of its own"), (9, "of its own"), (10, "something else"), (None, None)]
    docs = spark.createDataFrame([(i, x, n) for n, (i, x) in enumerate(rows)], "doc_id long, text string, i int")
    out = jaccard.keep_one(docs)
    found = jaccard.near_duplicates(docs).filter("n_shingles > 0").collect()
    best = {}
    for r in found:
        key = (r.doc_id is not None, r.doc_id or 0, r.cls)
        best[r.root] = min(best.get(r.root, key), key)
    cls = {" ".join(x.split()): jaccard.class_of(jaccard.shingle_chunks([x.encode()]).__next__()[1][0]) for _, x in rows if x and x.split()}
    want = {}
    for n, (i, x) in enumerate(rows):
        c = cls.get(" ".join((x or "").split()))
        key = n if c is None else (i is not None, i or 0, c)
        if c is None or key in best.values():
            want[key] = min(want.get(key, (x or "", n)), (x or "", n))  # of rows with an id and a class the least columns
    assert out.columns == docs.columns and sorted(r.i for r in out.collect()) == sorted(n for _, n in want.values())
    assert len(best) == 5 and len(want) == 5 + 4


def test_texts_are_compared_only_if_their_own_overlap_allows_a_link(spark, monkeypatch):
    """All share one passage, and each shares some words with two others: no pair shares enough."""
    rnd = random.Random(3)
    word = lambda: f"w{rnd.randrange(10 ** 9)}"
    passage, parts = [word() for _ in range(24)], [[word() for _ in range(92)] for _ in range(60)]
    rows = [(i, " ".join([*parts[i], word(), *parts[(i + 1) % 60], word(), *passage, *[word() for _ in range(90)]])) for i in range(60)]
    rows.append((60, rows[0][1] + " more"))
    seen, with_sets = [], jaccard._with_sets
    monkeypatch.setattr(jaccard, "_with_sets", lambda rows, described, units, *a: (seen.append(units.select("cls").distinct().count()), with_sets(rows, described, units, *a))[1])
    out = jaccard.near_duplicates(frame(spark, rows), frequent=0)
    assert got(out, "doc_id", "n_shingles", "component_id") == brute.jaccard(rows)
    assert 2 <= seen[0] < 12


def test_pairs_are_allowed_by_both_kinds_of_shared_n_grams(spark):
    # sizes 100 and 100: 86 are needed, 74 may be in the rest
    rows = [(1, 2, 12), (1, 3, 11), (1, 4, 11), (2, 3, 10), (3, 4, 9), (5, 6, 12)]
    pairs = spark.createDataFrame([(a, b, 100, 100, c) for a, b, c in rows], "a long, b long, na long, nb long, common long")
    own = spark.createDataFrame([(1, [7, 8, 9]), (2, [5]), (3, [5, 8]), (4, [5, 6])], "cls long, grams array<long>")
    assert {(r.a, r.b) for r in jaccard._allowed(pairs, own, 75).collect()} == {(1, 2), (1, 3), (5, 6)}
