"""SetSketch near-duplicates, ball-tree search and Merkle manifest against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixdf.llm import ball_tree, merkle, queries, setsketch
from helixdf.llm.shingles import shingle_sets

from . import brute
from .test_operators import corpus, frame, got


def test_registers_merge_and_estimate():
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(600)]
    for kept in (600, 540, 400, 0):
        other = base[:kept] + [word() for _ in range(rng.randint(1, 400))]
        a, b = shingle_sets([" ".join(base).encode(), " ".join(other).encode()], 4)
        true = setsketch.common(a, b) / len(np.union1d(a, b))
        ra, rb = setsketch.sketches([a, b])
        assert (setsketch.merge(ra, rb) == setsketch.sketches([np.union1d(a, b)])[0]).all()
        est = setsketch.estimated(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(est - true) < 0.15
    assert setsketch.estimated(ra[None], ra[None], np.array([9]), np.array([9]))[0] > 0.99


def test_pieces_of_long_texts_give_the_same_registers(monkeypatch):
    s = shingle_sets([b" ".join(b"w%d" % i for i in range(5000))], 4) + shingle_sets([b"a b c d e"], 4)
    whole = setsketch.sketches(s)
    monkeypatch.setattr(setsketch, "PIECE", 97)
    assert (setsketch.sketches(s) == whole).all()


@pytest.mark.parametrize("block", [1024, 4])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(setsketch, "BLOCK", block)
    rows = corpus()
    out = setsketch.near_duplicates(frame(spark, rows))
    assert got(out, "doc_id", "n_shingles", "component_id") == brute.jaccard(rows, 4, 80)


@pytest.mark.parametrize("block", [1024, 7])
def test_chains_of_links(spark, monkeypatch, block):
    """Each text is close to the next only, so most members of a group link with others than the least."""
    monkeypatch.setattr(setsketch, "BLOCK", block)
    rng = random.Random(4)
    rows, w = [], [str(rng.random()) for _ in range(150)]
    for i in range(60):
        w = w[4:] + [str(rng.random()) for _ in range(4)]
        rows.append((i, " ".join(w)))
    rng.shuffle(rows)
    out = setsketch.near_duplicates(frame(spark, rows))
    assert got(out, "doc_id", "n_shingles", "component_id") == brute.jaccard(rows, 4, 80)


def test_near_duplicates_of_awkward_tables(spark):
    assert setsketch.near_duplicates(frame(spark, corpus()).limit(0)).count() == 0
    same = [(None, "a b c d e f"), (None, "a b c d e f"), (None, "x"), (None, None), (3, "a b c d e f"), (2, "A B c d e f")]
    assert got(setsketch.near_duplicates(frame(spark, same)), "doc_id", "n_shingles", "component_id") == brute.jaccard(same, 4, 80)
    long_ = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long_), (2, long_ + " tail"), (3, "w1 w2")]
    assert got(setsketch.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id") == brute.jaccard(rows, 4, 80)


def items():
    rows = corpus()
    return [(1, rows[6][1][:300]), (2, "AB, ab!"), (3, None), (4, "..."), (5, "no such t\u00e9rms h\u00e8re"), (5, rows[20][1]), (None, "x y"), (7, "")]


@pytest.mark.parametrize("chunk,leaf,top,block", [(4096, 64, 50, 1024), (16, 2, 3, 2), (30, 5, 7, 3)])
def test_search(spark, monkeypatch, chunk, leaf, top, block):
    monkeypatch.setattr(ball_tree, "CHUNK", chunk)
    monkeypatch.setattr(ball_tree, "LEAF", leaf)
    monkeypatch.setattr(ball_tree, "PART", 2)
    bench = spark.createDataFrame(items(), "item_id long, text string")
    out = ball_tree.search(frame(spark, corpus()), bench, top=top, block=block)
    assert got(out, "item_id", "rank", "doc_id", "score") == brute.search(corpus(), items(), top)


def test_search_of_awkward_tables(spark):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    docs = frame(spark, corpus())
    assert ball_tree.search(docs.limit(0), bench).count() == 0
    assert ball_tree.search(docs, bench.limit(0)).count() == 0
    extra = docs.withColumns({"rank": F.lit("a"), "query": F.lit("b"), "h": F.lit(1), "terms": F.lit(2)})
    assert got(ball_tree.search(extra, bench), "item_id", "rank", "doc_id", "score") == brute.search(corpus(), items())


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    size = rng.integers(1, 12, 400)
    at = np.concatenate(([0], np.cumsum(size)))
    group = np.repeat(np.arange(400) // 50, size)  # neighbours share terms
    idx = np.concatenate([np.sort(rng.choice(20, n, replace=False)) for n in size]) + 20 * group
    x = rng.integers(1, 1_000_000, len(idx))
    weights = rng.integers(0, 9000, 160)
    block = ball_tree.Block([], weights, 400, 4000)
    tree = ball_tree.Tree(at, idx, x, block, leaf=10)
    dense = np.zeros((400, 160), dtype=np.int64)
    dense[np.repeat(np.arange(400), size), idx] = x
    assert sorted(tree.order.tolist()) == list(range(400))
    scored = 0
    for i in range(40):
        terms = np.sort(rng.choice(20, 6, replace=False)) + 20 * (i % 8)
        weight = np.zeros(160, dtype=np.int64)
        weight[terms] = weights[terms]
        score = dense @ weight
        bound = tree.bounds(terms, block.root)
        for k, b in enumerate(bound):
            assert score[tree.order[tree.low[k]:tree.high[k]]].max() <= b
        f = ball_tree.Found(5, 1)
        f.ids = (np.ones(400, dtype=np.int64), np.arange(400))
        scored += tree.search(terms, block, weight, f)
        want = sorted(((-s, d) for d, s in enumerate(score.tolist()) if s > 0))[:5]
        assert [(-s, d) for s, d in zip(f.score.tolist(), f.doc.tolist())] == want
    leaves = sum(not k for k in tree.kids)
    assert scored < 40 * leaves / 2


ROWS = [(i if i % 9 else None, None if i % 11 == 0 else f"Text {i} \u00c9A", None if i % 4 == 0 else "en", [None, "a", "a", "a", "b", "\u00e9", ""][i % 7], None if i % 5 == 0 else i) for i in range(900)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[3:5], [r for r in ROWS if r[3] == "a"][:17], ROWS[:40] * 2, [(i, "A", "x", f"s{i}", 1) for i in range(18)]])
def test_manifest(spark, tmp_path, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, idx int")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op13_merkle_manifest(spark, str(tmp_path))
    assert got(out, *out.columns) == brute.merkle(rows)


def test_empty_manifest_and_proofs(spark):
    df = spark.createDataFrame([(i, "s", f"{i:064x}") for i in range(40)], "doc_id long, source string, leaf string")
    assert merkle.prove(df.limit(0)).count() == 0
    out = merkle.prove(df)
    assert out.filter(merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 40
    assert out.filter(merkle.fold(F.lit("0"), F.col("proof")) == F.col("root")).count() == 0
