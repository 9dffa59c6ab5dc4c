"""Text operators against plain versions on small tables with awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixdf.llm import decontam, jaccard, mixing, quality_rules, queries, quotes, suffix_dedup, token_store, toxicity, url_filter, weak_quality
from helixdf.llm.common import word_hashes

from . import brute

SCHEMA = "doc_id long, text string, source string, score string, n_words string, spans string, kept string, size string, shard string"


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, base = text(90), text(120).split(" ")
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "Ab"), (4, "ab"), (5, "x y z w"), (6, text(3000) + "\n" + passage), (7, passage + " " + text(20)), (7, "other words"), (8, "ab"), (8, "ab")]
    for i in range(9, 39):  # near copies of one text
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = word()
        rows.append((i, " ".join(w)))
    for i in range(39, 50):  # documents that share a passage
        rows.append((i, text(40) + " " + passage + ". " + text(40)))
    rows.append((50, "aa " * 400))
    rows.append((None, "no id here at all"))
    return rows


def frame(spark, rows, n=3):
    return spark.createDataFrame([(d, t, f"s{(d or 0) % 3}" if d != 5 else None, "a", "b", "c", "d", "e", "f") for d, t in rows], SCHEMA).repartition(n)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_word_hashes_follow_words():
    h, starts, ends = word_hashes(b"ab  ab\tb a ab")
    assert list(zip(starts, ends)) == [(0, 2), (4, 6), (7, 8), (9, 10), (11, 13)]
    assert h[0] == h[1] == h[4] and len(set(h.tolist())) == 3


@pytest.mark.parametrize("small,block,frequent", [(24, 1024, 1 << 18), (2, 4, 0), (2, 5, 64)])
def test_jaccard(spark, monkeypatch, small, block, frequent):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "REPORT", 2)
    rows = corpus()
    out = jaccard.near_duplicates(frame(spark, rows), frequent=frequent)
    assert got(out, "doc_id", "n_shingles", "component_id") == brute.jaccard(rows)


def test_keep_one(spark):
    rows = corpus()
    out = jaccard.keep_one(frame(spark, rows))
    assert out.columns == frame(spark, rows).columns
    groups = jaccard.near_duplicates(frame(spark, rows)).filter("n_shingles > 0").select("root").distinct().count()
    assert out.filter(F.col("text").isNotNull()).count() == groups + 2  # the empty texts stay
    assert jaccard.keep_one(frame(spark, rows[:1]).limit(0)).count() == 0


@pytest.mark.parametrize("run,bucket,length,spread", [(40_000, 6_000, 400, 256), (1, 3, 100, 64), (2, 2, 60, 16)])
def test_suffixes(spark, monkeypatch, run, bucket, length, spread):
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = corpus()
    out = suffix_dedup.remove_repeats(frame(spark, rows), length=length, spread=spread)
    out = out.withColumns({"spans_n": F.size("spans").cast("long"), "sha": F.sha2("kept", 256)})
    assert got(out, "doc_id", "n_bytes", "n_removed", "spans_n", "sha") == brute.suffixes(rows, length)


def test_suffix_query_counts_bytes_not_words(spark, tmp_path):
    rng = random.Random(7)
    passage = lambda n: "".join(" " if i % 6 == 5 else rng.choice("abcdefgh") for i in range(n))
    under, enough = passage(399), passage(400)  # 67 words each
    rows = [(1, f"<{under}>"), (2, f"({under})"), (3, f"<{enough}>"), (4, f"({enough})"), (5, passage(900))]
    frame(spark, rows).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    out = got(queries.op3_suffix_dedup(spark, str(tmp_path)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert out == brute.suffixes(rows)
    assert [r[1:4] for r in out] == [(401, 0, 0), (401, 0, 0), (402, 400, 1), (402, 400, 1), (900, 0, 0)]


def test_contexts_are_not_dealt_by_core(spark, monkeypatch):
    plans, stored = [], suffix_dedup.stored

    def spy(df, name="step"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(suffix_dedup, "stored", spy)
    monkeypatch.setattr(suffix_dedup, "RUN", 2)
    suffix_dedup.remove_repeats(frame(spark, corpus()), length=60, spread=16)
    join = [plan for name, plan in plans if name == "contexts"][-1]  # the long runs are counted in a step of their own
    assert "Join" in join and "Aggregate" not in join and "hashpartitioning" not in join


def test_multikey_quicksort():
    rng = random.Random(3)
    s = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    order, _ = suffix_dedup.multikey_quicksort(s)
    assert [s[i].rstrip(b"\0") for i in order] == sorted(s)


def test_leaks(spark):
    rows = corpus()
    items = [("q1", rows[6][1].split("\n")[1]), ("q2", "AB!"), ("q3", None), ("q4", "..."), ("q5", " ".join(rows[20][1].split(" ")[5:17])), ("q2b", "ab")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for bytes_ in (32 << 20, 200):  # one block, and several
        out = decontam.find_leaks(frame(spark, rows), bench, block_bytes=bytes_)
        hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["high"] - s["low"])
        out = out.select("doc_id", "n_words", hit.alias("hit"), F.size("items").cast("long").alias("n"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("sha"), (hit > 0).alias("bad"))
        assert got(out, *out.columns) == brute.leaks(rows, items)
    text = "é Ab—x, ab!"
    assert [text[a:b] for a, b in decontam.original_spans(text, [(1, 2), (2, 3)])] == ["Ab—x", "ab"]


def test_quality_rules(spark):
    rows = corpus() + [(60, "#a $b\n\nx\nx\r\nx\n x\nx"), (61, "a b c d e a b c d e f")]
    out = quality_rules.apply_rules(frame(spark, rows))
    assert got(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == brute.quality(rows)
    assert out.filter("base_failed and kept").count() == 0


def test_urls(spark):
    rows = [(1, "https://A.Example.NET/en/x?y"), (2, "http://example.com/de/1"), (3, "http://b.org/fr/"), (4, None), (5, "no scheme"), (6, "x://net"), (7, "ftp://myexample.net:80/en/"), (8, "http://a.net/"), (8, "http://a.net/"), (9, "a://b://c/d#e"), (10, "")]
    pages = spark.createDataFrame([(*r, "h", "v") for r in rows], "page_id long, url string, host string, verdict string")
    known = spark.createDataFrame([(f"http://{'good' if i % 2 else 'bad'}.com/{i}", i % 2) for i in range(80)] + [("http://z.com/1", None)], "url string, good int")
    out = url_filter.filter_urls(pages, known)
    assert got(out, "page_id", "host", "path", "rule") == brute.urls(rows)
    more = spark.createDataFrame([(1, "http://good.com/"), (2, "http://bad.com/")], "page_id long, url string")
    assert got(url_filter.filter_urls(more, known), "page_id", "verdict") == [(1, "allow"), (2, "block")]
    assert url_filter.filter_urls(pages.limit(0), known.limit(0)).count() == 0


def test_outcomes_of_urls_that_end_in_a_slash(spark, tmp_path):
    urls = ["http://h.com/en/1/", "http://h.com/en/2", "http://h.com/en/3/?q=4", "http://h.com/en/4/#f", "http://h.com/en/5.html", "http://h.com/6/en/", "http://h.com/7//"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    out = queries.page_outcomes(spark, str(tmp_path))
    assert got(out, "url", "good") == sorted(zip(urls, [1, 0, 1, 0, 1, None, None]), key=repr)


def test_tokens(spark):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = ["a\tb c", "It's they'll 123 a1b 2c. x", "a\n\nb", "a \nb", "...wow!!! a.b,c d", "naïve café\nÜber straße.", "日本 語 a", "a\t b", "_x y_ 'z", "''s 's a's!", "ª º x²"]
    rows = sorted([(d, t) for d, t in corpus() if d is not None and d not in (7, 8)] + [(100 + i, t) for i, t in enumerate(odd)])
    folder, manifest = token_store.write_tokens(frame(spark, rows), path)
    out = token_store.read_tokens(folder, manifest, with_ids=True)
    want = brute.tokens(rows, path)
    assert got(out, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
    first = manifest.orderBy("shard").first()
    one = token_store.read_document(folder, first["file"], 0)
    assert list(one) == out.filter(F.col("start") == 0).first()["ids"]
    assert list(token_store.read_document(folder, first["file"], 0)[-1:]) == [2]


def test_added_tokens_in_texts(spark):
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(1, "before <|endoftext|> after"), (2, "<|endoftext|>"), (3, "a<|endoftext|>b c"), (4, "a\t<|endoftext|>  b"), (5, "<|endoftext| > x")]
    folder, manifest = token_store.write_tokens(frame(spark, rows), path)
    out = token_store.read_tokens(folder, manifest, with_ids=True)
    assert got(out, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(brute.tokens(rows, path), key=repr)
    assert sorted(r["doc_id"] for r in out.collect() if 50256 in r["ids"]) == [1, 2, 3, 4]


def test_toxicity(spark):
    rng = random.Random(5)
    plain = [f"w{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        rows.append((i, " ".join(rng.choices(plain, k=40) + (["nasty"] if bad else []))))
        if i % 2 == 0:
            labels.append((i, int(bad)))
    docs = frame(spark, [*rows, (None, None), (601, "")])
    known = spark.createDataFrame([*labels, (None, 1), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, known, lambda c: F.lit(True))
    out = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, model).collect()}
    assert len(out) == 602 and all(0 <= s <= 1 for s in out.values())
    hit = [(out[i] >= toxicity.THRESHOLD) == (i % 5 == 0) for i in range(600)]
    assert np.mean(hit) > 0.97
    none = toxicity.train(docs, known.limit(0), lambda c: F.lit(True))
    assert not none[1].any()


def test_weak_quality(spark):
    rng = random.Random(6)
    good = lambda: " ".join(rng.choice(["the", "of", "and", "house", "garden", "river", "street", "window", "morning"]) + (rng.choice("abc") if rng.random() < 0.5 else "") for _ in range(60))
    rows = [(i, good() if i % 4 else " ".join(w.upper() + "!!" for w in good().split())) for i in range(200)] + [(200, None), (201, "")]
    out = weak_quality.classify(frame(spark, rows))
    kept = {r["doc_id"]: r["kept"] for r in out.collect()}
    assert np.mean([kept[i] == bool(i % 4) for i in range(200)]) > 0.95
    assert weak_quality.classify(frame(spark, rows).limit(0)).count() == 0


def test_quotes(spark):
    rows = [(1, 0, "user", "Hello there friend.\nSecond line."), (1, 1, "assistant", "> hello  there friend.\nFine, thanks."), (1, 2, "user", ">> Hello there friend.\n> Fine, thanks.\nGood."),
            (1, 3, "assistant", "unrelated"), (2, 0, "user", "> unrelated\n"), (2, 1, None, None), (3, 0, "user", ""), (3, 0, "user", ""), (None, 0, "user", "> nowhere to be found")]
    out = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    r = {(x["conv_id"], x["turn"]): x for x in out.collect()}
    assert out.count() == len(rows)
    assert r[1, 1]["reply_to"] == 0 and r[1, 1]["body"] == "Fine, thanks." and r[1, 1]["n_quotes"] == 1
    assert r[1, 2]["reply_to"] == 1 and r[1, 2]["thread"] == 0 and r[1, 2]["n_linked"] == 2 and r[1, 2]["body"] == "Good."
    assert (r[2, 0]["quoted_conv"], r[2, 0]["quoted_turn"], r[2, 0]["reply_to"], r[2, 0]["body"]) == (1, 3, None, "")
    assert r[2, 1]["body"] == "" and r[None, 0]["n_linked"] == 0
    assert [r[1, t]["place"] for t in range(4)] == [1, 2, 3, 4]


def test_partial_and_repeated_quotes(spark):
    rng = random.Random(8)
    line = lambda: rng.choice(["alpha", "Beta two", "gamma  three", "delta", "eps ilon", "zeta", "eta"])
    para = lambda: "\n".join(line() for _ in range(rng.randint(1, 3)))
    quoted = lambda t: "\n".join("> " + x for x in t.split("\n"))
    rows, texts = [], []
    for i in range(120):
        own = "\n\n".join(para() for _ in range(rng.randint(1, 3)))
        text = own
        if texts and rng.random() < 0.6:
            src = rng.choice(texts).split("\n")
            a = rng.randrange(len(src))
            text = quoted("\n".join(src[a:a + rng.randint(1, 4)])) + "\n" + own
        texts.append(own)
        rows.append((i % 12 if i % 12 else None, i // 12, "user", text))
    # two lines of a paragraph of three; two paragraphs of three; a holder in another conversation behind a later one of its own
    rows += [(50, 0, "user", "L one\nL two\nL three"), (50, 1, "user", "> L two\n> L three"), (51, 0, "user", "P one\n\nP two\nmore\n\nP three"),
             (51, 1, "user", "> P two more\n>\n> P three\nyes"), (60, 0, "user", "> seen here"), (60, 1, "user", "seen here"), (61, 0, "user", "seen here")]
    out = quotes.link_quotes(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    links = got(out, "conv_id", "turn", "n_linked", "quoted_conv", "quoted_turn", "reply_to")
    assert links == sorted(brute.quotes(rows), key=repr)
    r = {(x[0], x[1]): x[2:] for x in links}
    assert r[50, 1] == (1, 50, 0, 0) and r[51, 1] == (1, 51, 0, 0) and r[60, 0] == (1, 61, 0, None)


def test_mixing(spark):
    rng = random.Random(7)
    rows = [(i, " ".join("w" for _ in range(rng.randint(0, 30)))) for i in range(600)]
    docs = spark.createDataFrame([(d, t, [None, "a", "b", "b", "b", "b", "b", "b"][d % 8]) for d, t in rows], "doc_id long, text string, source string")
    sized, plan = mixing.planned(docs, shard_words=2_000)
    out = mixing.draw(sized, plan).collect()
    taken = {}
    for r in out:
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"]
    for name, size, target in plan.totals:
        assert target <= 3 * size + 1e-6 and abs(taken.get(name, 0) - target) <= 60
    assert abs(sum(t for _, _, t in plan.totals) - sum(s for _, s, _ in plan.totals)) < 1e-6
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mixing.draw(sized, mixing.plan_mix(sized, shard_words=2_000)).collect()), key=repr)
    q = mixing.split_quotas(np.array([7, 0, 100]), 5, 1)
    assert q.sum(axis=0).tolist() == [7, 0, 100] and max(q.sum(axis=1)) - min(q.sum(axis=1)) <= 1
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_mixing_of_repeated_rows(spark, tmp_path):
    rng = random.Random(9)
    rows = [(d, " ".join("w" for _ in range(rng.randint(1, 30))), "ab"[d % 5 > 0]) for d in range(300)]
    rows += [r for r in rows for _ in range(r[0] % 4)] + [(None, "w w w", None)] * 3 + [(7, "w", "b")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op10_mixing(spark, str(tmp_path)).collect()
    sized, plan = mixing.planned(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    drawn = {r[0]: r[1] for r in mixing.draw(sized, plan).groupBy("source").agg(F.sum("size")).collect()}
    assert len(out) == len(rows)
    assert all(r["taken"] % r["size"] == 0 and r["taken"] <= 3 * r["size"] for r in out)
    assert sum(r["taken"] for r in out) == sum(drawn.values())


def test_pipeline_stages(spark):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert rows and min(r["start"] for r in rows) == 0
    assert sum(r["n_tokens"] for r in rows) == max(r["start"] + r["n_tokens"] for r in rows)
    assert len(corpus_pipeline.STAGES) == 5
