"""Extra columns named like inner ones, and samples of tables that repeat an id."""

from pyspark.sql import functions as F

from helixdf.llm import mixing, suffix_dedup, toxicity, weak_quality

from .test_operators import corpus, frame, got


def test_mixing_keeps_columns_named_like_the_plan(spark):
    docs = frame(spark, corpus()).drop("size", "shard")
    names = ["target", "rest", "passes", "source_rank", "n_blocks", "source_size", "size", "__u", "__row", "place"]
    extra = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    out = mixing.mix_sources(extra, shard_words=500)
    assert out.columns == [*[c for c in extra.columns if c != "place"], "shard", "place"]
    assert got(out, "doc_id", "text", "shard", "place") == got(mixing.mix_sources(docs, shard_words=500), "doc_id", "text", "shard", "place")
    assert out.filter("target != concat('target', doc_id) or size != concat('size', doc_id)").count() == 0
    assert mixing.mix_sources(extra.limit(0)).count() == 0


def test_suffix_dedup_keeps_columns_named_like_the_join(spark):
    docs = frame(spark, corpus()).select("doc_id", "text")
    extra = docs.withColumns({n: F.lit("mine") for n in ("rid", "low", "high", "core", "own")})
    out = suffix_dedup.remove_repeats(extra, length=40, spread=8)
    plain = suffix_dedup.remove_repeats(docs, length=40, spread=8)
    assert got(out, "doc_id", "n_bytes", "n_removed", "kept") == got(plain, "doc_id", "n_bytes", "n_removed", "kept")
    assert out.filter("rid = 'mine' and low = 'mine' and core = 'mine'").count() == docs.count()


def test_samples_hold_one_row_of_an_id(spark, monkeypatch):
    rows = [(1, f"bad awful text {i}") for i in range(60)] + [(2, f"good kind text {i}") for i in range(60)] + [(None, f"none {i}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, True), (2, False)], "doc_id long, toxic boolean")
    sizes = []

    def seen(kind, real):
        def each(features, *args, **kwargs):
            sizes.append((kind, len(features)))
            return real(features, *args, **kwargs)
        return each

    monkeypatch.setattr(toxicity, "Rows", seen("toxicity", toxicity.Rows))
    monkeypatch.setattr(weak_quality, "Rows", seen("quality", weak_quality.Rows))
    toxicity.train(docs, labels, lambda c: F.lit(True))
    weak_quality.classify(docs).count()
    # two ids, one of them also positive; nulls are no id of a label, but one of the quality sample
    assert sizes[0][0] == "toxicity" and sizes[0][1] <= 3
    assert sizes[-1] == ("quality", 3)
