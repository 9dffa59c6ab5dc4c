"""One query per text operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree, decontam, jaccard, merkle, mixing, quality_rules, quotes, setsketch, suffix_dedup, token_store, toxicity, url_filter, weak_quality
from .common import ascii_lower, read
from .oracles import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TOKENIZER = "byte_bpe_50k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def learned(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) != 2


def page_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """url, good: a page's document is the number that ends its path, before a slash at the end
    if there is one; its worst label counts."""
    pages, labels = read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("good"))
    number = F.expr(r"try_cast(regexp_extract(url, '/([0-9]+)[^0-9/]*/?(?:[?#].*)?$', 1) as bigint)")
    return pages.select("url", number.alias("n")).join(good, F.col("n") == F.col("doc_id"), "left").select("url", "good")


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, page_outcomes(spark, sf_dir)).select("page_id", "host", "path", "rule", "verdict")


@query
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, learned)
    out = toxicity.score_toxicity(docs, model)
    return out.select("doc_id", (~learned(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_store.write_tokens(read(spark, sf_dir, "documents"), tokenizer_path())
    return token_store.read_tokens(folder, manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.find_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["high"] - s["low"])
    return out.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.classify(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "weak_label", "score", "kept")


@query
def op9_chat_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(read(spark, sf_dir, "conversations"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sized, plan = mixing.planned(docs)
    # rows of equal doc_id and source are taken alike: the takes of a key are those of each copy times its copies
    keys = {"doc_id": "d", "source": "s"}
    takes = mixing.draw(sized, plan).groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("takes"), F.lit(0).cast("long").alias("copies"))
    copies = sized.groupBy("doc_id", "source").agg(F.lit(0).cast("long").alias("takes"), F.count(F.lit(1)).alias("copies"))
    taken = takes.unionByName(copies).groupBy("doc_id", "source").agg(F.expr("sum(takes) div sum(copies)").alias("times")).withColumnsRenamed(keys)
    out = sized.join(taken, sized["doc_id"].eqNullSafe(F.col("d")) & sized["source"].eqNullSafe(F.col("s")), "left")
    names = plan.sources.select(F.col("__src").alias("name"), "source_size", "target")
    out = out.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name")))
    return out.select("doc_id", "size", "source_size", "target", (F.coalesce("times", F.lit(0).cast("long")) * F.col("size")).alias("taken"))


@query
def op11_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = setsketch.near_duplicates(read(spark, sf_dir, "documents"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query
def op12_ball_tree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row is tampered with where 5 divides the crc32 of its id as text."""
    fields = {c: F.col(c) for c in merkle.FIELDS}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = F.when(hit, merkle.leaf_of([*list(fields.values())[:-1], ascii_lower(fields["text"])]))
    rows = read(spark, sf_dir, "documents").select("doc_id", "source", merkle.leaf_of(list(fields.values())).alias("leaf"), changed.alias("changed"))
    out = merkle.prove(rows, carry=["changed"])
    out = out.withColumns({"proof_sha256": merkle.digest(merkle.siblings(F.col("proof"))), "folded_root": merkle.fold(F.coalesce("changed", "leaf"), F.col("proof"))})
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
