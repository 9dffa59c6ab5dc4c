"""From raw documents to token files: toxic documents go, one of each group of near copies
stays, documents with benchmark passages go, the sources are mixed to their targets, and
the mix is written as token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixdf.llm import decontam, jaccard, mixing, token_store, toxicity
from helixdf.llm.common import read, stored
from helixdf.llm.queries import learned, tokenizer_path

#: The stages train models, mix by hash and tokenize, which SQL cannot express.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the threshold."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), learned)
    plain = docs.withColumnRenamed("score", "__score") if "score" in docs.columns else docs
    kept = toxicity.score_toxicity(plain, model).filter(F.col("score") < toxicity.THRESHOLD).drop("score")
    return kept.toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by word 5-grams."""
    return jaccard.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontam.find_leaks(docs, read(spark, sf_dir, "benchmark"))
    return found.filter(F.size("spans") == 0).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shard by shard."""
    return mixing.mix_sources(docs).select(*docs.columns)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in ascending order of ids, and what reading them gives."""
    folder, manifest = token_store.write_tokens(docs, tokenizer_path())
    return token_store.read_tokens(folder, manifest)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("source_mixing", mix),
    ("token_output", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
