"""Quality rules: a threshold table compiled into Spark projections, no user functions.

``BASE`` statistics are counted per document; ``RULES`` bounds ratios of them.
Every expression is a built-in array or string function over the whole text, so
the job is one narrow stage without a shuffle. Repeated 5-word windows are found
by sorting (hash, position) pairs of the text's windows, only in texts that have
an equal pair.

Defined cases: null text has no words and fails the base rule, as does any text
under ten words; ratios over nothing are 0; repeated rows give repeated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
#: Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for was on are with as at by this from be or "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine "
    "le la les des et en du un une que est pour dans qui sur par au "
    "el los las de y del se por con para su al lo").split()
#: name: (numerator, denominator, least, most)
RULES = {
    "word_length": ("word_chars", "n_words", 2.0, 14.0),
    "symbols": ("n_symbols", "word_chars", None, 0.05),
    "stop_words": ("n_stop", "n_words", 0.03, None),
    "shouting": ("n_shout", "n_words", None, 0.3),
    "repeated_lines": ("n_dup_lines", "n_lines", None, 0.3),
    "repeated_words": ("n_repeat_words", "n_words", None, 0.2),
}


def _repeat_words(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = lambda s: F.sort_array(F.transform(
        F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False))
                 | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))), lambda x: x["i"]))
    # each window adds the words up to the next window's start, five at most
    cover = lambda p: F.aggregate(
        F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    return let(let(order, twice), cover)


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules use (longs)."""
    counts = ["n_words", "word_chars", "n_symbols", "n_stop", "n_shout", "n_lines", "n_dup_lines", "n_repeat_words"]
    keep = [c for c in docs.columns if c not in counts and not c.startswith("__q_")]
    t = F.coalesce(F.col("__q_t"), F.lit(""))
    out = docs.select(*keep, F.col(text).alias("__q_t"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.select(*keep, t.alias("__q_t"), words(F.col("__q_t")).alias("__q_w"), lines.alias("__q_l"))
    w, n = F.col("__q_w"), F.size("__q_w")
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumn("__q_h", hashes)
    h = F.col("__q_h")
    shout = F.filter(w, lambda x: x.rlike(r"^\P{Ll}*\p{Lu}\P{Ll}*[!?]{2,}$"))
    return out.select(
        *keep, n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length("__q_t") - F.length(F.translate("__q_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop"),
        F.size(shout).cast("long").alias("n_shout"),
        F.size("__q_l").cast("long").alias("n_lines"),
        (F.size("__q_l") - F.size(F.array_distinct("__q_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct(h)) < F.size(h), _repeat_words(h)).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"))


def verdict(rules: dict = RULES) -> Column:
    """The threshold table as one boolean expression over the counts."""
    ok = F.lit(True)
    for over, under, least, most in rules.values():
        ratio = F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(F.lit(0.0))
        if least is not None:
            ok = ok & (ratio >= F.lit(least))
        if most is not None:
            ok = ok & (ratio <= F.lit(most))
    return ok


def apply_rules(docs: DataFrame, rules: dict = RULES, text: str = "text") -> DataFrame:
    """``docs`` with its counts, ``base_failed`` and ``kept``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    out = statistics(docs, text).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & verdict(rules))
