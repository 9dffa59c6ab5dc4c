"""Chat formatting: quoted passages are linked to the messages they come from.

A line's quote level is the number of ``>`` before its content. Runs of lines of
one level are passages; a passage is normalised (A-Z lower-cased, white space
runs to one space) and hashed. Originals offer their whole own text, their
paragraphs and their lines under the same hash. A quoted passage links to the
first message of its own conversation that holds it in an earlier turn, else to
the first message of another conversation that holds it. A passage of several lines
that is no unit of a message counts as held by it, after messages that have it as a
unit, if each of its paragraphs is a unit, as a whole or line by line. A message that quotes an earlier
message of its conversation follows it: conversations are ordered by thread
(the turn that a chain of replies starts from), then turn.

Only DataFrame functions. Originals are reduced to one row per (conversation,
hash) and two per hash before they are joined to quotes, so frequent passages make no
pairs; a passage taken apart is compared with the holders of its rarest part only.
Places in a conversation come from one global rank, not from a window over it.

Defined cases: null text has no lines, an empty body and no quotes; a message
that holds quotes only keeps an empty body; equal rows stay and take
consecutive places; a null conversation is a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.order import global_rank
from .common import ascii_lower

_PARAGRAPH = r"\n[ \t]*\n"
_QUOTE = r"^((?:[ \t]*>)+)[ \t]?"


def normalised(c: Column) -> Column:
    return F.trim(F.regexp_replace(ascii_lower(c), r"[\x20\x09-\x0D]+", " "))


def passages(messages: DataFrame, text: str = "text") -> DataFrame:
    """``messages`` with ``body`` (own lines) and ``passages``: array of (level, content)."""
    keep = [c for c in messages.columns if c not in ("body", "passages")]
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _QUOTE, 1), r"[ \t]", "")).alias("level"),
        F.regexp_replace(x, _QUOTE, "").alias("content")))
    out = messages.select(*keep, lines.alias("__lines"))
    ln = F.col("__lines")
    starts = F.filter(F.sequence(F.lit(0), F.size(ln) - 1),
                      lambda i: (i == 0) | (F.get(ln, i - 1)["level"] != F.get(ln, i)["level"]))
    out = out.withColumn("__starts", starts)
    st = F.col("__starts")
    runs = F.transform(st, lambda i, j: F.struct(
        F.get(ln, i)["level"].alias("level"),
        F.array_join(F.transform(F.slice(ln, i + 1, F.coalesce(F.get(st, j + 1), F.size(ln)) - i), lambda x: x["content"]), "\n").alias("content")))
    own = F.transform(F.filter(ln, lambda x: x["level"] == 0), lambda x: x["content"])
    return out.select(*keep, F.array_join(own, "\n").alias("body"), runs.alias("passages"))


def _originals(parsed: DataFrame, conv: str, turn: str) -> DataFrame:
    units = F.array_distinct(F.concat(
        F.array(F.col("body")), F.split("body", _PARAGRAPH), F.split("body", "\n"),
        F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: p["content"])))
    return (parsed.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.explode(units).alias("unit"))
            .select("conv", "turn", normalised(F.col("unit")).alias("unit")).filter("unit != ''")
            .select("conv", "turn", F.md5("unit").alias("hash")))


def _nearest(quotes: DataFrame, found: DataFrame, key: str, near: str, far: str) -> DataFrame:
    """``quotes`` with ``near``, the first earlier turn of the own conversation that holds
    the key, and ``far``, the first (conv, turn) of another one: of the two least
    conversations of a key, one is another."""
    asked = found.join(quotes.select(key).distinct(), key, "left_semi")
    inside = asked.groupBy("conv", key).agg(F.min("turn").alias(near), F.min(F.struct("turn"))["turn"].alias("least"))
    least = inside.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy("conv"))).filter("place <= 2")
    ends = least.groupBy(F.col(key).alias("end_key")).agg(F.min(F.struct("conv", F.col("least").alias("turn"))).alias("a"),
                                                          F.max(F.struct("conv", F.col("least").alias("turn"))).alias("b"))
    inside = inside.select(F.col("conv").alias("in_conv"), F.col(key).alias("in_key"), near)
    out = (quotes.join(inside, quotes["conv"].eqNullSafe(F.col("in_conv")) & (quotes[key] == F.col("in_key")) & (F.col(near) < quotes["turn"]), "left")
           .join(ends, quotes[key] == F.col("end_key"), "left"))
    other = F.when(~F.col("a.conv").eqNullSafe(F.col("conv")), F.col("a")).when(~F.col("b.conv").eqNullSafe(F.col("conv")), F.col("b"))
    return out.select(*quotes.columns, near, other.alias(far))


def _part_holders(runs: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, turn, run): originals with each paragraph of a run (``run``, ``content``), whole or line by line."""
    pars = runs.select("run", F.posexplode(F.split("content", _PARAGRAPH)).alias("par", "p")).withColumn("whole", normalised(F.col("p"))).filter("whole != ''")
    line = pars.select("run", "par", F.lit(False).alias("is_whole"), F.explode(F.transform(F.split("p", "\n"), normalised)).alias("unit"))
    parts = (pars.select("run", "par", F.lit(True).alias("is_whole"), F.col("whole").alias("unit")).unionByName(line)
             .filter("unit != ''").select("run", "par", "is_whole", F.md5("unit").alias("hash")).distinct().checkpoint())
    holders = found.join(parts.select("hash").distinct(), "hash", "left_semi").distinct().checkpoint()
    held = holders.groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    counted = parts.join(held, "hash", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    entry = F.struct("n", "hash")
    seeds = (counted.groupBy("run", "par").agg(F.max(F.when(F.col("is_whole"), entry)).alias("w"), F.min(F.when(~F.col("is_whole"), entry)).alias("l"))
             .groupBy("run").agg(F.min(F.struct((F.col("w.n") + F.col("l.n")).alias("n"), "w.hash", F.col("l.hash").alias("hash_l"))).alias("s"))
             .select("run", F.explode(F.array_distinct(F.array("s.hash", "s.hash_l"))).alias("hash")))
    tried = seeds.join(holders, "hash").select("run", "conv", "turn").distinct().join(parts, "run")
    have = holders.select(F.col("hash").alias("h"), F.col("conv").alias("c"), F.col("turn").alias("t"))
    hit = F.col("h").isNotNull()
    return (tried.join(have, (F.col("hash") == F.col("h")) & F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
            .groupBy("run", "conv", "turn", "par").agg(F.max(F.col("is_whole") & hit).alias("all_p"), F.min(F.col("is_whole") | hit).alias("all_l"))
            .groupBy("run", "conv", "turn").agg(F.min(F.col("all_p") | F.col("all_l")).alias("ok")).filter("ok").select("conv", "turn", "run"))


def _threads(replies: DataFrame) -> DataFrame:
    """(conv, turn, to): the turn that each chain of replies starts from, by pointer
    doubling; turns fall along a chain, so it ends."""
    cur = replies
    while True:
        nxt = cur.select(F.col("conv").alias("c2"), F.col("turn").alias("t2"), F.col("to").alias("to2"))
        cur = (cur.join(nxt, cur["conv"].eqNullSafe(nxt["c2"]) & (cur["to"] == nxt["t2"]), "left")
               .select("conv", "turn", F.coalesce("to2", "to").alias("to"), F.col("to2").isNotNull().alias("moved"))
               .checkpoint())
        more = not cur.filter("moved").isEmpty()
        cur = cur.drop("moved")
        if not more:
            return cur


def link_quotes(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                text: str = "text") -> DataFrame:
    """One row per message: conversation, turn, role, body without quotes, n_quotes,
    n_linked, quoted_conv and quoted_turn of its first linked passage, reply_to (the
    earlier turn of its conversation it answers), thread (first turn of that chain)
    and place (1, 2, ... in the conversation's reply order)."""
    base = messages.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    parsed = passages(base, "text")
    content = F.col("p.content")
    quotes = (parsed.select("conv", "turn", F.posexplode(F.filter("passages", lambda p: p["level"] > 0)).alias("nr", "p"))
              .groupBy("conv", "turn", "nr", F.col("p.level").alias("level"), F.md5(normalised(content)).alias("hash"))
              .agg(F.min(content).alias("content")).withColumn("run", F.md5("content")).checkpoint())
    found = _originals(parsed, "conv", "turn")
    linked = _nearest(quotes, found, "hash", "near", "far").checkpoint()
    lines = F.filter(F.split("content", "\n"), lambda x: normalised(x) != "")
    apart = linked.filter(F.col("near").isNull() & (F.size(lines) > 1)).select("run", "content").distinct()
    if apart.isEmpty():
        linked = linked.withColumns({"near_parts": F.lit(None).cast(linked.schema["near"].dataType), "far_parts": F.lit(None).cast(linked.schema["far"].dataType)})
    else:
        linked = _nearest(linked, _part_holders(apart, found), "run", "near_parts", "far_parts")
    # the shallowest linked quote comes first; quotes of the own conversation before others
    near, far = F.coalesce("near", "near_parts"), F.coalesce("far", "far_parts")
    best = F.when(near.isNotNull(), F.struct(F.lit(0).alias("far"), "level", "nr", F.col("conv").alias("c"), near.alias("t"))).when(
        far.isNotNull(), F.struct(F.lit(1).alias("far"), "level", "nr", far["conv"].alias("c"), far["turn"].alias("t")))
    per = linked.groupBy("conv", "turn").agg(F.count("nr").alias("n_all"), F.count(best).alias("n_linked"), F.min(best).alias("best")).checkpoint()
    replies = per.filter("best.far = 0").select("conv", "turn", F.col("best.t").alias("to"))
    roots = replies if replies.isEmpty() else _threads(replies)
    per = per.withColumnsRenamed({"conv": "pc", "turn": "pt"})
    roots = roots.withColumnsRenamed({"conv": "rc", "turn": "rt"})
    out = parsed.withColumn("n_quotes", F.size(F.filter("passages", lambda p: p["level"] > 0)))
    out = out.join(per, out["conv"].eqNullSafe(per["pc"]) & (out["turn"] == per["pt"]), "left")
    out = out.join(roots, out["conv"].eqNullSafe(roots["rc"]) & (out["turn"] == roots["rt"]), "left")
    out = out.select(
        "conv", "turn", "role", "body", "n_quotes", F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        F.col("best.c").alias("quoted_conv"), F.col("best.t").alias("quoted_turn"),
        F.when(F.col("best.far") == 0, F.col("best.t")).alias("reply_to"), F.coalesce("to", "turn").alias("thread"))
    keys = [F.col("conv").asc_nulls_first(), F.col("thread").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("body")]
    ranked = global_rank(out, keys, "rank")
    firsts = ranked.groupBy("conv").agg(F.min("rank").alias("base")).withColumnRenamed("conv", "fc")
    ranked = ranked.join(firsts, ranked["conv"].eqNullSafe(firsts["fc"]))
    return ranked.select(F.col("conv").alias(conv), F.col("turn").alias(turn), F.col("role").alias(role), "body", "n_quotes", "n_linked",
                         "quoted_conv", "quoted_turn", "reply_to", "thread", (F.col("rank") - F.col("base") + 1).alias("place"))
