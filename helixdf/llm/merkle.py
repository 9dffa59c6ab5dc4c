"""Merkle manifest of a table with a proof for every row, by pointer jumping.

A row's leaf is the hash of its fields. Per group (source) the leaves stand in order of
their id, and runs of ``ARITY`` consecutive nodes are hashed to the node above them until
one is left, the group's subroot. The subroots, in order of the group, are the leaves of
one more tree of the same kind, and give the root.

Positions come from a range partition on (group, id, leaf) and prefix sums over the runs
of a group in a partition, so a group with most of the rows is spread over many tasks.
Each level is one aggregate of the level below it, a sixteenth of its rows.

A proof is the list of (left, right) sibling digests from the leaf up to the root. Every
inner node first holds the segment towards its parent. A self-join of that table then
gives each node its ancestor's segment as well, so the distance that segments cover
doubles, and after log2(height) joins all nodes reach the root. The sixteen leaves of a
run share the path of the node above them: it is joined to the run as a whole.

Hashes are lowercase hexadecimal sha256 of inputs concatenated, digests as text.

Defined cases: a null field is ``-``, any other its length in UTF-8 bytes, ``:`` and its
value, so nulls, empty texts and clashing values differ; null ids stand first, equal ids
are ordered by their leaves (equal rows have equal leaves); the null group is the first;
a group of one row has its leaf as subroot; an empty table gives an empty result. Other
columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Number of the tree over the groups; the trees of the groups count from 0.
TOP = -1
_STEP = "array<struct<left:string,right:string>>"


def digest(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """Hash of a row's fields, each with its length or as a null."""
    text = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(proof, leaf, lambda a, s: digest(F.concat(s["left"], a, s["right"])))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level and left to right, as one text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _placed(df: DataFrame, group: str | None, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` stored in order with ``__mid``, and per group and partition the first ``__mid``
    and how many rows of the group stand before (a row for each part of a group)."""
    keys = ([group] if group else []) + order
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__mid", F.monotonically_increasing_id())
    rows = stored(rows, "placed").withColumn("__part", F.shiftright("__mid", 33))
    by = ([F.col(group).alias("__group")] if group else []) + [F.col("__part").alias("__of")]
    runs = rows.groupBy(*by).agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__group") if group else Window.partitionBy()
    before = before.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)
    return rows, runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long")))


def _position() -> Column:
    return F.col("__before") + F.col("__mid") - F.col("__first")


def _kids(value: Sequence[str]) -> Column:
    """The members of a run in order: at most ``ARITY`` of them."""
    return F.array_sort(F.collect_list(F.struct((F.col("idx") % ARITY).cast("int").alias("k"), *value)))


def _joined(kids: Column, low, many, name: str) -> Column:
    return F.array_join(F.transform(F.slice(kids, low, many), lambda x: x[name]), "")


def _above(n: Column) -> Column:
    return F.call_function("div", n + (ARITY - 1), F.lit(ARITY))


def _id(tree: Column, level: Column, idx: Column) -> Column:
    return F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), idx.cast("long").alias("idx"))


def _parent(level: int) -> Column:
    """The node above a run: a subroot counts as a leaf of the tree over the groups."""
    inside = _id(F.col("tree"), F.lit(level + 1), F.col("up"))
    return F.when((F.col("tree") != TOP) & (_above(F.col("n")) == 1), _id(F.lit(TOP), F.lit(0), F.col("tree"))).otherwise(inside)


def _grown(nodes: DataFrame, level: int, most: int) -> tuple[list[DataFrame], list[DataFrame], int]:
    """From the nodes (tree, idx, n, digest) of a level with at most ``most`` of a tree up to
    the last nodes: segments towards parents, finished nodes, levels."""
    segments, ends, steps = [], [nodes.filter("n = 1")], 0
    while most > 1:
        runs = stored(nodes.filter("n > 1").groupBy("tree", F.call_function("div", F.col("idx"), F.lit(ARITY)).alias("up"))
                      .agg(F.first("n").alias("n"), _kids(["digest"]).alias("kids")), f"level{level}")
        kid = F.col("kids")
        own = runs.select("*", _parent(level).alias("anc"), F.posexplode("kids").alias("at", "kid"))
        segments.append(own.select(
            _id(F.col("tree"), F.lit(level), F.col("up") * ARITY + F.col("kid.k")).alias("x"), "anc",
            F.array(F.struct(_joined(kid, 1, F.col("at"), "digest").alias("left"), _joined(kid, F.col("at") + 2, ARITY, "digest").alias("right"))).alias("seg")))
        nodes = runs.select("tree", F.col("up").alias("idx"), _above(F.col("n")).alias("n"),
                            digest(F.array_join(F.transform("kids", lambda x: x["digest"]), "")).alias("digest"))
        ends.append(nodes.filter("n = 1"))
        level, most, steps = level + 1, -(-most // ARITY), steps + 1
    return segments, ends, steps


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _jumped(links: DataFrame, height: int) -> DataFrame:
    """(x, anc, seg) with segments towards parents, joined to itself until all end at the root."""
    reach = 1
    while reach < height:
        far = links.select(F.col("x").alias("mid"), F.col("anc").alias("far"), F.col("seg").alias("more"))
        links = links.join(far, F.col("anc") == F.col("mid"), "left").select(
            "x", F.coalesce("far", "anc").alias("anc"), F.concat("seg", F.coalesce("more", F.array().cast(_STEP))).alias("seg"))
        links = stored(links, f"reach{2 * reach}")
        reach *= 2
    return links


def prove(rows: DataFrame, doc_id: str = "doc_id", group: str = "source", leaf: str = "leaf", carry: Sequence[str] = ()) -> DataFrame:
    """Rows (doc_id, group, leaf and ``carry``) of leaves to doc_id, leaf, ``carry``, subroot,
    root and proof (left and right siblings, level by level)."""
    names = [f"__c{i}" for i in range(len(carry))]
    flat = rows.select(F.col(doc_id).alias("__id"), F.col(group).alias("__src"), F.col(leaf).alias("__leaf"), *[F.col(c).alias(n) for c, n in zip(carry, names)])
    # texts are read once: the splitters are taken from the stored leaves
    placed, runs = _placed(stored(flat, "leaves"), "__src", ["__id", "__leaf"])
    runs = stored(runs, "runs")
    groups = runs.groupBy("__group").agg(F.sum("__n").alias("n"))
    groups, parts = _placed(groups, None, ["__group"])
    groups = stored(groups.join(parts, F.col("__part") == F.col("__of")).select(F.col("__group").alias("g"), "n", _position().alias("tree")), "groups")
    n_groups, most = groups.agg(F.count(F.lit(1)), F.coalesce(F.max("n"), F.lit(0))).first()

    where = stored(runs.join(groups, F.col("__group").eqNullSafe(F.col("g"))).select("__group", "__of", "__first", "__before", "tree", "n"), "where")
    here = (F.col("__src").eqNullSafe(F.col("__group"))) & (F.col("__part") == F.col("__of"))
    leaves = placed.join(where, here).select("tree", "n", _position().alias("idx"), "__id", "__leaf", *names)
    families = stored(leaves.groupBy("tree", F.call_function("div", F.col("idx"), F.lit(ARITY)).alias("up"))
                      .agg(F.first("n").alias("n"), _kids(["__leaf", "__id", *names]).alias("kids")), "families")

    joined = F.array_join(F.transform("kids", lambda x: x["__leaf"]), "")
    first = families.select("tree", F.col("up").alias("idx"), _above(F.col("n")).alias("n"),
                            F.when(F.col("n") == 1, joined).otherwise(digest(joined)).alias("digest"))
    inner, ends, inside = _grown(first, 1, -(-most // ARITY))
    subroots = stored(_all(ends).select("tree", "digest"), "subroots")
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(n_groups).cast("long").alias("n"), "digest")
    outer, ends, over = _grown(top, 0, n_groups)
    last = _all(ends).select("digest").first()
    root = F.lit(last[0] if last else None).cast("string")

    links = inner + outer
    runs_up = families.select("*", F.when(F.col("n") == 1, _id(F.lit(TOP), F.lit(0), F.col("tree"))).otherwise(_parent(0)).alias("node"))
    if links:
        path = _jumped(stored(_all(links), "reach1"), inside + over).select("x", F.col("seg").alias("path"))
        runs_up = runs_up.join(path, F.col("node") == F.col("x"), "left")
    else:
        runs_up = runs_up.withColumn("path", F.lit(None).cast(_STEP))
    subroots = subroots.select(F.col("tree").alias("of"), F.col("digest").alias("subroot"))
    runs_up = runs_up.join(subroots, F.col("tree") == F.col("of"))

    each = runs_up.select("*", F.posexplode("kids").alias("at", "kid"))
    own = F.array(F.struct(_joined(F.col("kids"), 1, F.col("at"), "__leaf").alias("left"), _joined(F.col("kids"), F.col("at") + 2, ARITY, "__leaf").alias("right")))
    none = F.array().cast(_STEP)
    proof = F.concat(F.when(F.col("n") == 1, none).otherwise(own), F.coalesce("path", none))
    return each.select(F.col("kid.__id").alias("doc_id"), F.col("kid.__leaf").alias("leaf"), *[F.col(f"kid.{n}").alias(c) for c, n in zip(carry, names)],
                       "subroot", root.alias("root"), proof.alias("proof"))
