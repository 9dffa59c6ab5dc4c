"""Exact Jaccard join of documents on word n-grams, by vertical partitioning.

The n-grams have one global order: rare ones by hash, then the frequent ones (a
bounded list of the highest counts that tasks see), so that a document's leading
n-grams are its rarest. A pair with similarity t or more shares one of the leading
(1 - t) * size + 1 n-grams of both. This part of the order is cut into fragments
(Spark partitions, by n-gram); each fragment counts its own part of the overlap of
the pairs that meet in it, and the parts are summed per pair. A pair stays if its
sum plus the largest possible rest reaches the needed overlap; then the remaining
fragments of its two sets are counted as well, and the sums decide.

N-grams that many documents lead with don't make pairs. Their documents are put
together by the least one that shares such an n-gram, and groups are compared block by block
(``BLOCK`` documents each) in inverted lists, giving a spanning forest of links and not
all links. Documents with equal sets are one class throughout.

The list of frequent n-grams only orders; any list gives the same links.

Defined cases: a text with fewer words than n is one n-gram; a text without words
or a null text has no set and links to nothing; repeated ids keep all their rows;
rows with equal sets link; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sieve, sifted, stored, with_fields
from .shingles import SIZE, shingle_chunks, text_bytes

PERCENT = 75
#: At most so many frequent n-grams order last (8 bytes each are broadcast).
FREQUENT = 1 << 18
#: A task reports an n-gram that so many of its classes share.
REPORT = 6
#: Groups of an n-gram up to this size count pairs directly.
SMALL = 24
BLOCK = 1024
#: N-grams of a block's sets together.
BLOCK_GRAMS = 1 << 19
#: Bytes of sets that a task hands on at once.
YIELD_BYTES = 8 << 20
#: Classes that a task remembers, and n-grams that it counts together.
SEEN = 200_000
HELD = 1_000_000
#: Pairs that a fragment counts together.
PAIRS = 200_000
#: Sets up to this size tell 16 bits of an n-gram before they are compared, larger ones 32.
NARROW = 4096
#: Fragments in which the sets of a candidate pair are counted.
FRAGMENTS = 8


def class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def lead(n: int, percent: int = PERCENT) -> int:
    """How many leading n-grams of a set of n one has to share."""
    return n - -(-percent * n // 100) + 1


def needed(a, b, percent: int = PERCENT):
    """Least overlap of sets of sizes a and b at that similarity."""
    return -(-percent * (a + b) // (100 + percent))


def _described(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A row per document (class, set size), and rows for n-grams that classes of the task share."""
    seen: set[int] = set()
    held: list[np.ndarray] = []
    n_held = 0

    def shared():
        grams, n = np.unique(np.concatenate(held), return_counts=True)
        held.clear()
        many = n >= REPORT
        grams, n = grams[many].view(np.int64), n[many]
        return pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(len(grams), dtype=bool)), "rid": pa.nulls(len(grams), pa.int64()), "cls": pa.array(grams), "n": pa.array(n, pa.int64())})

    for batch in batches:
        for low, sets in shingle_chunks(text_bytes(batch.column(1)), size):
            ids = [class_of(s) for s in sets]
            for c, s in zip(ids, sets):
                if len(s) and c not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()  # a class may be told again: its n-grams only seem more frequent
                    seen.add(c)
                    held.append(s)
                    n_held += len(s)
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.ones(len(ids), dtype=bool)), "rid": batch.column(0).slice(low, len(ids)), "cls": pa.array(ids, pa.int64()), "n": pa.array([len(s) for s in sets], pa.int64())})
            if n_held > HELD:
                yield shared()
                n_held = 0
    if held:
        yield shared()


def _ordered(s: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, int]:
    """A set in the global order, and how many of it are rare."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
        often = frequent[at] == s
        if often.any():
            return np.concatenate((s[~often], s[often])), int(len(s) - often.sum())
    return s, len(s)


def _leading(frequent, size: int, percent: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        many = frequent.value
        for batch in batches:
            for _, sets in shingle_chunks(text_bytes(batch.column(0)), size):
                grams, classes, sizes, often = [], [], [], []
                for s in sets:
                    if not len(s) or (c := class_of(s)) in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()  # a class may come again: equal rows of a fragment count once
                    seen.add(c)
                    o, rare = _ordered(s, many)
                    k = lead(len(s), percent)
                    grams.append(o[:k])
                    classes.append(np.full(k, c, dtype=np.int64))
                    sizes.append(np.full(k, len(s), dtype=np.int32))
                    often.append(np.arange(k) >= rare)
                if grams:
                    yield pa.RecordBatch.from_pydict({
                        "gram": pa.array(np.concatenate(grams).view(np.int64)), "cls": pa.array(np.concatenate(classes)),
                        "n": pa.array(np.concatenate(sizes)), "often": pa.array(np.concatenate(often))})
    return each


def _fragment(batches: Iterator[pa.RecordBatch], small: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Of n-grams in order: pairs (a < b) of small groups with the overlap counted here, and
    the members of large groups (kind 1: n-gram, class, size). Frequent n-grams are dealt
    over many tasks and pass through as members."""
    pairs: list[tuple[np.ndarray, ...]] = []
    held = 0
    rest: tuple = ()

    def flush():
        nonlocal held
        if any(len(x[0]) for x in pairs):
            a, b, na, nb = (np.concatenate(x) for x in zip(*pairs))
            o = np.lexsort((b, a))
            a, b, na, nb = a[o], b[o], na[o], nb[o]
            first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            common = np.diff(np.append(first, len(a)))
            yield pa.RecordBatch.from_pydict({"kind": pa.array(np.zeros(len(first), dtype=np.int32)), "a": pa.array(a[first]), "b": pa.array(b[first]),
                                              "na": pa.array(na[first]), "nb": pa.array(nb[first]), "common": pa.array(common)})
        pairs.clear()
        held = 0

    def member(g, c, n):
        none, n = pa.array(np.zeros(len(c), dtype=np.int64)), pa.array(n.astype(np.int64))
        return pa.RecordBatch.from_pydict({"kind": pa.array(np.ones(len(c), dtype=np.int32)), "a": pa.array(g), "b": pa.array(c), "na": n, "nb": none, "common": none})

    def groups(g, c, n):
        nonlocal held
        o = np.lexsort((c, g))
        g, c, n = g[o], c[o], n[o].astype(np.int64)
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])))  # a class counts once
        g, c, n = g[new], c[new], n[new]
        edge = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1], [True])))
        first, length = edge[:-1], np.diff(edge)
        large = np.repeat(length > small, length)
        if large.any():
            yield member(g[large], c[large], n[large])
        for k in range(2, small + 1):  # all groups of k classes at once
            at = first[length == k]
            if not len(at):
                continue
            who = at[:, None] + np.arange(k)
            i, j = np.triu_indices(k, 1)
            a, b = who[:, i].ravel(), who[:, j].ravel()
            near = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
            a, b = a[near], b[near]
            pairs.append((c[a], c[b], n[a], n[b]))
            held += len(a) + who.size
            if held > PAIRS:
                yield from flush()

    for batch in batches:
        g, c, n, often = (x.to_numpy(zero_copy_only=False) for x in batch.columns)
        if often.any():
            yield member(g[often], c[often], n[often])
            g, c, n = g[~often], c[~often], n[~often]
        if rest:
            g, c, n = (np.concatenate(x) for x in zip(rest, (g, c, n)))
        last = int(np.searchsorted(g, g[-1])) if len(g) else 0  # the last n-gram may go on
        rest = (g[last:], c[last:], n[last:])
        if last:
            yield from groups(g[:last], c[:last], n[:last])
    if rest and len(rest[0]):
        yield from groups(*rest)
    yield from flush()


def _lists(grams: np.ndarray, owner: np.ndarray, n: int):
    """Inverted lists of the n-grams that two or more sets hold: the owners in order, each
    list's begin and length, and the lists of every set."""
    by = np.argsort(grams, kind="stable")
    grams, owner = grams[by], owner[by]
    edge = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1], [True])))
    first, length = edge[:-1], np.diff(edge)
    first, length = first[length > 1], length[length > 1]
    flat = np.repeat(np.arange(len(first)), length)
    who = owner[np.repeat(first - np.cumsum(length) + length, length) + np.arange(len(flat))]
    o = np.argsort(who, kind="stable")
    cut = np.searchsorted(who[o], np.arange(n + 1))
    return owner, first, length, [flat[o[cut[x]:cut[x + 1]]] for x in range(n)]


def _overlaps(lists, owner, first, length, n: int) -> np.ndarray:
    """How many of these lists hold each set."""
    ln = length[lists]
    return np.bincount(owner[np.repeat(first[lists] - np.cumsum(ln) + ln, ln) + np.arange(int(ln.sum()))], minlength=n)


def _possible(percent: int):
    def each(key, table):
        """Members of a block pair with a partner whose shared leading n-grams of large groups
        allow a link. Pairs that share others too are among those of small groups."""
        i, j = key[1].as_py(), key[2].as_py()
        cls, block, n = (table.column(c).to_numpy() for c in ("cls", "block", "n"))
        held = table.column("grams").combine_chunks()
        at, grams = held.offsets.to_numpy(), held.values.to_numpy()
        owner, first, length, lists = _lists(grams[at[0]:at[-1]], np.repeat(np.arange(len(cls)), np.diff(at)), len(cls))
        rest = -(-percent * n // 100) - 1
        alive = np.zeros(len(cls), dtype=bool)
        for x in range(len(cls)) if i == j else np.flatnonzero(block == i):
            common = _overlaps(lists[x], owner, first, length, len(cls))
            ok = (common > 0) & (common + np.maximum(rest, rest[x]) >= needed(n, n[x], percent))
            ok &= (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])) & (cls != cls[x])
            if i != j:
                ok &= block == j
            if ok.any():
                alive |= ok
                alive[x] = True
        return pa.table({"hub": pa.array(np.full(int(alive.sum()), key[0].as_py(), dtype=np.int64)), "cls": pa.array(cls[alive]), "n": pa.array(n[alive].astype(np.int64))})
    return each


def _compare(percent: int):
    def each(key, table):
        """Links within a block, or across two blocks: a spanning forest of them."""
        i, j = key[1].as_py(), key[2].as_py()
        cls, kept = np.unique(table.column("cls").to_numpy(), return_index=True)
        block = table.column("block").to_numpy()[kept]
        sets = [np.asarray(table.column("grams")[int(k)].values).view(np.uint64) for k in kept]
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        owner, first, length, lists = _lists(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets))
        parent = list(range(len(sets)))

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links, apart = [], len(sets)
        rows = range(len(sets)) if i == j else np.flatnonzero(block == i).tolist()
        # the fullest lists first: their holder joins most of the group at once
        for x in sorted(rows, key=lambda r: -int(length[lists[r]].sum())):
            if apart == 1:
                break
            # the overlap is the sum over fragments of the order
            common = sum(_overlaps(part, owner, first, length, len(sets)) for part in np.array_split(lists[x], FRAGMENTS))
            ok = 100 * common >= percent * (sizes + sizes[x] - common)
            ok[x] = False
            if i != j:
                ok &= block == j
            for y in np.flatnonzero(ok).tolist():
                a, b = find(x), find(y)
                if a != b:
                    parent[a] = b
                    apart -= 1
                    links.append((int(cls[x]), int(cls[y])))
        k = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(k[:, 0]), "b": pa.array(k[:, 1])})
    return each


def _bounded(percent: int):
    def each(key, table):
        """Members of a block pair with a partner that they can link with by the overlap of
        one fragment: 32 bits of its n-grams, so counts are never too low."""
        i, j = key[1].as_py(), key[2].as_py()
        cls, kept = np.unique(table.column("cls").to_numpy(), return_index=True)
        block, n = table.column("block").to_numpy()[kept], table.column("n").to_numpy()[kept]
        low, n_low = table.column("low"), table.column("n_low").to_numpy()[kept]
        low = [low[int(k)].as_py() for k in kept]
        wide = [len(x) == 4 * int(m) for x, m in zip(low, n_low)]
        least = np.uint32 if all(wide) else np.uint16  # bits that all of them have
        sets = [np.unique(np.frombuffer(x, dtype="<u4" if w else "<u2").astype(least)) for x, w in zip(low, wide)]
        size = np.array([len(s) for s in sets], dtype=np.int64)
        owner, first, length, lists = _lists(np.concatenate(sets), np.repeat(np.arange(len(sets)), size), len(sets))
        rest = n - n_low
        alive = np.zeros(len(cls), dtype=bool)
        for x in range(len(cls)) if i == j else np.flatnonzero(block == i):
            # equal bits may stand for several n-grams of a set; those count in full
            twice = (n - rest - size) + (n - rest - size)[x]
            common = _overlaps(lists[x], owner, first, length, len(cls)) + twice
            ok = common + np.minimum(rest, rest[x]) >= needed(n, n[x], percent)
            ok &= (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])) & (cls != cls[x])
            if i != j:
                ok &= block == j
            if ok.any():
                alive |= ok
                alive[x] = True
        return pa.table({"hub": pa.array(np.full(int(alive.sum()), key[0].as_py(), dtype=np.int64)), "cls": pa.array(cls[alive]), "n": pa.array(n[alive].astype(np.int64))})
    return each


_UNIT = "hub long, i int, j int, block int, cls long"


def _dealt(size: int, low: bool):
    """The sets of texts, a row for each unit that wants them: whole, or (``low``) 16 bits of the
    n-grams in the first half of the hash range (32 of a set over ``NARROW``), with both sizes."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        names = ["hub", "i", "j", "block", "cls"]

        def made(rows: list[tuple], sets: list[np.ndarray], sizes: list[tuple[int, int]]) -> pa.RecordBatch:
            out = [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)]
            if low:
                n, n_low = zip(*sizes)
                return pa.RecordBatch.from_arrays([*out, pa.array(n, pa.int64()), pa.array(n_low, pa.int64()), pa.array(sets, pa.binary())], [*names, "n", "n_low", "low"])
            return pa.RecordBatch.from_arrays([*out, pa.array(sets, pa.list_(pa.int64()))], [*names, "grams"])

        rows, sets, sizes, held = [], [], [], 0
        for batch in batches:
            classes, wanted = batch.column(0).to_pylist(), batch.column(2)
            for first, some in shingle_chunks(text_bytes(batch.column(1)), size):
                for k, s in enumerate(some, first):
                    if not len(s) or class_of(s) != classes[k]:
                        continue  # another row's text of that id
                    half = s[:int(np.searchsorted(s, np.uint64(1 << 63)))]
                    own = (half >> np.uint64(20)).astype("<u2" if len(s) <= NARROW else "<u4").tobytes() if low else s.view(np.int64)
                    for u in wanted[k].as_py():
                        rows.append((u["hub"], u["i"], u["j"], u["block"], classes[k]))
                        sets.append(own)
                        sizes.append((len(s), len(half)))
                        held += (len(own) if low else own.nbytes) + 64
                        if held > YIELD_BYTES:  # a class may go to many units
                            yield made(rows, sets, sizes)
                            rows, sets, sizes, held = [], [], [], 0
        if rows:
            yield made(rows, sets, sizes)
    return each


def _with_sets(rows: DataFrame, described: DataFrame, units: DataFrame, size: int, low: bool) -> DataFrame:
    """Units with the sets of their classes, each from the text of one row of the class. A sieve
    of those rows' ids keeps most other texts from being exchanged."""
    per = units.groupBy(F.col("cls").alias("of")).agg(F.collect_list(F.struct("hub", "i", "j", "block")).alias("units"))
    reps = described.filter("n > 0").groupBy("cls").agg(F.min("rid").alias("rep")).join(per, F.col("cls") == F.col("of"))
    rows = sifted(rows, F.col("rid"), sieve(reps, F.col("rep")))
    rows = rows.join(reps, F.col("rid").eqNullSafe(F.col("rep"))).select("cls", "text", "units")
    return rows.mapInArrow(_dealt(size, low), _UNIT + (", n long, n_low long, low binary" if low else ", grams array<long>"))


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node reachable by links (a, b), by alternating large and
    small stars; a hub's neighbours are only ever grouped by aggregates and joins."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct().checkpoint()
    mark = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.greatest("v", "m").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        new = small.filter("u != v").distinct().checkpoint()
        last, mark = mark, new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.col("v") % 1_000_033)).first()
        edges = new
        if mark == last:
            return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")


def _units(members: DataFrame, held: str = "n") -> DataFrame:
    """Members (hub, cls, and ``held`` n-grams) dealt to block pairs: every block of a hub meets each of its blocks once."""
    full = F.ceil(F.greatest(F.col("k") / BLOCK, F.col("grams") / BLOCK_GRAMS)).cast("int")
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("k"), F.sum(held).alias("grams")).filter("k > 1").select("hub", full.alias("blocks"))
    placed = members.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("cls", "hub"), F.col("blocks")).cast("int"))
    return placed.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls")


def _allowed(pairs: DataFrame, own: DataFrame, percent: int) -> DataFrame:
    """Pairs whose leading n-grams allow a link: those shared in small groups (``common``) and those of
    large groups that both hold, which are looked at only where they can decide."""
    rest = F.greatest(*[F.ceil(percent * F.col(c) / 100) - 1 for c in ("na", "nb")])
    lack = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent)) - rest - F.col("common")
    pairs = pairs.withColumn("lack", lack)
    more = pairs.filter("lack > 0")
    for c in ("a", "b"):
        more = more.join(own.select(F.col("cls").alias(c), F.col("grams").alias(f"of_{c}")), c).filter(F.size(f"of_{c}") >= F.col("lack"))
    more = more.filter(F.size(F.array_intersect("of_a", "of_b")) >= F.col("lack"))
    names = ["a", "b", "na", "nb"]
    return pairs.filter("lack <= 0").select(*names).union(more.select(*names))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT,
                    frequent: int = FREQUENT) -> DataFrame:
    """Every row's doc_id, cls (equal sets), root (class that stands for its group), n_shingles and component_id (the least doc_id
    that links lead to; its own without a set)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("rid"), F.col(text).alias("text"))
    seen = stored(rows.mapInArrow(lambda b: _described(b, size), "kind boolean, rid long, cls long, n long"), "described", drop=True)
    described = seen.filter("kind")
    often = seen.filter("not kind").groupBy("cls").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "cls").limit(frequent).select("cls").collect()
    top = np.sort(np.array([r[0] for r in often], dtype=np.int64).view(np.uint64))
    hint = spark.sparkContext.broadcast(top)

    leading = rows.select("text").mapInArrow(_leading(hint, size, percent), "gram long, cls long, n int, often boolean")
    # a rare one goes to its fragment; a frequent one is dealt over many tasks
    salt = F.when(F.col("often"), F.pmod("cls", F.lit(997))).otherwise(F.lit(-1))
    met = stored(leading.repartition(F.col("gram"), salt).sortWithinPartitions("gram")
                 .mapInArrow(lambda b: _fragment(b, SMALL, percent), "kind int, a long, b long, na long, nb long, common long"), "met", drop=True)
    large = met.filter("kind = 1").select(F.col("a").alias("gram"), F.col("b").alias("cls"), F.col("na").alias("n")).distinct()
    hubs = stored(large.groupBy("gram").agg(F.min("cls").alias("hub"), F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k"), "hubs", drop=True)
    led = stored(large.join(hubs, "gram"), "led", drop=True)
    own = stored(led.groupBy("cls").agg(F.first("n").alias("n"), F.collect_set("gram").alias("grams")), "own", drop=True)
    pairs = _allowed(met.filter("kind = 0").groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common")), own, percent)
    pairs = pairs.select(F.col("a").alias("hub"), F.explode(F.array(F.struct(F.col("a").alias("cls"), F.col("na").alias("n")), F.struct(F.col("b").alias("cls"), F.col("nb").alias("n")))).alias("m"))
    sizes = own.select("cls", F.size("grams").alias("held"))
    possible = (_units(led.select("hub", "cls", "n").distinct().join(sizes, "cls"), "held").join(own, "cls").groupBy("hub", "i", "j")
                .applyInArrow(_possible(percent), "hub long, cls long, n long"))
    members = stored(possible.union(pairs.select("hub", "m.cls", "m.n")).distinct(), "members", drop=True)
    # one fragment of the sets decides which members can link at all, then all fragments
    near = stored(_with_sets(rows, described, _units(members), size, True).groupBy("hub", "i", "j")
                  .applyInArrow(_bounded(percent), "hub long, cls long, n long").distinct(), "near", drop=True)
    links = stored(_with_sets(rows, described, _units(near), size, False).groupBy("hub", "i", "j").applyInArrow(_compare(percent), "a long, b long"),
                   "links", drop=True)
    found = components(links)
    roots = described.filter("n > 0").groupBy("cls").agg(F.min("rid").alias("least"))
    root = roots.join(found, roots["cls"] == found["node"], "left").select("cls", F.coalesce("root", "cls").alias("root"), "least")
    comp = root.groupBy("root").agg(F.min("least").alias("component"))
    comp = root.join(comp, "root").select("cls", "component", "root")
    return described.join(comp, "cls", "left").select(
        F.col("rid").alias("doc_id"), "cls", "root", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("rid")).alias("component_id"))


def _classed(size: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, sets in shingle_chunks(text_bytes(batch.column(batch.num_columns - 1)), size):
                cls = pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())
                rows = batch.slice(low, len(sets))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], cls], [*batch.schema.names[:-1], "__cls"])
    return each


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT,
             frequent: int = FREQUENT) -> DataFrame:
    """One row of each group of near copies: least id, then least class and columns. Rows
    without words all stay."""
    found = stored(near_duplicates(docs, doc_id, text, size, percent, frequent).filter("n_shingles > 0"), "found", drop=True)
    best = found.groupBy("root").agg(F.min(F.struct("doc_id", "cls")).alias("b"), F.count(F.lit(1)).alias("rows"))
    # most rows have no copy: their ids are not among those of groups of several rows, and they stay where they are
    several = sieve(found.join(best.filter("rows > 1").select("root"), "root", "left_semi"), F.col("doc_id"))
    rid = F.col(doc_id).cast("long")
    alone = sifted(docs, rid, several, "left_anti")
    marked = sifted(docs, rid, several).withColumn("__text", F.col(text))
    marked = marked.mapInArrow(_classed(size), with_fields(docs, "__cls long"))

    def keyed(i, c):
        return F.coalesce(i, F.lit(0)).alias("__i"), i.isNull().alias("__n"), c.alias("__c")

    rows = marked.filter("__cls is not null").select(F.struct(*[F.col(x) for x in docs.columns]).alias("__row"), *keyed(rid, F.col("__cls")))
    rows = rows.join(best.select(*keyed(F.col("b.doc_id"), F.col("b.cls"))), ["__i", "__n", "__c"], "left_semi")
    one = rows.groupBy("__i", "__n", "__c").agg(F.min("__row").alias("__row")).select("__row.*")
    return alone.union(one).union(marked.filter("__cls is null").select(*docs.columns))
