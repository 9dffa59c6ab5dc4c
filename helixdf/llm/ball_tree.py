"""Ranked lexical search: exact inner-product search in sparse ball trees.

A document's vector holds an integer weight for each term it shares with a query, and a
score is the inner product with the query's integer term weights (below 2^53, so sums are
exact). Queries go in blocks; per block:

1. One pass over the texts gives the corpus counts and, per document, the block's terms in
   it with their counts.
2. Documents are range-partitioned by their two heaviest terms, so that neighbours are
   alike, and every ``CHUNK`` of them becomes a ball tree: a node is split between two far
   documents, and has a centroid and a radius around all its documents.
3. A query visits the nodes of a tree best first. By Cauchy and Schwarz no document of a
   node scores more than <query, centroid> + |query| * radius, where the query's length is
   that of its terms in the node; terms are scaled by the root of their weight on both
   sides, which keeps the product and tightens the bound. The
   bound is raised by more than its rounding error, and a subtree is left out only if it is
   less than the score of the last place so far. Leaves are scored in integers.
4. A search over a hashed part of the documents (``1 / PART``) comes first. Its last places
   are scores that the whole corpus reaches too, so the full search starts from them; they
   only save work. What the tasks find is ranked once more.

Defined cases: a null text has no term; documents and queries without terms are not found
and find nothing; repeated documents are all ranked, equal scores by ascending id (null
first); each row of the queries is one query; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored
from .shingles import text_bytes

TOP = 50
#: Queries of a block, and bytes of their texts.
BLOCK = 1024
BLOCK_BYTES = 8 << 20
#: Documents of a tree and of a leaf.
CHUNK = 4096
LEAF = 64
PART = 64
#: Bounds are raised by this part of what they are made of (float64 errs by less than 1e-12).
SAFE = 1e-9

#: Bytes of terms: ASCII letters (A-Z lower-cased), digits and all of non-ASCII characters.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def term_weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def values(tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's integer weight in documents of that length."""
    m = 100 - 50 + (50 * length * n_docs) // max(n_terms, 1)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


_COUNTED = "doc_id long, h long, n long, docs long, terms array<int>, tfs array<long>"


def _lists(rows: list, kind) -> pa.Array:
    at = np.cumsum([0] + [len(r) for r in rows]).astype(np.int32)
    flat = np.fromiter((x for r in rows for x in r), dtype=np.int64, count=int(at[-1]))
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat).cast(kind))


def _counted(vocabulary):
    """A row per document that holds a term of the block (docs 0); and a row per task (docs 1
    and more, or no text at all) with its documents, their lengths and the terms' documents."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        df, n_docs, n_terms = np.zeros(len(number), dtype=np.int64), 0, 0
        for batch in batches:
            at, sizes, rows, counts = [], [], [], []
            for k, t in enumerate(text_bytes(batch.column(2))):
                words = terms_of(t)
                if not words:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(words)
                own = Counter(words)
                hit = own.keys() & number.keys()
                if hit:
                    ids = [number[w] for w in hit]
                    df[ids] += 1
                    at.append(k)
                    sizes.append(len(words))
                    rows.append(ids)
                    counts.append([own[w] for w in hit])
            some = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(sizes, pa.int64()), pa.array(np.zeros(len(at), dtype=np.int64)), _lists(rows, pa.int32()), _lists(counts, pa.int64())],
                                             ["doc_id", "h", "n", "docs", "terms", "tfs"])
        if n_docs:
            hit = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([n_terms], pa.int64()), pa.array([n_docs], pa.int64()), _lists([hit.tolist()], pa.int32()), _lists([df[hit].tolist()], pa.int64())],
                                             ["doc_id", "h", "n", "docs", "terms", "tfs"])
    return each


class Block:
    """A block's queries: terms of each, weights of terms, corpus counts."""

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int):
        self.terms, self.weights, self.n_docs, self.n_terms = terms, weights, n_docs, n_terms
        self.root = np.sqrt(weights.astype(np.float64))

    def vectors(self, batch: pa.RecordBatch):
        """Begin, terms and values of a batch's documents."""
        lists = batch.column(batch.schema.get_field_index("terms"))
        at, idx = lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()
        tf = batch.column(batch.schema.get_field_index("tfs")).values.to_numpy()
        idx, tf, at = idx[at[0]:at[-1]], tf[at[0]:at[-1]], at - at[0]
        n = batch.column(batch.schema.get_field_index("n")).to_numpy()
        return at, idx, values(tf, np.repeat(n, np.diff(at)), self.n_docs, self.n_terms)


def _keyed(block):
    """Adds the two terms that weigh most in a document."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        for batch in batches:
            if not len(batch):
                continue
            at, idx, x = b.vectors(batch)
            row = np.repeat(np.arange(len(at) - 1), np.diff(at))
            order = np.lexsort((-x * b.weights[idx], row))  # a document's terms, heaviest first
            first = idx[order[at[:-1]]]
            second = np.where(np.diff(at) > 1, idx[order[np.minimum(at[:-1] + 1, len(order) - 1)]], -1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int32()), pa.array(second, pa.int32())], [*batch.schema.names, "k1", "k2"])
    return each


class Tree:
    """A ball tree over documents: begin, terms and values of their vectors."""

    def __init__(self, at: np.ndarray, idx: np.ndarray, x: np.ndarray, block: Block, leaf: int = LEAF):
        self.low, self.high, self.kids, self.centre, self.radius = [], [], [], [], []
        self.width = len(block.weights)
        y = x * block.root[idx]
        size = np.diff(at)
        square = self._sums(y * y, at)
        self.order = np.arange(len(size))
        self._grow(0, self.order.copy(), size, at, idx, y, square, leaf)
        # the vectors in the order of the leaves
        size = size[self.order]
        self.at = np.concatenate(([0], np.cumsum(size)))
        take = np.repeat(at[self.order] - self.at[:-1], size) + np.arange(self.at[-1])
        self.idx, self.x = idx[take], x[take]
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    @staticmethod
    def _sums(v: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(v)))
        return total[at[1:]] - total[at[:-1]] if len(v) == 0 else np.add.reduceat(v, at[:-1])

    def _grow(self, low, docs, size, at, idx, y, square, leaf) -> int:
        """Node over ``docs`` (numbers; the arrays are theirs), which come to stand from ``low`` on."""
        node = len(self.low)
        centre = np.bincount(idx, weights=y, minlength=self.width) / len(docs)
        c2 = float(centre @ centre)
        far = np.maximum(square - 2 * self._sums(y * centre[idx], at) + c2, 0.0)
        self.low.append(low)
        self.high.append(low + len(docs))
        self.centre.append(centre)
        self.radius.append(float(np.sqrt((far + SAFE * (square + c2)).max())) * (1 + SAFE))
        self.kids.append(())
        if len(docs) <= leaf:
            self.order[low:low + len(docs)] = docs
            return node

        def distances(k: int) -> np.ndarray:
            one = np.zeros(self.width)
            one[idx[at[k]:at[k + 1]]] = y[at[k]:at[k + 1]]
            return square + square[k] - 2 * self._sums(y * one[idx], at)

        from_a = distances(int(far.argmax()))
        gap = from_a - distances(int(from_a.argmax()))
        # halves by which of the two far documents is nearer
        rank = np.argsort(gap, kind="stable")
        near = int((gap < 0).sum())
        cut = min(max(near, len(docs) // 8, 1), len(docs) - max(len(docs) // 8, 1))
        kids, begin = [], low
        for part in (np.sort(rank[:cut]), np.sort(rank[cut:])):
            s = size[part]
            to = np.concatenate(([0], np.cumsum(s)))
            take = np.repeat(at[part] - to[:-1], s) + np.arange(to[-1])
            kids.append(self._grow(begin, docs[part], s, to, idx[take], y[take], square[part], leaf))
            begin += len(part)
        self.kids[node] = tuple(kids)
        return node

    def bounds(self, terms: np.ndarray, root: np.ndarray) -> np.ndarray:
        """No document of a node scores more against a query of these terms. Only those that a
        document of the node holds (its centroid is above 0 there) count for the query's length."""
        q, centre = root[terms], self.centre[:, terms]
        most = centre @ q + np.sqrt((centre > 0) @ (q * q)) * self.radius
        return most + SAFE * most + 1

    def search(self, terms: np.ndarray, block: Block, weight: np.ndarray, found: "Found") -> int:
        """Adds the best documents to ``found``; returns how many leaves were scored.
        ``weight`` holds the query's term weights and zeros."""
        bound = self.bounds(terms, block.root)
        heap, scored = [(-bound[0], 0)], 0
        while heap:
            best, node = heapq.heappop(heap)
            if -best < found.least:
                break
            if self.kids[node]:
                for k in self.kids[node]:
                    if bound[k] >= found.least:
                        heapq.heappush(heap, (-bound[k], k))
                continue
            scored += 1
            low, high = self.low[node], self.high[node]
            a, b = self.at[low], self.at[high]
            score = np.add.reduceat(self.x[a:b] * weight[self.idx[a:b]], self.at[low:high] - a)
            good = score >= found.least
            if good.any():
                found.add(score[good], self.order[low:high][good])
        return scored


class Found:
    """The best documents of a query so far: score, whether the id is given, id."""

    def __init__(self, top: int, least: int):
        self.top, self.floor = top, max(int(least), 1)
        self.least = self.floor
        self.score = self.has = self.doc = np.zeros(0, dtype=np.int64)
        self.ids: tuple = ()

    def add(self, score: np.ndarray, rows: np.ndarray) -> None:
        has, doc = self.ids
        score, has, doc = np.concatenate((self.score, score)), np.concatenate((self.has, has[rows])), np.concatenate((self.doc, doc[rows]))
        o = np.lexsort((doc, has, -score))[:self.top]
        self.score, self.has, self.doc = score[o], has[o], doc[o]
        if len(o) == self.top:
            self.least = max(self.floor, int(self.score[-1]))


def _searched(block, floors: dict[int, int], top: int):
    """The best documents of each query among the task's own."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block.value
        found = [Found(top, floors.get(i, 1)) for i in range(len(b.terms))]
        weight = np.zeros(len(b.weights), dtype=np.int64)
        for whole in batches:
            for low in range(0, len(whole), CHUNK):
                batch = whole.slice(low, CHUNK)
                ids = batch.column(batch.schema.get_field_index("doc_id"))
                own = (np.asarray(ids.is_valid()).astype(np.int64), ids.fill_null(0).to_numpy())
                tree = Tree(*b.vectors(batch), b)
                for f, terms in zip(found, b.terms):
                    if len(terms):
                        f.ids = own
                        weight[terms] = b.weights[terms]
                        tree.search(terms, b, weight, f)
                        weight[terms] = 0
        for i, f in enumerate(found):
            if len(f.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f.score), i, dtype=np.int64)), pa.array(f.doc, mask=f.has == 0), pa.array(f.score)], ["query", "doc_id", "score"])
    return each


def _ranked(found: DataFrame, top: int) -> DataFrame:
    place = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)


def _search_block(docs: DataFrame, texts: list[bytes], top: int) -> DataFrame:
    """query (number in ``texts``), doc_id, score, rank."""
    sc = docs.sparkSession.sparkContext
    words = [sorted(set(terms_of(t))) for t in texts]
    number = {w: i for i, w in enumerate(sorted({w for own in words for w in own}))}
    counted = stored(docs.mapInArrow(_counted(sc.broadcast(number)), _COUNTED), "counted")
    sums = counted.filter("docs > 0")
    n_docs, n_terms = sums.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    each = sums.select(F.explode(F.arrays_zip("terms", "tfs")).alias("x")).groupBy("x.terms").agg(F.sum("x.tfs").alias("df"))
    df = np.zeros(len(number), dtype=np.int64)  # a number per term of the block
    for r in each.toLocalIterator():
        df[r[0]] = r[1]
    weights = np.array([term_weight(n_docs, int(d)) for d in df], dtype=np.int64)
    block = sc.broadcast(Block([np.array([number[w] for w in own], dtype=np.int64) for own in words], weights, n_docs, n_terms))

    vectors = counted.filter("docs = 0")

    def search(rows: DataFrame, floors: dict[int, int]) -> DataFrame:
        keyed = rows.mapInArrow(_keyed(block), _COUNTED + ", k1 int, k2 int")
        alike = keyed.repartitionByRange("k1", "k2", "h").sortWithinPartitions("k1", "k2", "h")
        return _ranked(alike.mapInArrow(_searched(block, floors, top), "query long, doc_id long, score long"), top)

    last = search(vectors.filter(F.pmod(F.xxhash64("h"), F.lit(PART)) == 0), {}).filter(F.col("rank") == top)
    floors = {r["query"]: r["score"] for r in last.select("query", "score").collect()}  # a number per query of the block
    return search(vectors, floors)


def _blocks(items: DataFrame, block: int) -> Iterator[list]:
    own, size = [], 0
    for r in items.toLocalIterator():
        if own and (len(own) == block or size > BLOCK_BYTES):
            yield own
            own, size = [], 0
        own.append(r)
        size += len(r[1] or "")
    if own:
        yield own


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """Each item's ``top`` documents of highest score above 0: item_id, rank, doc_id, score."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(doc_id, text).alias("h"), F.col(text).alias("text"))
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for own in _blocks(items.select(item_id, item_text), block):
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(own)], f"number long, item_id {kind}")
        found = _search_block(rows, [b"" if r[1] is None else r[1].encode("utf-8", "surrogatepass") for r in own], top)
        found = found.join(F.broadcast(names), F.col("query") == F.col("number"))
        out = out.unionByName(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out
