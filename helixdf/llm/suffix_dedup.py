"""Removal of long repeated byte strings with a sparse suffix array.

Every string of ``length`` bytes has one sampled suffix among its first ``SPREAD``
positions: the one whose next 32 bytes hash least. Equal strings choose equally,
so only sampled suffixes are compared. A sampled suffix stands for the strings that
choose it: its context is their common stretch (bytes before and after the suffix's
start), and its core the bytes that all of them hold.

1. Per text, sampled suffixes with hashes of core and context (numpy, one pass).
2. Cores that occur twice or more survive (a count with map-side combining). Where
   all contexts of a core are equal, all their strings repeat.
3. Contexts of other cores are reduced to one row each and cut from the texts. Sampled
   splitters range-partition these suffixes by their leading bytes; each bucket sorts
   its suffixes by multikey quicksort and compares runs with equal cores string by
   string. Runs longer than ``RUN`` are split by their further bytes, too; where such a
   run touches a bucket's end, it may go on in the next, and its strings are compared
   across the boundaries by a count per string.
4. Spans of repeated strings are united per text, and the rest of the text is kept.

Equality of strings is decided on 128 bits of two polynomial hashes with mixing.

Defined cases: null text is empty; texts under ``length`` bytes stay whole; equal rows
count as occurrences of each other; overlapping occurrences in one text count;
repeated ids keep all their rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, powers, stored, with_fields
from .shingles import chunks, text_bytes

LENGTH = 400
SPREAD = 256
GRAM = 32
#: Contexts in a bucket, about.
BUCKET = 6_000
#: Contexts with one core that stay in one bucket.
RUN = 40_000

_BASES = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25))
_CODES = [mix64(np.arange(1, 257, dtype=np.uint64) * b) for b in _BASES]
_TABLES: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}


def _tables(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    size = max(_TABLES, default=0)
    if size < n:
        _TABLES.clear()
        size = max(2 * n, 1 << 16)
        _TABLES[size] = [(powers(size, b), powers(size, np.uint64(pow(int(b), -1, 1 << 64)))) for b in _BASES]
    return _TABLES[size]


class Hashes:
    """Hashes of any stretch of bytes: prefix sums, divided by the power at its start."""

    def __init__(self, data: np.ndarray, which=(0, 1)):
        n = len(data)
        self.acc, self.inv = {}, {}
        for k in which:
            power, inverse = _tables(n + 1)[k]
            acc = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_CODES[k][data] * power[:n], out=acc[1:])
            self.acc[k], self.inv[k] = acc, inverse

    def of(self, low, high, k: int = 0) -> np.ndarray:
        return mix64((self.acc[k][high] - self.acc[k][low]) * self.inv[k][low])


def sampled(data: np.ndarray, hashes: Hashes, begin: np.ndarray, end: np.ndarray, length: int, spread: int):
    """Sampled suffixes of texts (byte ranges of ``data``): text, first string, strings, place."""
    n = len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < length:
        return none, none, none, none
    # hash in the high half, position in the low half: the least value is the leftmost least hash
    at = np.arange(n - GRAM + 1, dtype=np.uint64)
    key = (hashes.of(slice(0, n - GRAM + 1), slice(GRAM, n + 1)) & np.uint64(0xFFFFFFFF00000000)) | at
    width = 1
    while width < spread:  # minimum over twice the width (spread is a power of two)
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    pick = (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
    count = np.maximum(end - begin - length + 1, 0)
    text = np.repeat(np.arange(len(begin)), count)
    s = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    q = pick[s]
    new = np.concatenate(([True], (q[1:] != q[:-1]) | (text[1:] != text[:-1]))) if len(s) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(new)
    return text[first], s[first], np.diff(np.append(first, len(s))), q[first]


_SUFFIX = "rid long, start int, before int, n int, core long, c1 long, c2 long"


def _suffixes(length: int, spread: int):
    core = length - spread + 1

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, texts = batch.column(0).to_numpy(), text_bytes(batch.column(1))
            for low, high in chunks(texts, 1 << 20):
                data = np.frombuffer(b"".join(texts[low:high]), dtype=np.uint8)
                end = np.cumsum([len(t) for t in texts[low:high]])
                begin = end - [len(t) for t in texts[low:high]]
                h = Hashes(data)
                text, s, n, q = sampled(data, h, begin, end, length, spread)
                if not len(s):
                    continue
                # a context: strings s .. s+n-1, so bytes s .. s+n-1+length, and where the suffix begins
                mark = mix64(((q - s) * 65_536 + n).astype(np.uint64))
                last = s + n - 1 + length
                yield pa.RecordBatch.from_pydict({
                    "rid": rid[low + text], "start": (s - begin[text]).astype(np.int32), "before": (q - s).astype(np.int32), "n": n.astype(np.int32),
                    "core": h.of(q, q + core).view(np.int64), "c1": (h.of(s, last, 0) ^ mark).view(np.int64), "c2": (h.of(s, last, 1) + mark).view(np.int64)})
    return each


def multikey_quicksort(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte strings, and their zero-padded bytes: quicksort by one 8-byte key after
    another, each pass over the strings that are still equal."""
    width = -(-max(map(len, strings), default=1) // 8) * 8 or 8
    raw = np.zeros((len(strings), width), dtype=np.uint8)
    flat = np.frombuffer(b"".join(strings), dtype=np.uint8)
    size = np.array([len(x) for x in strings], dtype=np.int64)
    raw[np.repeat(np.arange(len(strings)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    keys = raw.view(">u8")
    order, group = np.arange(len(strings)), np.zeros(len(strings), dtype=np.int64)
    tied = np.arange(len(strings))  # places of the order that are in a group of two or more
    for d in range(width // 8):
        if not len(tied):
            break
        key = keys[order[tied], d].astype(np.uint64)
        o = np.lexsort((key, group[tied]))
        order[tied] = order[tied][o]
        g, key = group[tied], key[o]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (key[1:] != key[:-1])))
        group[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        alone = new & np.concatenate((new[1:], [True]))
        tied = tied[~alone]
    return order, raw


def _strings(stretch: list[bytes], n: list[int], before: list[int], length: int):
    """Of contexts: owner, place relative to the suffix and two hashes of every string."""
    data = np.frombuffer(b"".join(stretch), dtype=np.uint8)
    size = np.array([len(x) for x in stretch], dtype=np.int64)
    begin, n = np.cumsum(size) - size, np.asarray(n, dtype=np.int64)
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    h, low = Hashes(data), begin[owner] + place
    mark = mix64((place - np.asarray(before, dtype=np.int64)[owner] + 65_536).astype(np.uint64))
    return owner, place, h.of(low, low + length, 0) ^ mark, h.of(low, low + length, 1) + mark


def _bucket(length: int, spread: int):
    """Compares the suffixes of one bucket. Kind 0: strings of a context (low, high) that
    repeat; kind 1: a string of a run that is split between buckets and touches this one's
    end, to compare across buckets."""
    core = length - spread + 1

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [[] for _ in range(7)]
        for batch in batches:
            for c, x in zip(cols, batch.columns):
                c.extend(x.to_pylist())
        c1, c2, before, n, times, split, stretch = cols
        if not c1:
            return
        order, raw = multikey_quicksort([x[b:] for x, b in zip(stretch, before)])
        head = raw[order][:, :core]
        new = np.concatenate(([True], (head[1:] != head[:-1]).any(axis=1)))
        bounds = np.flatnonzero(np.append(new, True))
        c1, c2, times, before, n = (np.array(x, dtype=np.int64) for x in (c1, c2, times, before, n))
        begin = 0
        while begin < len(bounds) - 1:
            stop = begin + 1  # some runs at once, about 2,000 contexts
            while stop < len(bounds) - 1 and bounds[stop + 1] - bounds[begin] <= 2_000:
                stop += 1
            own = order[bounds[begin]:bounds[stop]]
            open_run = np.zeros(len(own), dtype=bool)
            for r, low, high in ((0, bounds[0], bounds[1]), (len(bounds) - 2, bounds[-2], bounds[-1])):
                if begin <= r < stop:
                    open_run[low - bounds[begin]:high - bounds[begin]] = np.array([split[k] for k in order[low:high]])
            # strings at one place before the suffix's start compare among themselves: a long
            # run goes in slices of places, so that memory stays bounded
            step = max(1, min(spread, 2_000 * spread // len(own)))
            for far in range(0, spread, step):
                first = np.maximum(before[own] - far - step + 1, 0)
                last = np.minimum(before[own] - far, n[own] - 1)
                some = np.flatnonzero(last >= first)
                k = own[some]
                first, count = first[some], (last - first + 1)[some]
                owner, place, h1, h2 = _strings([stretch[x][a:a + c - 1 + length] for x, a, c in zip(k, first.tolist(), count.tolist())], count, before[k] - first, length)
                place = place + first[owner]
                at_end = open_run[some][owner]
                if at_end.any():
                    w = k[owner][at_end]
                    yield _rows(1, c1[w], c2[w], place[at_end], place[at_end], h1[at_end], h2[at_end], times[w])
                yield from _repeated(c1[k], c2[k], times[k], owner, place, h1, h2, ~at_end)
            begin = stop
    return each


def _repeated(c1, c2, times, owner, place, h1, h2, take):
    owner, place, h1, h2 = owner[take], place[take], h1[take], h2[take]
    if not len(owner):
        return
    o = np.lexsort((h2, h1))
    a, b = h1[o], h2[o]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    total = np.add.reduceat(times[owner[o]], np.flatnonzero(new))[np.cumsum(new) - 1]
    twice = np.sort(o[total > 1])  # owners and places in order
    if not len(twice):
        return
    w, p = owner[twice], place[twice]
    start = np.concatenate(([True], (w[1:] != w[:-1]) | (p[1:] != p[:-1] + 1)))
    first = np.flatnonzero(start)
    last = np.append(first[1:], len(w)) - 1
    k = w[first]
    zero = np.zeros(len(k), dtype=np.int64)
    yield _rows(0, c1[k], c2[k], p[first], p[last], zero.astype(np.uint64), zero.astype(np.uint64), zero)


def _rows(kind, c1, c2, low, high, h1, h2, times):
    return pa.RecordBatch.from_pydict({"kind": pa.array(np.full(len(c1), kind, dtype=np.int32)), "c1": c1, "c2": c2, "low": low.astype(np.int32), "high": high.astype(np.int32),
                                       "h1": h1.view(np.int64), "h2": h2.view(np.int64), "times": times.astype(np.int64)})


def _cut(length: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t, own in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist()):
                rows += [(x["c1"], x["c2"], x["before"], x["n"], x["times"], x["split"], t[x["start"]:x["start"] + x["n"] - 1 + length]) for x in own]
            cols = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["c1", "c2", "before", "n", "times", "split", "stretch"])
    return each


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds n_bytes, n_removed, spans and kept (bytes) from a last column of spans."""
    for batch in batches:
        n_bytes, n_removed, spans, kept = [], [], [], []
        text_at = batch.schema.get_field_index("__text")
        for t, own in zip(text_bytes(batch.column(text_at)), batch.column(batch.num_columns - 1).to_pylist()):
            out: list[list[int]] = []
            for low, high in sorted((x["low"], x["high"]) for x in own or ()):
                if out and low <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], high)
                else:
                    out.append([low, high])
            parts, at = [], 0
            for low, high in out:
                parts.append(t[at:low])
                at = high
            parts.append(t[at:])
            n_bytes.append(len(t))
            n_removed.append(sum(b - a for a, b in out))
            spans.append([{"low": a, "high": b} for a, b in out])
            kept.append(b"".join(parts))
        kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        names = batch.schema.names
        old = [c for c, name in zip(batch.columns, names) if name not in ("__text", "__spans")]
        yield pa.RecordBatch.from_arrays([*old, pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                                         [*(x for x in names if x not in ("__text", "__spans")), "n_bytes", "n_removed", "spans", "kept"])


def repeated_spans(rows: DataFrame, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """``rows``: rid, text. Byte ranges (rid, low, high) covered by strings that start twice or more."""
    suffixes = rows.select("rid", "text").mapInArrow(_suffixes(length, spread), _SUFFIX)
    cores = suffixes.groupBy("core").agg(F.min("c1").alias("x1"), F.max("c1").alias("y1"), F.min("c2").alias("x2"), F.max("c2").alias("y2"), F.count(F.lit(1)).alias("k"))
    cores = cores.filter("k > 1").select(F.col("core").alias("same"), ((F.col("x1") == F.col("y1")) & (F.col("x2") == F.col("y2"))).alias("equal"))
    cores = stored(cores, "cores")  # so that the join below has two plain sides and a hot core can be split
    alive = stored(suffixes.join(cores, F.col("core") == F.col("same")).drop("same"), "suffixes")
    mixed = alive.filter("not equal")
    contexts = mixed.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("times"), F.first("core").alias("core"), F.min(F.struct("rid", "start", "before", "n")).alias("r"))
    contexts = stored(contexts.select("c1", "c2", "core", "times", "r.*"), "contexts")
    # runs longer than a bucket may be split between buckets, shorter ones are not
    long_runs = contexts.groupBy(F.col("core").alias("hot")).count().filter(F.col("count") > RUN).select("hot")
    long_runs = stored(long_runs, "long_runs")  # at most one row per RUN contexts, so contexts are not dealt by core, where one may hold most
    contexts = stored(contexts.join(long_runs, F.col("core") == F.col("hot"), "left").withColumn("split", F.col("hot").isNotNull()).drop("hot"), "contexts")
    by_text = contexts.groupBy(F.col("rid").alias("of")).agg(F.collect_list(F.struct("c1", "c2", "start", "before", "n", "times", "split")).alias("own"))
    cut = (rows.join(by_text, F.col("rid") == F.col("of")).select("text", "own")
           .mapInArrow(_cut(length), "c1 long, c2 long, before int, n int, times long, split boolean, stretch binary").dropDuplicates(["c1", "c2"]))
    core_bytes = length - spread + 1
    lead = [F.expr(f"substring(stretch, before + 1, {core_bytes})"), F.when(F.col("split"), F.expr(f"substring(stretch, before + {core_bytes + 1})")), F.when(F.col("split"), F.col("c1"))]
    # buckets of bounded size: the number of splitters follows the number of contexts
    buckets = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), contexts.count() // BUCKET + 1)
    told = stored(cut.repartitionByRange(buckets, *lead).mapInArrow(
        _bucket(length, spread), "kind int, c1 long, c2 long, low int, high int, h1 long, h2 long, times long"), "told")
    across = told.filter("kind = 1")
    twice = across.groupBy("h1", "h2").agg(F.sum("times").alias("all")).filter("all > 1").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"))
    across = across.join(twice, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))).select("c1", "c2", "low", "high")
    # a context seen twice repeats as a whole
    whole = contexts.filter("times > 1").select("c1", "c2", F.lit(0).alias("low"), (F.col("n") - 1).alias("high"))
    marks = told.filter("kind = 0").select("c1", "c2", "low", "high").union(across).union(whole)
    marks = stored(marks.groupBy(F.col("c1").alias("m1"), F.col("c2").alias("m2")).agg(F.collect_list(F.struct("low", "high")).alias("marks")), "marks")
    found = mixed.join(marks, (F.col("c1") == F.col("m1")) & (F.col("c2") == F.col("m2"))).select("rid", "start", F.explode("marks").alias("m"))
    found = found.select("rid", (F.col("start") + F.col("m.low")).alias("low"), (F.col("start") + F.col("m.high") + length).alias("high"))
    return found.union(alive.filter("equal").select("rid", F.col("start").alias("low"), (F.col("start") + F.col("n") - 1 + length).alias("high")))


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """Every row's other columns with n_bytes, n_removed, spans (removed byte ranges) and
    kept (the remaining bytes)."""
    out_names = ("n_bytes", "n_removed", "spans", "kept")
    keep = [c for c in docs.columns if c != text and c not in out_names and not c.startswith("__")]
    rid = F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")), F.length(text))
    rows = docs.select(rid.alias("rid"), F.col(text).alias("text"))
    found = repeated_spans(rows, length, spread).groupBy(F.col("rid").alias("__of")).agg(F.collect_list(F.struct("low", "high")).alias("__spans"))
    full = docs.select(*keep, F.col(text).alias("__text"), rid.alias("__rid"))
    full = full.join(found, F.col("__rid") == F.col("__of"), "left").select(*keep, "__text", "__spans")
    schema = with_fields(docs.select(*keep), "n_bytes long, n_removed long, spans array<struct<low:int,high:int>>, kept binary")
    return full.mapInArrow(_keep, schema)
