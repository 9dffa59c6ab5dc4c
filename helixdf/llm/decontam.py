"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Texts are normalised to words (A-Z lower-cased; ASCII letters and digits and all
characters beyond ASCII are word characters) joined by one space. The windows of
every item, framed by spaces, are the automaton's patterns, so one scan of a
normalised text finds all occurrences. Words map back to the original text by
their byte offsets.

The items are the stated query side: their windows go to the tasks in blocks of
at most ``block_bytes``, measured first; texts pass through the blocks one after
another in the same narrow stage, so nothing of the documents is shuffled.

Defined cases: null or wordless texts have no words and no hits; an item without
words has no window; items that share a window are all reported; repeated
documents are judged one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, with_fields

WINDOW = 10
BLOCK_BYTES = 32 << 20

_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if _WORD[b] else 32 for b in range(256))


def normal_words(text: str | None) -> list[bytes]:
    return as_bytes(text).translate(_NORMAL).split()


def windows(text: str | None, size: int = WINDOW) -> set[bytes]:
    w = normal_words(text)
    return {b" ".join(w[i:i + size]) for i in range(max(len(w) - size, 0) + 1)} if w else set()


def _windows(size: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, w) for i, t in zip(*(c.to_pylist() for c in batch.columns)) for w in windows(t, size)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], batch.schema.types[0]), pa.array([r[1] for r in rows], pa.binary())], ["item", "window"])
    return each


def _automaton(block: list[tuple[bytes, list[str]]]) -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for window, items in block:
        a.add_word(" " + window.decode("latin-1") + " ", (window.count(b" ") + 1, items))
    a.make_automaton()
    return a


_BUILT: dict[str, ahocorasick.Automaton] = {}


def _scan(block, key: str, text_at: int, first: bool):
    """Adds one block's hits to n_words, spans (first word, word after the last) and items."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = _automaton(block.value)
        find = _BUILT[key]
        for batch in batches:
            n_words, spans, items = [], [], []
            had = None if first else batch.column(batch.num_columns - 2).to_pylist()
            held = None if first else batch.column(batch.num_columns - 1).to_pylist()
            for r, text in enumerate(batch.column(text_at).to_pylist()):
                w = normal_words(text)
                joined = (b" " + b" ".join(w) + b" ").decode("latin-1") if w else ""
                got, ids = [] if first else [tuple(x.values()) for x in had[r]], set() if first else set(held[r])
                hits = list(find.iter(joined)) if len(find) and w else []
                if hits:
                    gaps = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), dtype=np.uint8) == 32)
                    for at, (n, own) in hits:
                        end = int(np.searchsorted(gaps, at))  # the space after word end-1
                        got.append((end - n, end))
                        ids.update(own)
                n_words.append(len(w))
                spans.append(_union(got))
                items.append(sorted(ids))
            kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            new = [pa.array(n_words, pa.int64()),
                   pa.array([[{"low": a, "high": b} for a, b in s] for s in spans], kind), pa.array(items, pa.list_(pa.string()))]
            old = batch.columns if first else batch.columns[:-3]
            names = batch.schema.names if first else batch.schema.names[:-3]
            yield pa.RecordBatch.from_arrays([*old, *new], [*names, "n_words", "spans", "items"])
    return each


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def original_spans(text: str | None, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of spans of words."""
    data = as_bytes(text)
    inside = np.concatenate(([False], _WORD[np.frombuffer(data, dtype=np.uint8)], [False])) if data else np.zeros(2, dtype=bool)
    step = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    chars = lambda at: len(data[:at].decode("utf-8", "surrogatepass"))
    return [(chars(starts[a]), chars(ends[b - 1])) for a, b in spans]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
               size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, spans (array of first word and word after the last, disjoint)
    and items (sorted ids of the items with occurring windows)."""
    spark = docs.sparkSession
    found = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("t")).mapInArrow(_windows(size), "item string, window binary")
    by_window = found.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    by_window = by_window.withColumn("cost", F.length("window") + F.lit(16) * F.size("items")).checkpoint()
    n_blocks = 1 + int(by_window.agg(F.sum("cost")).first()[0] or 0) // block_bytes
    keep = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    out = docs.select(*keep)
    schema = with_fields(out, "n_words long, spans array<struct<low:long,high:long>>, items array<string>")
    for k in range(n_blocks):
        part = by_window.filter(F.pmod(F.xxhash64("window"), F.lit(n_blocks)) == k).select("window", "items")
        rows = [(bytes(r[0]), list(r[1])) for r in part.toLocalIterator()]
        key = hashlib.sha256(repr(sorted(rows)).encode()).hexdigest()
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(rows), key, keep.index(text), k == 0), schema)
    return out
