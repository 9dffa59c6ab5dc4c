"""Quality classifier from weak labels.

Heuristic labellers vote good (1), bad (-1) or nothing (0) on every document. The votes
are counted per pattern over all documents (at most 3^labellers patterns), and
expectation-maximisation estimates each labeller's vote rates on good and bad documents
(so its accuracy) and the share of good ones: votes are independent given the true label. A linear
scorer over hashed words is then fitted to the posterior labels of a bounded sample
(``SAMPLE`` documents of least hash) together with the vote pattern's features, and
scores every document.

Defined cases: null and empty texts get the votes of an empty text; an empty table gives
an empty result; labels that all abstain leave the prior; repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IS_SPACE, with_fields, word_hashes
from .features import BITS, Rows, fit, row_arrays, word_features
from .shingles import text_bytes, words_of

SAMPLE = 6_000
STEPS = 200
RATE = 0.03
DECAY = 1e-3
#: Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that it for was on are with as at by this from be or "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine "
    "le la les des et en du un une que est pour dans qui sur par au "
    "el los las de y del se por con para su al lo").split()
_STOP = np.unique(word_hashes(" ".join(STOP_WORDS).encode())[0])
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[np.frombuffer(b"#*$%&<>|", dtype=np.uint8)] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _ratio(value: float, good: float, bad: float) -> int:
    """Good up to ``good``, bad from ``bad``, nothing between (for good > bad the other way)."""
    if good > bad:
        return 1 if value >= good else -1 if value <= bad else 0
    return 1 if value <= good else -1 if value >= bad else 0


def votes(texts: list[bytes]) -> np.ndarray:
    """The labellers' votes on each text."""
    out = np.zeros((len(texts), len(LABELLERS)), dtype=np.int8)
    for r, t in enumerate(texts):
        b = np.frombuffer(t, dtype=np.uint8)
        h, at = words_of([t])
        n, chars = len(h), max(int((~IS_SPACE[b]).sum()), 1)
        letters = max(int(_LETTER[b].sum()), 1)
        lines = [x for x in t.split(b"\n") if x.strip()]
        stop = _STOP[np.minimum(np.searchsorted(_STOP, h), len(_STOP) - 1)] == h
        out[r] = (
            _ratio(_SYMBOL[b].sum() / chars, 0.01, 0.05),
            _ratio(_UPPER[b].sum() / letters, 0.15, 0.4),
            _ratio(t.count(b"!!") / max(n, 1), 0.02, 0.2),
            _ratio(float(stop.mean()) if n else 0.0, 0.1, 0.03),
            _ratio(1 - len(set(lines)) / len(lines) if lines else 0.0, 0.1, 0.3),
            _ratio(1 - len(np.unique(h)) / n if n >= 50 else 0.5, 0.6, 0.85),
            -1 if n < 10 else 0 if n < 50 else 1,
            _ratio(abs(chars / n - 6.5) if n else 9.0, 3.0, 6.0),
        )
    return out


LABELLERS = ("symbols", "capitals", "shouting", "stop_words", "repeated_lines", "repeated_words", "length", "word_length")


def pattern_ids(v: np.ndarray) -> np.ndarray:
    return ((v + 1).astype(np.int64) * 3 ** np.arange(v.shape[1])).sum(axis=1)


def patterns_of(ids: np.ndarray) -> np.ndarray:
    return (ids[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1).astype(np.int8)


def accuracies(ids: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns: posterior good share of each pattern,
    and each labeller's accuracy (share of its votes that are right).

    A labeller has a distribution over its three votes for good and one for bad documents.
    It begins with documents bad that get any bad vote."""
    v = patterns_of(ids)
    is_vote = np.stack([v == x for x in (-1, 0, 1)], axis=2).astype(np.float64)  # pattern, labeller, vote
    post = np.where((v < 0).any(axis=1), 0.1, 0.95)
    vote = np.zeros((2, v.shape[1], 3))
    for _ in range(rounds):
        share = float(np.clip((post * counts).sum() / max(counts.sum(), 1), 0.02, 0.98))
        for c, weight in ((0, (1 - post) * counts), (1, post * counts)):
            seen = np.einsum("p,plv->lv", weight, is_vote) + 0.5
            vote[c] = seen / seen.sum(axis=1, keepdims=True)
        ratio = np.log(vote[1]) - np.log(vote[0])
        z = np.log(share / (1 - share)) + np.einsum("plv,lv->p", is_vote, ratio)
        new = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        done = np.abs(new - post).max() < 1e-7
        post = new
        if done:
            break
    right = (post * counts) @ (v > 0) + ((1 - post) * counts) @ (v < 0)
    return post, (right + 1) / (counts @ (v != 0) + 2)


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = pattern_ids(votes(text_bytes(batch.column(0))))
        yield pa.RecordBatch.from_arrays([pa.array(ids)], ["pattern"])


def _features(texts: list[bytes], v: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Words' features and the votes, each vote in a place of its own after them."""
    for f, own in zip(word_features(texts, bits), v):
        yield np.concatenate((f, (1 << bits) + np.arange(len(own)) * 3 + own + 1)).astype(np.int32)


def _sample_rows(bits: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(2))
            v = votes(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pattern_ids(v)), pa.array(list(_features(texts, v, bits)), pa.list_(pa.int32()))],
                                             ["o", "h", "pattern", "features"])
    return each


def _score_rows(model, bits: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, weights, ids, post = model.value
        for batch in batches:
            texts = text_bytes(batch.column(batch.num_columns - 1))
            v = votes(texts)
            z = np.array([bias + float(weights[f].sum(dtype=np.float64)) for f in _features(texts, v, bits)], dtype=np.float64)
            own = post[np.searchsorted(ids, pattern_ids(v))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(own, pa.float64()), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())],
                                             [*batch.schema.names[:-1], "weak_label", "score"])
    return each


def classify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE, threshold: float = 0.5, bits: int = BITS) -> DataFrame:
    """``docs`` with weak_label (posterior of its votes), score and kept (score reaches ``threshold``)."""
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in ("weak_label", "score", "kept")]
    counted = docs.select(text).mapInArrow(_vote_rows, "pattern long").groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    ids, n = np.array([r[0] for r in counted], dtype=np.int64), np.array([r[1] for r in counted], dtype=np.float64)
    bias, weights, post = 0.0, np.zeros((1 << bits) + 3 * len(LABELLERS), dtype=np.float32), np.zeros(0)
    if len(ids):
        post, _ = accuracies(ids, n)
        chosen = docs.select(F.xxhash64(F.lit(9), F.col(doc_id)).alias("o")).orderBy("o").limit(sample).distinct()
        some = docs.select(F.xxhash64(F.lit(9), F.col(doc_id)).alias("o"), F.col(text).alias("t")).join(F.broadcast(chosen), "o")
        made = some.select("o", F.xxhash64("t").alias("h"), "t").mapInArrow(_sample_rows(bits), "o long, h long, pattern long, features array<int>")
        # rows that share an id give one text, the one that hashes least
        rows = made.groupBy("o").agg(F.min_by(F.struct("pattern", "features"), "h").alias("r")).select("o", "r.*").toArrow()
        order = np.argsort(rows.column("o").to_numpy(), kind="stable")
        own = row_arrays(rows.column("features"))
        want = post[np.searchsorted(ids, rows.column("pattern").to_numpy())][order]
        sparse = Rows([own[i] for i in order], bits=bits + 1, groups=want > 0.5)
        bias, wide = fit(sparse, lambda z: (1 / (1 + np.exp(-np.clip(z, -30, 30))) - want) / len(want), STEPS, RATE, DECAY, 0.0, bits + 1)
        weights = wide[:len(weights)]
    model = spark.sparkContext.broadcast((bias, weights, ids, post))
    rows = docs.select(*keep, F.col(text).alias("__text"))
    schema = with_fields(docs.select(*keep), "weak_label double, score double")
    return rows.mapInArrow(_score_rows(model, bits), schema).withColumn("kept", F.col("score") >= threshold)
