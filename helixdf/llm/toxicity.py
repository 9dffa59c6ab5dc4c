"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives, documents of any kind the unlabelled
sample. With the class prior p, the risk of a scorer is

    p * loss(positives as 1) + max(0, loss(unlabelled as 0) - p * loss(positives as 0))

whose second term, the estimated risk on negatives, adds nothing where it would fall below
zero. The model is linear over hashed words and
word beginnings, fitted with numpy on bounded samples: ``POSITIVES`` and ``UNLABELLED``
documents of least hash among the rows that may be learned from; every document is
then scored in one narrow pass.

Defined cases: null and empty texts have no features and score the bias; without
positives every score is the smoothed prior; a document labelled more than once is
positive if any label says so; repeated rows score alike.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_fields
from .features import BITS, Rows, feature_rows, fit, linear_scores, row_arrays

POSITIVES = 2_500
UNLABELLED = 10_000
THRESHOLD = 0.3
STEPS = 300
#: Scores above this lose no more as negatives.
TOP = 3.0
RATE = 0.03
DECAY = 1e-3
#: Features whose shares differ by so many standard errors between the samples are used.
APART = 4.0


def nnpu_slope(positive: np.ndarray, prior: float):
    """Gradient by score of the non-negative risk with the logistic loss."""
    n_p, n_u = max(int(positive.sum()), 1), max(int((~positive).sum()), 1)

    def slope(z: np.ndarray) -> np.ndarray:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        as_zero = np.logaddexp(0, np.minimum(z, TOP))  # bounded, so that a few high scores cannot pay for all
        negative = as_zero[~positive].sum() / n_u - prior * as_zero[positive].sum() / n_p
        g = np.zeros_like(z)
        g[positive] = -prior * (1 - p[positive]) / n_p
        if negative > 0:
            low = z < TOP
            g[~positive] = (p * low)[~positive] / n_u
            g[positive] -= prior * (p * low)[positive] / n_p
        return g
    return slope


def train(texts: DataFrame, labels: DataFrame, learn, doc_id: str = "doc_id", text: str = "text",
          prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED, bits: int = BITS) -> tuple[float, np.ndarray]:
    """Bias and weights. ``labels``: doc_id, toxic. Only rows where ``learn`` (a function of
    the id column) holds give labels or texts. The prior is the labelled toxic share if not
    given. An id gives one text to a sample (of rows that share it, the one whose text hashes
    least), so no more than ``positives`` + ``unlabelled`` rows reach the driver."""
    marks = (labels.filter(learn(F.col(doc_id)) & F.col("toxic").isNotNull())
             .groupBy(F.col(doc_id).alias("__id")).agg(F.max(F.col("toxic").cast("int")).alias("__toxic")))
    known, toxic = marks.agg(F.count(F.lit(1)), F.sum("__toxic")).first()
    prior = prior if prior is not None else ((toxic or 0) + 1) / ((known or 0) + 10)
    some = marks.filter("__toxic = 1").withColumn("__o", F.xxhash64(F.lit(7), F.col("__id"))).orderBy("__o").limit(positives).select("__id", F.lit(True).alias("positive"))
    ids = texts.filter(learn(F.col(doc_id))).select(F.col(doc_id).alias("__id"))
    other = (ids.withColumn("__o", F.xxhash64(F.lit(8), F.col("__id"))).orderBy("__o").limit(unlabelled)
             .select("__id", F.lit(False).alias("positive")).distinct())
    sample = texts.select(F.col(doc_id).alias("__d"), F.col(text).alias("__t")).join(F.broadcast(some.union(other)), F.col("__d") == F.col("__id"))
    sample = sample.select("__id", "positive", F.xxhash64("__t").alias("__h"), "__t")
    made = sample.mapInArrow(feature_rows(bits), with_fields(sample.drop("__t"), "features array<int>"))
    rows = made.groupBy("__id", "positive").agg(F.min_by("features", "__h").alias("features")).toArrow()
    positive = rows.column("positive").to_numpy(zero_copy_only=False).astype(bool)
    if not positive.any():
        return float(np.log(prior / (1 - prior))), np.zeros(1 << bits, dtype=np.float32)
    order = np.lexsort((rows.column("__id").to_numpy(zero_copy_only=False), positive))  # the same whichever task came first
    own = row_arrays(rows.column("features"))
    sparse = Rows([own[i] for i in order], bits=bits, groups=positive[order], apart=APART)
    del own, rows
    return fit(sparse, nnpu_slope(positive[order], prior), STEPS, RATE, DECAY, float(np.log(prior / (1 - prior))), bits)


def score_toxicity(docs: DataFrame, model: tuple[float, np.ndarray], text: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with ``score``; the model's weights (2^bits numbers) are broadcast."""
    keep = [c for c in docs.columns if c != "score"]
    rows = docs.select(*keep, F.col(text).alias("__text"))
    return rows.mapInArrow(linear_scores(docs.sparkSession.sparkContext.broadcast(model), bits), with_fields(docs.select(*keep), "score double"))
