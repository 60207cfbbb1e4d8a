"""What the two classifiers share: a bounded sample of labelled rows, and softened probabilities."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import stage

_SPACE = 1 << 30
#: Labels whose rates are broadcast; with more of them the rows are shuffled by label.
MOST_LABELS = 100_000


def bounded_sample(labelled: DataFrame, label: str, per_label: int, key: str = "doc_id") -> DataFrame:
    """About ``per_label`` rows of every label (all of a rarer one), chosen by a hash of key and text.

    The rate of a label is ``per_label`` over its count, so the choice needs one count per label and no sort; it is
    the same on every run. Rows with a null label are left out.
    """
    known = labelled.filter(F.col(label).isNotNull())
    counts = stage(known.groupBy(label).agg((F.lit(float(per_label)) / F.count(F.lit(1))).alias("_rate")), "rates")
    if counts.count() <= MOST_LABELS:
        counts = F.broadcast(counts)
    draw = F.pmod(F.xxhash64(F.col(key), F.col("text"), F.lit("sample")), F.lit(_SPACE)) / float(_SPACE)
    return known.join(counts, label).filter(draw < F.col("_rate")).drop("_rate")


def fold(keys: np.ndarray, parts: int = 5) -> np.ndarray:
    """True for the part of a sample that calibrates instead of training."""
    return keys % parts == 0


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
