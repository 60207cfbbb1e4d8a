"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a text is ``w0 + w.x + 1/2 sum_f ((V_f.x)^2 - V_f^2.x^2)``: every pair of features interacts through
vectors of low rank, and the sum-of-squares identity gives all pairs in time linear in the features. It is trained
by stochastic gradient descent on a bounded sample of labelled rows; whole texts are scored in Arrow batches.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import held_out
from starmart.llm.learning import bounded_sample, sigmoid

WORD_BUCKETS, RANK = 1024, 8
#: Bound of the training sample: rows of each label.
PER_LABEL = 2_500
#: Documents scoring this much or more count as good.
THRESHOLD = 0.3

STATISTICS = (
    "log characters", "log words", "no text", "letters", "upper case", "digits", "blanks", "marks", "pipes", "other bytes",
    "word length", "distinct words", "commonest word", "words after themselves", "words ending in marks", "upper-case words",
    "lines", "distinct lines", "commonest line", "line length", "stated length", "stated length is missing",
)
N_STATS = len(STATISTICS)
FEATURES = WORD_BUCKETS + N_STATS

_BYTES = np.arange(256)
_LETTERS = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGITS = (_BYTES >= 48) & (_BYTES <= 57)
_BLANKS = (_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13))
_MARKS = (_BYTES > 32) & (_BYTES < 127) & ~_LETTERS & ~_DIGITS
_KINDS = np.stack([_LETTERS, _UPPER, _DIGITS, _BLANKS, _MARKS, _BYTES == 124, _BYTES >= 128]).astype(np.float64)


def features(text: str | None, n_chars: int | None = None) -> np.ndarray:
    """The feature vector of a whole text: hashed words, then ``STATISTICS``. A null text counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(FEATURES, np.float32)
    stats = out[WORD_BUCKETS:]
    stats[20:] = (0.0, 1.0) if n_chars is None else (np.log1p(max(0, n_chars)) / 8, 0.0)
    words = raw.split()
    if not words:
        stats[2] = 1
        return out
    n = len(words)
    counts = Counter(words)
    hashed = np.fromiter((zlib.crc32(w) for w in counts), np.int64, len(counts)) % WORD_BUCKETS
    bag = np.sqrt(np.bincount(hashed, np.fromiter(counts.values(), np.float64, len(counts)), WORD_BUCKETS))
    out[:WORD_BUCKETS] = bag / np.sqrt((bag * bag).sum())
    share = _KINDS @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    line_counts = Counter(lines)
    marked = sum(c for w, c in counts.items() if w[-1:] in b"!$%&*#|" and len(w) > 1)
    shouted = sum(c for w, c in counts.items() if len(w) > 1 and w.isupper())
    stats[0], stats[1] = np.log1p(len(raw)) / 8, np.log1p(n) / 6
    stats[3:10] = share[0], share[1] * 4, share[2] * 4, share[3], share[4] * 4, share[5] * 10, share[6]
    stats[10:16] = len(raw) / n / 10, len(counts) / n, max(counts.values()) / n, sum(map(bytes.__eq__, words, words[1:])) / n, marked / n, shouted / n
    stats[16:20] = np.log1p(len(lines)) / 4, len(line_counts) / len(lines), max(line_counts.values()) / len(lines), np.log1p(len(raw) / len(lines)) / 8
    return out


@dataclass(frozen=True)
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.factors
        pairs = 0.5 * ((s * s).sum(1) - (x * x) @ (self.factors * self.factors).sum(1))
        return self.bias + x @ self.linear + pairs

    def scores(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x).astype(np.float64))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 40, rate: float = 0.05, decay: float = 1e-4, seed: int = 11) -> Model:
    """Weighted log loss, minibatches, step sizes adapted to each parameter's gradients."""
    rng = np.random.default_rng(seed)
    w0, w, v = 0.0, np.zeros(x.shape[1], np.float32), rng.normal(0, 0.02, (x.shape[1], RANK)).astype(np.float32)
    g0, gw, gv = 1e-8, np.full_like(w, 1e-8), np.full_like(v, 1e-8)
    for epoch in range(epochs):
        step = rate / (1 + 0.05 * epoch)
        for part in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            xb = x[part]
            s = xb @ v
            x2 = xb * xb
            z = w0 + xb @ w + 0.5 * ((s * s).sum(1) - x2 @ (v * v).sum(1))
            d = ((sigmoid(z) - y[part]) * weight[part] / len(part)).astype(np.float32)
            d0, dw = float(d.sum()), xb.T @ d + decay * w
            dv = xb.T @ (d[:, None] * s) - v * (x2.T @ d)[:, None] + decay * v
            g0, gw, gv = 0.9 * g0 + 0.1 * d0 * d0, 0.9 * gw + 0.1 * dw * dw, 0.9 * gv + 0.1 * dv * dv
            w0 -= step * d0 / (np.sqrt(g0) + 1e-6)
            w -= step * dw / (np.sqrt(gw) + np.float32(1e-6))
            v -= step * dv / (np.sqrt(gv) + np.float32(1e-6))
    return Model(float(w0), w, v)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Learn ``labels.quality`` from the labelled documents that ``held_out`` leaves.

    ``per_label`` bounds the sample; the rows of a label stand for all of that label, so scores follow the share of
    each. Labels join by ``doc_id``: ids that are null or have no document, and null qualities, are left
    out; of repeated labels of an id the smaller holds. Without labels every score is one half.
    """
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    # labels first: the bounded sample of ids is small, the texts of the others are never shuffled
    ids = marks.filter(~held_out()).withColumn("text", F.lit(""))
    chosen = bounded_sample(ids, "quality", per_label).drop("text")
    totals = {r["quality"]: r["n"] for r in ids.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = docs.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text, n_chars, quality = (c.to_pylist() for c in batch.columns)
            x = [features(t, n).tobytes() for t, n in zip(text, n_chars)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(quality, pa.int32()), pa.array(x, pa.binary())], names=["doc_id", "quality", "x"]
            )

    found = rows.select(F.col("doc_id").cast("long"), "text", F.col("n_chars").cast("long"), F.col("quality").cast("int")).mapInArrow(
        vectors, "doc_id long, quality int, x binary"
    ).collect()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    if not found:
        return Model(0.0, np.zeros(FEATURES, np.float32), np.zeros((FEATURES, RANK), np.float32))
    x = np.frombuffer(b"".join(r["x"] for r in found), np.float32).reshape(-1, FEATURES)
    y = np.array([r["quality"] for r in found])
    have = np.bincount(y, minlength=2)
    stands_for = np.array([totals.get(k, 0) / max(1, have[k]) for k in (0, 1)])
    weight = stands_for[y] / stands_for[y].mean()
    return train(x, y, weight)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of the input and ``score double, predicted int`` (1 from ``threshold`` on) for every row.

    A null or empty text is scored by what it lacks; a missing or null ``n_chars`` counts as not stated. Only
    ``text`` and ``n_chars`` enter a score, so equal rows score alike. Columns named like the added ones are
    replaced; no rows in, no rows out.
    """
    kept = docs.drop("score", "predicted")
    if "n_chars" not in kept.columns:
        kept = kept.withColumn("n_chars", F.lit(None).cast("long"))
    text, chars = kept.columns.index("text"), kept.columns.index("n_chars")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([features(t, n) for t, n in zip(batch.column(text).to_pylist(), batch.column(chars).to_pylist())]) if batch.num_rows else np.zeros((0, FEATURES), np.float32)
            p = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    from pyspark.sql.types import DoubleType, IntegerType, StructType

    schema = StructType(list(kept.schema.fields)).add("score", DoubleType()).add("predicted", IntegerType())
    return kept.mapInArrow(run, schema)
