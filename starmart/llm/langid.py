"""Language identification by averaged subword embeddings.

The letters of a text give hashed character n-grams; the text's vector is the average of their embeddings, and a
linear softmax on it gives the language. Embeddings and softmax are trained together by stochastic gradient descent
on a bounded sample of labelled rows; a part of the sample sets the temperature of the probabilities and the
probability under which a prediction is rejected. Prediction runs over whole texts, in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import code_points, held_out, mix64
from starmart.llm.learning import bounded_sample, softmax

BUCKETS, WIDTH, GRAMS = 4096, 16, (1, 2, 3, 4)
#: Bounds of the training sample: rows of each language, and rows in all (with many languages each has fewer).
PER_LANGUAGE, MOST_ROWS = 400, 20_000
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
BASE = np.uint64(0x9E3779B97F4A7C15)


def subwords(text: str | None) -> np.ndarray | None:
    """Shares of the hashed n-grams (lower case, digits, marks and blanks as one space); None without a letter."""
    if text is None or not LETTER.search(text):
        return None
    c = code_points(text.lower()).astype(np.uint64)
    low = c < np.uint64(128)
    c[low & ((c < np.uint64(97)) | (c > np.uint64(122)))] = np.uint64(32)
    blank = c == np.uint64(32)
    c = c[~(blank & np.concatenate([[False], blank[:-1]]))]
    counts, h = np.zeros(BUCKETS), c
    for n in GRAMS:
        if n > 1:
            if len(c) < n:
                break
            h = h[:-1] * BASE + c[n - 1 :]
        counts += np.bincount((mix64(h + np.uint64(n)) >> np.uint64(52)).astype(np.int64), minlength=BUCKETS)
    return (counts / counts.sum()).astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return softmax((x @ self.embeddings @ self.weights + self.bias) / self.temperature)


@dataclass(frozen=True)
class Rows:
    """Vectors with few entries: of row i the places and shares between ``edges[i]`` and ``edges[i + 1]``."""

    edges: np.ndarray
    at: np.ndarray
    share: np.ndarray

    def __len__(self) -> int:
        return len(self.edges) - 1

    def some(self, which: np.ndarray) -> np.ndarray:
        """Some rows in full."""
        out = np.zeros((len(which), BUCKETS), np.float32)
        for i, row in enumerate(which):
            part = slice(self.edges[row], self.edges[row + 1])
            out[i, self.at[part]] = self.share[part]
        return out


def train(x: Rows, y: np.ndarray, languages: list[str], epochs: int = 30, rate: float = 1.0, seed: int = 7, accept: float = 0.99) -> Model:
    """Embeddings and softmax by stochastic gradient descent, 16 rows a step; each fifth row calibrates.

    The temperature is the one of least log loss on those rows. ``reject_below`` is the smallest probability above
    which at least ``accept`` of their predictions are right.
    """
    rng = np.random.default_rng(seed)
    n_lang = len(languages)
    e = rng.normal(0, 1.0, (BUCKETS, WIDTH)).astype(np.float32)
    w, b = rng.normal(0, 0.1, (WIDTH, n_lang)).astype(np.float32), np.zeros(n_lang, np.float32)
    rest = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.zeros(len(y), bool)
    # shares are small numbers: scale them so that frequent n-grams move the average
    scale, learn = np.float32(10.0), np.flatnonzero(~rest)
    for epoch in range(epochs):
        step = np.float32(rate / (1 + 0.1 * epoch))
        for part in np.array_split(rng.permutation(learn), max(1, len(learn) // 16)):
            xb = x.some(part) * scale
            hidden = xb @ e
            g = softmax(hidden @ w + b)
            g[np.arange(len(part)), y[part]] -= 1
            g /= len(part)
            gh = g @ w.T
            w -= step * 0.2 * (hidden.T @ g)
            b -= step * 0.2 * g.sum(0)
            e -= step * (xb.T @ gh)
    made = Model(languages, e * scale, w, b, 1.0, 0.0)
    if not rest.any():
        return made
    held, want = np.flatnonzero(rest), y[rest]
    z = np.concatenate([x.some(part) @ made.embeddings @ w + b for part in np.array_split(held, max(1, len(held) // 256))])
    losses = {t: -np.log(softmax(z / t)[np.arange(len(held)), want] + 1e-12).mean() for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0)}
    t = min(losses, key=losses.get)
    p = softmax(z / t)
    top, right = p.max(1), p.argmax(1) == want
    order = np.argsort(-top)
    good = np.cumsum(right[order]) / np.arange(1, len(order) + 1) >= accept
    cut = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(languages, e * scale, w, b, t, cut)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the rows that ``held_out`` leaves.

    About ``per_language`` rows of each language are used, and ``most_rows`` in all. Only their entries reach the driver, and
    no more than a step's rows are laid out in full. Texts without a letter teach nothing. Without any usable row
    the model knows no language, and every text is ``und``.
    """
    rows = docs.select("doc_id", "text", "lang").filter(~held_out())
    known = rows.filter("lang IS NOT NULL").select("lang").distinct().count()
    per_language = max(1, min(per_language, most_rows // max(known, 1)))

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, at, share, key = [], [], [], []
            for name, text, k in zip(*(c.to_pylist() for c in batch.columns)):
                v = subwords(text)
                if v is not None:
                    used = np.flatnonzero(v).astype(np.int16)
                    lang.append(name)
                    at.append(used.tobytes())
                    share.append(v[used].tobytes())
                    key.append(k)
            yield pa.RecordBatch.from_pydict(
                {"lang": lang, "at": at, "share": share, "k": key},
                schema=pa.schema([("lang", pa.string()), ("at", pa.binary()), ("share", pa.binary()), ("k", pa.int64())]),
            )

    sample = bounded_sample(rows, "lang", per_language).select("lang", "text", F.xxhash64("doc_id", "text").alias("k"))
    found = sorted(sample.mapInArrow(vectors, "lang string, at binary, share binary, k long").collect(), key=lambda r: (r["k"], r["lang"]))
    languages = sorted({r["lang"] for r in found})
    number = {lang: i for i, lang in enumerate(languages)}
    y = np.array([number[r["lang"]] for r in found], np.int64)
    at = np.concatenate([np.zeros(0, np.int16), *(np.frombuffer(r["at"], np.int16) for r in found)])
    share = np.concatenate([np.zeros(0, np.float32), *(np.frombuffer(r["share"], np.float32) for r in found)])
    x = Rows(np.cumsum([0, *(len(r["at"]) // 2 for r in found)]), at, share)
    if not languages:
        return Model([], np.zeros((BUCKETS, WIDTH), np.float32), np.zeros((WIDTH, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.0)
    return train(x, y, languages)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred string, score double, accepted boolean`` of every row.

    ``und`` with score 0, not accepted, for a null text, one without a letter, or a model without languages.
    ``score`` is the calibrated probability of ``lang_pred``; ``accepted`` is false where it is under the model's
    rejection threshold (the best guess is still named). Only ``doc_id`` and ``text`` are read; equal texts
    get equal predictions, of languages equally likely the first by name. No rows in, no rows out.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            x, known = np.zeros((n, BUCKETS), np.float32), np.zeros(n, bool)
            for i, text in enumerate(batch.column(1)):
                v = subwords(text.as_py())
                if v is not None and model.languages:
                    x[i], known[i] = v, True
            names, top = np.full(n, UNKNOWN, object), np.zeros(n)
            if known.any():
                p = model.scores(x[known])
                best = p.argmax(1)
                names[known], top[known] = np.array(model.languages, object)[best], p[np.arange(len(best)), best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(top, pa.float64()), pa.array(known & (top >= model.reject_below), pa.bool_())],
                names=["doc_id", "lang_pred", "score", "accepted"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")
