"""Document fingerprints from closed syncmers.

A k-mer is an anchor if its smallest inner s-mer lies at one of its edges. That depends on the k-mer alone, so an
edit changes the anchors it touches and no others. The fingerprint keeps every anchor whose hash is under a bound, at each
of its places: one in ``SHARE`` anchors, so their number grows with the text, or under a higher bound that lets
``FEWEST`` different ones in; a text with no more has all of them. Two fingerprints are compared under the lower of their
bounds, below which both are whole, and matches count at one common shift of the places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import code_points, mix64, partitions
from starmart.session import scratch_dir

K, S = 12, 5
#: Hashes are cut to so many bits; the bound lets one anchor in so many in, and this number of different ones at least.
HASH_BITS, SHARE, FEWEST = 24, 16, 48
#: Matches count up to this many code points from the common shift.
SLACK = 64
BASE = np.uint64(0x9E3779B97F4A7C15)


def anchors(points: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers; a text without any (one under k long, say) is one anchor itself,
    an empty text has none."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    c = points.astype(np.uint64)
    if n >= k:
        h = c[: n - s + 1].copy()
        for j in range(1, s):
            h = h * BASE + c[j : n - s + 1 + j]
        h = mix64(h)
        w = k - s + 1
        low, span = h, 1
        while span * 2 <= w:
            low, span = np.minimum(low[:-span], low[span:]), span * 2
        if span < w:
            low = np.minimum(low[: len(low) - (w - span)], low[w - span :])
        m = n - k + 1
        at = np.flatnonzero((h[:m] == low) | (h[w - 1 :] == low))
        if len(at):
            code = h[at]
            for j in [*range(s, w - 1, s), w - 1]:
                code = code * BASE + h[at + j]
            return at, mix64(code)
    whole = np.uint64(int.from_bytes(hashlib.sha256(points.tobytes()).digest()[:8], "little"))
    return np.zeros(1, np.int64), mix64(np.array([whole], np.uint64))


Print = tuple[int, np.ndarray, np.ndarray]


def sketch(points: np.ndarray) -> Print:
    """The bound, and the hashes and places of the anchors up to it, in order of place."""
    at, code = anchors(points)
    h = (code >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    different = np.unique(h)
    top = (1 << HASH_BITS) - 1
    bound = top if len(different) <= FEWEST else max(top // SHARE, int(different[FEWEST - 1]))
    keep = h <= bound
    return bound, h[keep], at[keep]


def encode(found: Print) -> str:
    """Hex digits: the bound, then for each anchor its hash and how far it is from the one before."""
    bound, h, at = found
    width = HASH_BITS // 4
    return ".".join([f"{bound:0{width}x}", *[f"{v:0{width}x}{d:x}" for v, d in zip(h.tolist(), np.diff(at, prepend=0).tolist())]])


def decode(fingerprint: str) -> Print:
    bound, *cells = fingerprint.split(".")
    width = HASH_BITS // 4
    h, steps = ([int(c[part], 16) for c in cells] for part in (slice(0, width), slice(width, None)))
    return int(bound, 16), np.array(h, np.int64), np.cumsum(np.array(steps, np.int64))


def likeness(a: Print, b: Print) -> float:
    """The share of the anchors of both that match at one common shift (0 to 1).

    The shift is the median over the anchors that both have, at their first places. Fingerprints of empty texts are alike
    (1), an empty and another text are not (0).
    """
    bound = min(a[0], b[0])
    (ha, pa_), (hb, pb) = ((h[h <= bound], p[h <= bound]) for _, h, p in (a, b))
    if not len(ha) + len(hb):
        return 1.0 if len(a[1]) == len(b[1]) == 0 else 0.0
    (one, i), (two, j) = np.unique(ha, return_index=True), np.unique(hb, return_index=True)
    _, x, y = np.intersect1d(one, two, assume_unique=True, return_indices=True)
    if not len(x):
        return 0.0
    shifts = np.sort(pa_[i[x]] - pb[j[y]])
    shift = int(shifts[len(shifts) // 2])
    matched = _near(ha, pa_ - shift, hb, pb) + _near(hb, pb, ha, pa_ - shift)
    return matched / (len(ha) + len(hb))


def _near(h: np.ndarray, place: np.ndarray, other: np.ndarray, places: np.ndarray) -> int:
    """How many anchors have an equal one within ``SLACK`` of their place."""
    wide = np.int64(1) << 38  # places and shifts are far less
    known = np.sort(other * wide + places)
    low = np.searchsorted(known, h * wide + place - SLACK)
    return int((known[np.minimum(low, len(known) - 1)] - (h * wide + place) <= SLACK)[low < len(known)].sum())


def edited(text: str, follower: str) -> str:
    """The text whose last third gives way to the beginning of the follower."""
    cut = len(text) // 3
    return text[: len(text) - cut] + follower[:cut]


SCHEMA = (
    "kind string, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, text string"
)
_ARROW = pa.schema([
    ("kind", pa.string()), ("part", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string()),
])


def _row(kind: str, part: int, doc_id, text: str, own, follower: str | None, follows) -> tuple:
    if follower is None:
        return (kind, part, doc_id, None, None, None, None, None, None, text)
    changed = edited(text, follower)
    other = own if changed == text else sketch(code_points(changed))
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return (kind, part, doc_id, len(text), sha, encode(own), encode(other), likeness(own, other), likeness(own, follows), None)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _consecutive(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row beside the next of its partition. The first row and, still open, the last row also go out with
    their texts, for the seam between partitions."""
    from pyspark import TaskContext

    part, rows, held = TaskContext.get().partitionId(), [], None
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = sketch(code_points(text))
            if held is None:
                rows.append(_row("first", part, doc_id, text, own, None, None))
            else:
                rows.append(_row("done", part, held[0], held[1], held[2], text, own))
            held = (doc_id, text, own)
            if len(rows) >= 500:
                yield _batch(rows)
                rows = []
    if held is not None:
        rows.append(_row("last", part, held[0], held[1], held[2], None, None))
    if rows:
        yield _batch(rows)


def _seams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, text, follower in zip(*(c.to_pylist() for c in batch.columns)):
            rows.append(_row("done", 0, doc_id, text, sketch(code_points(text)), follower, sketch(code_points(follower))))
        if rows:
            yield _batch(rows)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint every document, its edited text and the document after it in descending ``doc_id``.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, one row per input
    row. A null text counts as empty. Equal ids follow each other by hash and then by text; null ids come last;
    after the last document comes the first, so a lone one follows itself. No documents: no rows. Columns other than
    ``doc_id`` and ``text`` are not used.

    Texts are shuffled once, by range, and read in order within each partition, one batch at a time. A seam between
    two partitions costs two texts, joined by partition number.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_h"))
    by = [F.col("doc_id").desc_nulls_last(), F.col("_h"), F.col("text")]
    dealt = ordered.repartitionByRange(partitions(docs), *by[:2]).sortWithinPartitions(*by)
    path = scratch_dir(docs.sparkSession, "syncmers")
    dealt.select("doc_id", "text").mapInArrow(_consecutive, SCHEMA).write.option("compression", "zstd").parquet(path)
    staged = docs.sparkSession.read.schema(SCHEMA).parquet(path)
    # which partition follows which: one small row per partition, never a text
    parts = sorted(r["part"] for r in staged.filter("kind = 'first'").select("part").collect())
    done = staged.filter("kind = 'done'")
    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    if not parts:
        return done.select(*columns)
    after = docs.sparkSession.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, follows int")
    opened = staged.filter("kind = 'last'").select("doc_id", "text", "part").join(after, "part")
    opened = opened.select("doc_id", "text", F.col("follows").alias("part"))
    firsts = staged.filter("kind = 'first'").select("part", F.col("text").alias("follower"))
    seams = opened.join(firsts, "part").select("doc_id", "text", "follower").mapInArrow(_seams, SCHEMA)
    return done.unionByName(seams).select(*columns)
