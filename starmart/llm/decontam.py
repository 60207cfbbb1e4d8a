"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Each task looks up the hashed word n-grams of its texts among those of the test items and writes down which ones each
   text holds: hashes only. Over all texts the document frequency of every item n-gram is counted; an item's seeds are its
   rare n-grams, those in a few texts or not several times as frequent as its n-grams usually are. (Rare is meant within
   each item: an item copied into a third of all documents keeps its seeds.)
2. A text and an item are a candidate if they share a seed, or a good part of the item's n-grams, rare or not. A text that
   shares a stock phrase with many items is none of theirs. Passages are cut for candidates only, around every place where
   the item's n-grams gather.
3. Passages are aligned with the item, word by word. The score is that of the best local alignment
   over that of a perfect one, so replaced, missing and added words cost, and word order counts.

The items travel to the tasks in blocks of bounded size; more items than a block holds take more passes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.bitmaps import bitmap
from starmart.llm.common import mix64
from starmart.session import stage

N = 4
MIN_SCORE = 0.5
#: An n-gram is rare up to this many times the median document frequency of its item's n-grams (0 for those that no text
#: holds), and in any case up to so few texts.
RARE, FEW = 4, 10
#: The part of an item's n-grams with which a passage is aligned whatever their frequency.
ENOUGH = 0.2
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of item text that one pass sends to the tasks.
BLOCK_BYTES = 8 << 20
WORD = re.compile(r"[^\W_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of the words met, up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1 << 19:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_known = _Words()


def word_hashes(text: str | None) -> np.ndarray:
    """A hash of each word (letters and digits, A-Z lower-cased); none for an empty or null text."""
    # bytes are lower-cased A-Z only
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rolling hashes of the n-grams; none if there are fewer words."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = words[: len(words) - n + 1].copy()
    for j in range(1, n):
        h = mix64(h * BASE + words[j : len(words) - n + 1 + j])
    return h


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: ``(score, first, last)`` of the best local alignment, the passage words from first up to last.

    One row of the table per passage word; a gap in the item is a running maximum along the row. Among equal scores
    the earliest end counts. No words on either side: ``(0, 0, 0)``.
    """
    m = len(item)
    if not m or not len(passage):
        return 0, 0, 0
    ramp = np.arange(m + 1, dtype=np.int64) * -GAP
    row, begin = np.zeros(m + 1, np.int64), np.zeros(m + 1, np.int64)
    best = (0, 0, 0)
    for i, w in enumerate(passage):
        step = np.where(item == w, MATCH, MISMATCH)
        new, start = np.zeros(m + 1, np.int64), np.full(m + 1, i + 1)
        diagonal, up = row[:-1] + step, row[1:] + GAP
        new[1:] = np.maximum(np.maximum(diagonal, up), 0)
        start[1:] = np.where(new[1:] == 0, i + 1, np.where(diagonal >= up, np.where(row[:-1] == 0, i, begin[:-1]), begin[1:]))
        lifted = new + ramp
        along = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == along, np.arange(m + 1), 0))
        value = along - ramp
        start = np.where(value > new, start[source], start)
        row, begin = value, start
        j = int(row.argmax())
        if row[j] > best[0]:
            best = (int(row[j]), int(begin[j]), i + 1)
    return best


def _clusters(doc_pos: np.ndarray, item: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Hits sorted by item and place, cut where a gap is longer than the item: ``(item, first, last, hit indices)``."""
    order = np.lexsort((doc_pos, item))
    i, p = item[order], doc_pos[order]
    cut = np.flatnonzero((i[1:] != i[:-1]) | (p[1:] - p[:-1] > lengths[i[1:]])) + 1
    for part in np.split(np.arange(len(order)), cut):
        yield int(i[part[0]]), int(p[part[0]]), int(p[part[-1]]), order[part]


def _blocks(items: pd.DataFrame, block_bytes: int) -> Iterator[pd.DataFrame]:
    size = items["text"].str.len().cumsum() // block_bytes
    for _, part in items.groupby(size):
        yield part.reset_index(drop=True)


class Index:
    """The n-grams of a block of items: by size the sorted grams, with the item of each and whether it is a seed there."""

    def __init__(self, items: pd.DataFrame, n: int):
        words = [word_hashes(t) for t in items["text"]]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.ids = items["item_id"].to_numpy(np.int64)
        grams = [(gram_hashes(w, min(n, len(w))), i, min(n, len(w))) for i, w in enumerate(words) if len(w)]
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in sorted({size for *_, size in grams}):
            gram = np.concatenate([g for g, _, size in grams if size == k])
            owner = np.concatenate([np.full(len(g), i) for g, i, size in grams if size == k])
            pairs = np.unique(np.stack([gram, owner.astype(np.uint64)], 1), axis=0)
            self.by_size[k] = pairs[:, 0].copy(), pairs[:, 1].astype(np.int64), np.ones(len(pairs), bool)
        owners = np.concatenate([np.zeros(0, np.int64), *(o for _, o, _ in self.by_size.values())])
        self.n_grams = np.bincount(owners, minlength=len(words))
        # by size which low bits of a hash the grams have: most hashes of a text need no search
        self.low_bits = {}
        for k, (gram, *_) in self.by_size.items():
            marked = np.zeros(min(1 << 24, 1 << max(16, (16 * len(gram)).bit_length())), bool)
            marked[gram & np.uint64(len(marked) - 1)] = True
            self.low_bits[k] = marked

    def seed(self, gram: np.ndarray, df: np.ndarray) -> None:
        """Mark the seeds by the document frequencies of the grams that texts hold."""
        order = np.argsort(gram)
        gram, df = gram[order], df[order]
        counted = []
        for g, owner, _ in self.by_size.values():
            at = np.minimum(np.searchsorted(gram, g), max(len(gram) - 1, 0))
            counted.append(np.where(gram[at] == g, df[at], 0) if len(gram) else np.zeros(len(g), np.int64))
        every = np.concatenate([np.zeros(0, np.int64), *counted])
        owners = np.concatenate([np.zeros(0, np.int64), *(o for _, o, _ in self.by_size.values())])
        usual = pd.Series(every).groupby(owners).median().reindex(range(len(self.lengths)), fill_value=0).to_numpy()
        for (k, (g, owner, _)), n in zip(list(self.by_size.items()), counted):
            self.by_size[k] = g, owner, n <= np.maximum(FEW, RARE * usual[owner])

    def found(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a text holds grams of that size, and which."""
        h, (gram, *_), marked = gram_hashes(words, k), self.by_size[k], self.low_bits[k]
        place = np.flatnonzero(marked[h & np.uint64(len(marked) - 1)])
        h = h[place]
        known = gram[np.minimum(np.searchsorted(gram, h), len(gram) - 1)] == h
        return place[known], h[known]

    def held(self, words: np.ndarray) -> list[np.ndarray]:
        """The grams of the index that a text holds, by size."""
        return [np.unique(self.found(words, k)[1]) for k in self.by_size]

    def _pairs(self, gram: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For hashes in an index the place of each of their entries, and which hash it is of."""
        low = np.searchsorted(gram, h)
        count = np.searchsorted(gram, h, side="right") - low
        return np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum())), np.repeat(np.arange(len(h)), count)

    def candidates(self, held: list[np.ndarray]) -> np.ndarray:
        """The items that share a seed, or enough of their grams, with a text that holds these."""
        many, seeded = np.zeros(0, np.int64), [np.zeros(0, np.int64)]
        for h, (gram, owner, seed) in zip(held, self.by_size.values()):
            at, _ = self._pairs(gram, h)
            seeded.append(owner[at[seed[at]]])
            many = np.concatenate([many, owner[at]])
        item, n = np.unique(many, return_counts=True)
        return np.union1d(np.concatenate(seeded), item[n >= ENOUGH * self.n_grams[item]])

    def hits(self, words: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where a text holds grams of the wanted items: place, item, gram, and whether it is a seed of the item."""
        out = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, bool)]]
        for k, (gram, owner, seed) in self.by_size.items():
            place, h = self.found(words, k)
            at, which = self._pairs(gram, h)
            mine = np.isin(owner[at], wanted)
            for part, values in zip(out, (place[which[mine]], owner[at[mine]], gram[at[mine]], seed[at[mine]])):
                part.append(values)
        return tuple(np.concatenate(part) for part in out)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("key"), "text")


def _held(docs: DataFrame, index: Index) -> DataFrame:
    """``key, grams``: the item n-grams that each text holds, rows without any left out and equal rows as one, staged."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, grams = [], []
            for key, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own = np.concatenate([np.zeros(0, np.uint64), *shared.value.held(word_hashes(text))])
                if len(own):
                    keys.append(key)
                    grams.append(own.view(np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(grams, pa.list_(pa.int64()))], names=["key", "grams"])

    return stage(_keyed(docs).mapInArrow(run, "key long, grams array<long>").dropDuplicates(["key"]), "held")


def _candidates(held: DataFrame, index: Index) -> DataFrame:
    """``h``: keys of the texts that are a candidate with some item, staged."""
    shared = held.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = shared.value.by_size
        for batch in batches:
            keep = []
            for grams in batch.column(1).to_pylist():
                own = np.sort(np.array(grams, np.int64).view(np.uint64))
                held = [own[g[np.minimum(np.searchsorted(g, own), len(g) - 1)] == own] for g, *_ in sizes.values()]
                keep.append(bool(len(shared.value.candidates(held))))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], names=["h"])

    return stage(held.mapInArrow(run, "h long"), "candidates")


def _passages(docs: DataFrame, index: Index, wanted: DataFrame) -> DataFrame:
    """Where the texts of candidates (by key, in ``wanted``) hold n-grams of their items: one row per passage."""
    spark = docs.sparkSession
    shared, likely = spark.sparkContext.broadcast(index), spark.sparkContext.broadcast(bitmap(wanted))
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("item_id", pa.int64()), ("at", pa.int64()), ("words", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            rows = []
            batch = batch.filter(pa.array(likely.value.has(batch.column(1).to_numpy())))
            for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                w = word_hashes(text)
                chosen = index.candidates(index.held(w))
                if not len(chosen):
                    continue
                place, owner, gram, seed = index.hits(w, chosen)
                for i, first, last, hits in _clusters(place, owner, index.lengths):
                    if seed[hits].any() or len(np.unique(gram[hits])) >= ENOUGH * index.n_grams[i]:
                        a, b = max(0, first - int(index.lengths[i])), min(len(w), last + 2 * int(index.lengths[i]))
                        rows.append((doc_id, key, int(index.ids[i]), a, w[a:b].view(np.int64)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return _keyed(docs).mapInArrow(run, "doc_id long, key long, item_id long, at long, words array<long>")


def _aligned(passages: DataFrame, items: pd.DataFrame, min_score: float) -> DataFrame:
    by_id = {int(i): word_hashes(t) for i, t in zip(items["item_id"], items["text"])}
    words = passages.sparkSession.sparkContext.broadcast(by_id)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, key, item_id, at, passage in zip(*(c.to_pylist() for c in batch.columns)):
                item = words.value[item_id]
                score, first, last = align(item, np.array(passage, np.int64).view(np.uint64))
                share = score / (MATCH * len(item))
                if share >= min_score:
                    rows.append((doc_id, key, item_id, share, at + first, at + last))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.float64()] + [pa.int64()] * 2)],
                    names=["doc_id", "key", "item_id", "score", "first_word", "last_word"],
                )

    return passages.select("doc_id", "key", "item_id", "at", "words").mapInArrow(
        run, "doc_id long, key long, item_id long, score double, first_word long, last_word long"
    )


def matches(docs: DataFrame, benchmark: DataFrame, n: int = N, min_score: float = MIN_SCORE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Passages of test items in documents: ``doc_id, key, item_id, score, first_word, last_word, n_passages``, one
    row per document and item at ``min_score`` or more, with the place of the best passage (words from 0).

    ``key`` is the hash of ``doc_id`` and text, for rows whose id is null or repeated; rows equal in both count as
    one. Items that are null, without words or without an id are left out, of repeated item ids the one with the
    smallest text holds; an item under ``n`` words is one gram. Null and empty texts match nothing. Other columns
    of either input are not used. Empty inputs give no rows.
    """
    known = benchmark.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull()).groupBy(F.col("item_id").cast("long")).agg(F.min("text").alias("text"))
    if int(known.agg(F.sum(F.length("text"))).first()[0] or 0) <= block_bytes:
        blocks = _blocks(known.toPandas().sort_values("item_id"), block_bytes)
    else:
        blocks = _streamed(known, block_bytes)
    out = None
    for items in blocks:
        index = Index(items, n)
        held = _held(docs, index)
        # no more rows than the block has n-grams
        df = held.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("df")).toPandas()
        index.seed(df["gram"].to_numpy(np.int64).view(np.uint64), df["df"].to_numpy(np.int64))
        passages = stage(_passages(docs, index, _candidates(held, index)), "passages")
        n_tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = _aligned(passages.repartition(n_tasks), items, min_score)
        found = found.groupBy("doc_id", "key", "item_id").agg(
            F.max(F.struct("score", (-F.col("first_word")).alias("f"), "last_word")).alias("best"), F.count(F.lit(1)).alias("n_passages")
        ).select("doc_id", "key", "item_id", "best.score", (-F.col("best.f")).alias("first_word"), "best.last_word", "n_passages")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = docs.sparkSession.createDataFrame(
            [], "doc_id long, key long, item_id long, score double, first_word long, last_word long, n_passages long"
        )
    return out


def _streamed(items: DataFrame, block_bytes: int) -> Iterator[pd.DataFrame]:
    """Blocks of a benchmark larger than one, read partition by partition."""
    rows, size = [], 0
    for r in items.toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        size += len(r["text"])
        if size >= block_bytes:
            yield pd.DataFrame(rows, columns=["item_id", "text"])
            rows, size = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=["item_id", "text"])


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that hold a passage of a test item; all columns of the input, whatever their names,
    repeated rows as often as they came."""
    hit = matches(docs, benchmark, **options).select("key").distinct()
    return docs.join(hit, F.xxhash64(docs["doc_id"], docs["text"]) == hit["key"], "left_anti")
