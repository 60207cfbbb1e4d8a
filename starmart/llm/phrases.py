"""Phrase collocations from a weighted de Bruijn graph of word grams.

Nodes are grams of four words, edges the grams of five that overlap in them. Every task builds the graph of its own
text: equal edges become one with a weight, and a chain whose inner nodes have one way in and one way out becomes one
compact path. The paths of all tasks, and the ends of pieces, are all that the counts are taken from. An occurrence of
a gram of four words or fewer begins either an occurrence of a longer one or the end of a piece, so

    f(gram) = flow out of it (the sum of the longer grams it begins) + the pieces that end with it,

from five words down to two. Counts are exact. What is left out is only what cannot be part of a candidate: a word or
a pair of words met fewer than ``least`` times ends a piece. Both are told by bitmaps with false positives but no
false negatives and of a bounded size, so a full bitmap leaves out less and changes no result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.bitmaps import Bitmap, bitmap
from starmart.llm.common import BATCH_ROWS, mix64
from starmart.session import stage

#: A phrase has two to this many words.
LONGEST = 5
LEAST, FIRST_ROWS = 100, 2_000
#: Words of a task's text that one local graph holds.
GRAPH_WORDS = 1 << 19
#: Different words that a task holds to count them, or whose hashes it remembers.
HELD_WORDS = 1 << 18
#: Edges of a path, words of paths in one stored row (and one path more), and words of stored rows that are looked at
#: together. An Arrow batch holds ``BATCH_ROWS`` rows, by which a row's size sets what JVM and worker hold of it.
ROW_WORDS, SLICE_WORDS = 1 << 9, 1 << 19
#: Distinct pairs that a task holds to add up before they are shuffled.
HELD_GRAMS = 1 << 18
#: A word, or a character that ends a piece.
_TOKENS, _WORDS = re.compile(rb"[^.,;:!?\x0A-\x0D\x20\x09]+|[.,;:!?\x0A-\x0D]"), re.compile(rb"[^.,;:!?\x0A-\x0D\x20\x09]+")
_ENDS = b".,;:!?\n\x0b\x0c\r"
_W = [f"w{i}" for i in range(1, LONGEST + 1)]


def word_hash(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed) or 1  # 0 ends a piece


class _Hashes(dict):
    """The hash of each token met; 0 for one that ends a piece."""

    def __init__(self, seed: int):
        self.seed = seed

    def __missing__(self, token: bytes) -> int:
        self[token] = out = 0 if token in _ENDS else word_hash(token, self.seed)
        return out


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def word_counts(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``lang, word binary, h long, f long``: every word of each language, its hash and its count."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            for lang, words in counts.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()),
                        pa.array(np.array([word_hash(w, seed) for w in words], np.uint64).view(np.int64)),
                        pa.array(list(words.values()), pa.int64()),
                    ],
                    names=["lang", "word", "h", "f"],
                )
            counts.clear()

        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[lang].update(_WORDS.findall(raw.lower()))
            if sum(map(len, counts.values())) > HELD_WORDS:
                yield from flush()
        yield from flush()

    found = _texts(docs).mapInArrow(run, "lang string, word binary, h long, f long")
    return found.groupBy("lang", "word", "h").agg(F.sum("f").alias("f"))


def lang_hash(lang: str) -> np.uint64:
    """What Spark's ``xxhash64`` gives for it."""
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 42))


def gram_hash(words: np.ndarray, upto: int) -> np.ndarray:
    """A hash of the first ``upto`` columns, for grouping grams inside one task and for bitmaps."""
    h = np.zeros(len(words), np.uint64)
    for i in range(upto):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + words[:, i].view(np.uint64) + np.uint64(i + 1))
    return h


def grouped(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first place of each distinct row, the number of each row's group, and the rows of each group. Rows are sorted
    by hash; should two different ones meet, by all their words."""
    out = np.unique(gram_hash(grams, grams.shape[1]), return_index=True, return_inverse=True, return_counts=True)[1:]
    if len(grams) and not (grams[out[0]][out[1]] == grams).all():
        out = np.unique(grams, axis=0, return_index=True, return_inverse=True, return_counts=True)[1:]
    return out[0], out[1].reshape(-1), out[2]


def local_graph(run: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """The compact graph of a stream of word hashes in which 0 ends a piece (also the last one).

    Two rows of ``words, weights, is_end``, ``words`` holding paths that a 0 closes, ``weights`` one number a path. First
    the paths of edges (m + 4 words are a path of m edges). Then the ends of pieces, four words each or the whole piece,
    with the number of pieces that end so.

    A path goes on from an edge to the next where each follows or precedes no other: both have one weight, and all of
    it passes from one to the other. The first occurrences of a path's edges therefore stand one after another in the
    stream, and the path is read off there. One of more than ``ROW_WORDS`` edges is laid out as several.
    """
    n, node, out = len(run), LONGEST - 1, []
    ext = np.concatenate([run, np.zeros(LONGEST, np.int64)])
    grams = np.lib.stride_tricks.sliding_window_view(ext, LONGEST)[:n]
    at = np.flatnonzero((grams != 0).all(1))
    if len(at):
        first, of, weight = grouped(np.ascontiguousarray(grams[at]))
        next_to = np.append(np.diff(at) == 1, False)  # the next edge of the stream overlaps this one
        follows = np.where(next_to, np.append(of[1:], -1), -1)
        passes = np.bincount(of, follows == follows[first][of], len(weight)).astype(np.int64)
        then = follows[first]
        unary = (then >= 0) & (passes == weight) & (weight[then] == weight)
        starts = np.sort(first)
        heads, place = np.append(True, ~unary[of[starts]][:-1]), np.arange(len(starts))
        heads |= (place - np.maximum.accumulate(np.where(heads, place, 0))) % ROW_WORDS == 0
        begins, edges = starts[heads], np.diff(np.append(np.flatnonzero(heads), len(starts)))
        out.append((*_laid_out(ext, at[begins], edges + node), weight[of[begins]], False))
    stop = np.flatnonzero((run != 0) & (ext[1 : n + 1] == 0))
    if len(stop):
        before = np.concatenate([np.zeros(node, np.int64), run])
        last = np.stack([before[stop + i] for i in range(1, node + 1)], 1)  # the four words up to and with the last
        for i in range(node - 2, -1, -1):  # nothing from before a 0 belongs to the piece
            last[:, i] *= last[:, i + 1] != 0
        first, _, count = grouped(last)
        length = (last[first] != 0).sum(1)
        out.append((*_laid_out(ext, stop[first] + 1 - length, length), count, True))
    return out


def _laid_out(ext: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of a stream one after another, each closed by a 0, and where each ends."""
    ends = np.cumsum(length + 1)
    place = np.repeat(begin - (ends - length - 1), length + 1) + np.arange(int(ends[-1]))
    words = ext[np.minimum(place, len(ext) - 1)]
    words[ends - 1] = 0
    return words, ends


_GRAPH = "lang string, words array<long>, weights array<long>, is_end boolean"


def graph(docs: DataFrame, frequent: Bitmap, seed: int = 0) -> DataFrame:
    """The compact local graphs of all tasks, pieces ending at words that are not ``frequent``."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = defaultdict(list), 0, _Hashes(seed)

        def flush():
            for lang, parts in held.items():
                stream = np.concatenate(parts)
                stream = np.where(shared.value.has(stream.view(np.uint64) ^ lang_hash(lang)) & (stream != 0), stream, 0)
                stream = stream[(stream != 0) | (np.append(0, stream[:-1]) != 0)]
                for words, ends, weights, is_end in local_graph(stream):
                    row = np.append(0, np.flatnonzero(np.diff((ends - 1) // ROW_WORDS)) + 1)  # paths that begin a row
                    offsets = np.append(np.append(0, ends)[row], len(words)).astype(np.int32)
                    rows = pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(row), pa.string()),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(words)),
                            pa.ListArray.from_arrays(pa.array(np.append(row, len(weights)).astype(np.int32)), pa.array(weights)),
                            pa.array([is_end] * len(row)),
                        ],
                        names=["lang", "words", "weights", "is_end"],
                    )
                    for first in range(0, len(row), BATCH_ROWS):
                        yield rows.slice(first, BATCH_ROWS)
            held.clear()

        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = _TOKENS.findall(raw.lower())
                if tokens:
                    held[lang].append(np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens)).view(np.int64))
                    held[lang].append(np.zeros(1, np.int64))
                    size += len(tokens)
                if size > GRAPH_WORDS:
                    yield from flush()
                    size = 0
                if len(known) > HELD_WORDS:
                    known.clear()
        yield from flush()

    return _texts(docs).mapInArrow(run, _GRAPH)


def _walk(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, list[str], np.ndarray, np.ndarray]]:
    """Stored rows, some at a time: all their words, at each word the language's number, the languages, the weight, and
    whether an occurrence that begins there is counted (in a path the last four words belong to whatever follows)."""
    size = np.cumsum(batch.column(1).value_lengths().to_numpy())
    cuts = np.append(0, np.flatnonzero(np.diff((size - 1) // SLICE_WORDS)) + 1)
    for lo, hi in zip(cuts, np.append(cuts[1:], batch.num_rows)):
        part = batch.slice(lo, hi - lo)
        stream, weights = (part.column(i).flatten().to_numpy() for i in (1, 2))
        zeros = np.flatnonzero(stream == 0)
        length = np.diff(np.append(-1, zeros))  # of each path with its 0
        left = np.repeat(zeros, length) - np.arange(len(stream))
        row = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy())
        names, code = _lang_codes(part.column(0).to_pylist())
        is_end = part.column(3).to_numpy(zero_copy_only=False)
        counted = (left > 0) & (is_end[row] | (left >= LONGEST))
        yield stream, code[row], names, np.repeat(weights, length), counted


class _Sums:
    """Rows with numbers, equal rows as one with their sum, over as many as a task may hold."""

    def __init__(self):
        self.rows, self.numbers, self.size = [], [], 0

    def add(self, row: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What has to leave for the new rows."""
        self.rows, self.numbers, self.size = [*self.rows, row], [*self.numbers, number], self.size + len(row)
        if self.size > HELD_GRAMS:
            row, number = self._summed()
            if len(row) > HELD_GRAMS // 2:
                yield row, number
                row, number = row[:0], number[:0]
            self.rows, self.numbers, self.size = [row], [number], len(row)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.size:
            yield self._summed()

    def _summed(self) -> tuple[np.ndarray, np.ndarray]:
        every, number = np.concatenate(self.rows), np.concatenate(self.numbers)
        first, of, _ = grouped(every)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, of, number)
        return every[first], total


def _lang_codes(langs: list[str]) -> tuple[list[str], np.ndarray]:
    names = sorted(set(langs))
    number = {x: i for i, x in enumerate(names)}
    return names, np.array([number[x] for x in langs], np.int64)


def frequent_pairs(paths: DataFrame, least: int) -> DataFrame:
    """``h``: hashes, with that of the language, of the pairs of consecutive words met ``least`` times or more.

    Pairs are counted by their hash: should two meet, they count together and one too many is taken for frequent.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(h: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[:, 0])), pa.array(f)], names=["h", "f"])

        sums = _Sums()
        for batch in batches:
            for stream, lang, names, weight, counted in _walk(batch) if batch.num_rows else ():
                at = np.flatnonzero(counted[:-1] & (stream[1:] != 0))
                mixed = np.array([lang_hash(x) for x in names], np.uint64)[lang[at]]
                h = gram_hash(np.stack([stream[at], stream[at + 1]], 1), 2) ^ mixed
                for full in sums.add(h.view(np.int64)[:, None], weight[at]):
                    yield rows(*full)
        for full in sums.rest():
            yield rows(*full)

    found = paths.mapInArrow(run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))
    return found.filter(F.col("f") >= least).select("h")


def runs(paths: DataFrame, pairs: Bitmap) -> DataFrame:
    """``lang, words array<long>, begins int, f long``: the parts of paths, and of the ends of pieces, whose consecutive
    words are frequent pairs; places are counted from the first ``begins`` words on.

    A part is one row, whatever its length. Most are a pair and no more: equal ones of a task are added up.
    """
    shared = paths.sparkSession.sparkContext.broadcast(pairs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(langs: np.ndarray, words: np.ndarray, ends: np.ndarray, begins: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            lang = pa.DictionaryArray.from_arrays(pa.array(langs.astype(np.int32)), pa.array(list(known), pa.string()))
            held = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(words))
            columns = [lang.cast(pa.string()), held, pa.array(begins.astype(np.int32)), pa.array(f)]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "words", "begins", "f"])

        def alone(two: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            return rows(two[:, 0], two[:, 1:].ravel(), np.arange(2, 2 * len(two) + 1, 2), np.ones(len(two)), f)

        known: dict[str, int] = {}
        sums = _Sums()
        for batch in batches:
            for stream, lang, names, weight, counted in _walk(batch) if batch.num_rows else ():
                at = np.flatnonzero((stream[:-1] != 0) & (stream[1:] != 0))
                mixed = np.array([lang_hash(x) for x in names], np.uint64)[lang[at]]
                goes_on = np.zeros(len(stream), bool)
                goes_on[at] = shared.value.has(gram_hash(np.stack([stream[at], stream[at + 1]], 1), 2) ^ mixed)
                edge = np.diff(np.concatenate([[0], goes_on, [0]]))
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # a part's last word goes on no further
                so_far = np.append(0, np.cumsum(counted))
                begins = so_far[last] - so_far[first]  # a path's places that are not counted are its last
                first, last, begins = (x[begins > 0] for x in (first, last, begins))
                code = np.array([known.setdefault(x, len(known)) for x in names], np.int64)[lang[first]]
                length = np.minimum(last - first + 1, begins + LONGEST - 1)
                pair = length == 2
                for full in sums.add(np.stack([code, stream[first], stream[first + 1]], 1)[pair], weight[first][pair]):
                    yield alone(*full)
                code, first, length, begins = (x[~pair] for x in (code, first, length, begins))
                ends = np.cumsum(length)
                place = np.repeat(first - (ends - length), length) + np.arange(length.sum())
                yield rows(code, stream[place], ends, begins, weight[first])
        for full in sums.rest():
            yield alone(*full)

    return paths.mapInArrow(run, "lang string, words array<long>, begins int, f long")


def starts(paths: DataFrame, pairs: Bitmap) -> DataFrame:
    """``lang, w1..w5, f``: for every place of the text the longest gram of up to five words that begins there, by
    count: an edge, or, where the piece ends or a pair is not frequent, a shorter gram filled up with zeros. Grams of
    one word are left out (``word_counts`` has them)."""
    each = runs(paths, pairs).select("lang", "words", "f", F.explode(F.sequence(F.lit(0), F.col("begins") - 1)).alias("at"))
    grams = [F.coalesce(F.get("words", F.col("at") + i), F.lit(0)).alias(w) for i, w in enumerate(_W)]
    return each.select("lang", *grams, "f").groupBy("lang", *_W).agg(F.sum("f").alias("f"))


def flows(longest: DataFrame, least: int) -> DataFrame:
    """``lang, size, w1..w5, f``: all grams of two to five words met ``least`` times or more, staged.

    From the longest grams down: the count of a gram is the flow of the grams that it begins, and of those that end
    with it.
    """
    level, out = longest, None
    for k in range(LONGEST, 1, -1):
        if k < LONGEST:
            level = level.groupBy("lang", *_W[:k]).agg(F.sum("f").alias("f"))
        if k > 2:
            level = stage(level, f"grams{k}")
        padded = [F.col(w) if i < k else F.lit(0).cast("long").alias(w) for i, w in enumerate(_W)]
        have = level.filter((F.col(_W[k - 1]) != 0) & (F.col("f") >= least)).select("lang", F.lit(k).alias("size"), *padded, "f")
        out = have if out is None else out.unionByName(have)
    return stage(out, "frequent")


def _shift(first: int, size: Column) -> list[Column]:
    """The words from place ``first`` on, as w1..w5 filled up with zeros."""
    return [F.col(_W[i + first]) if i + first < LONGEST else F.lit(0).cast("long") for i in range(LONGEST)]


def maximal(frequent: DataFrame) -> DataFrame:
    """The grams that no longer one with the same count holds.

    A gram is met as often as any longer one at least; of the longer ones with its count the next longer ones, by one
    word before or behind, are enough to ask.
    """
    longer = frequent.filter("size > 2")
    size = F.col("size")
    begin = [F.when(F.lit(i + 1) < size, F.col(w)).otherwise(0).alias(w) for i, w in enumerate(_W)]
    rest = [c.alias(w) for c, w in zip(_shift(1, size), _W)]
    inner = longer.select("lang", (size - 1).alias("size"), *begin, "f").unionByName(
        longer.select("lang", (size - 1).alias("size"), *rest, "f")
    )
    key = ["lang", "size", *_W]
    most = inner.groupBy(*key).agg(F.max("f").alias("longer_f"))
    return frequent.join(most, key, "left").filter("longer_f IS NULL OR longer_f < f").drop("longer_f")


def scored(candidates: DataFrame, frequent: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """Each candidate with its lowest-scoring cut: ``a, l, r, n, score``; counts of the parts come by joins."""
    key = ["lang", "size", *_W]
    known = frequent.select(*key, "f").unionByName(
        words.select("lang", F.lit(1).alias("size"), F.col("h").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in _W[1:]], "f")
    )
    held = candidates.withColumnRenamed("f", "a").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    size, cut = F.col("size"), F.col("cut")
    left = [F.when(F.lit(i) < cut, F.col(w)).otherwise(F.lit(0).cast("long")).alias(f"l{w}") for i, w in enumerate(_W)]
    array = F.array(*_W)
    right = [
        F.when(cut + i < size, F.get(array, cut + i)).otherwise(F.lit(0).cast("long")).alias(f"r{w}") for i, w in enumerate(_W)
    ]
    held = held.select(*key, "a", "cut", *left, *right)
    of = lambda side: known.select(
        F.col("lang"), F.col("size").alias(f"{side}size"), *[F.col(w).alias(f"{side}{w}") for w in _W], F.col("f").alias(side)
    )
    held = held.withColumn("lsize", cut).withColumn("rsize", size - cut)
    held = held.join(of("l"), ["lang", "lsize", *[f"l{w}" for w in _W]]).join(of("r"), ["lang", "rsize", *[f"r{w}" for w in _W]])
    held = held.join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    held = held.withColumn("above", (big("a") * big("n")).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)"))
    held = held.withColumn("below", big("l") * big("r"))
    held = held.withColumn("score", F.expr("above div below"))
    return held.groupBy(*key, "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best")).select(
        *key, "a", "n", F.col("best.l").alias("l"), F.col("best.r").alias("r"), F.col("best.score").alias("score")
    )


def _spelled(rows: DataFrame, words: DataFrame) -> DataFrame:
    """The rows with ``phrase``, their words from the table of words, joined by a space."""
    key = ["lang", "size", *_W]
    each = rows.select(*key, F.posexplode(F.filter(F.array(*_W), lambda w: w != 0)).alias("place", "h"))
    names = each.join(words.select("lang", "h", "word"), ["lang", "h"]).groupBy(*key).agg(
        *[F.max(F.when(F.col("place") == i, F.col("word").cast("string"))).alias(f"t{i}") for i in range(LONGEST)]
    )
    return rows.join(names.select(*key, F.concat_ws(" ", *[f"t{i}" for i in range(LONGEST)]).alias("phrase")), key)


def first_rows(rows: DataFrame, limit: int) -> DataFrame:
    """Each language's first rows by score, count and phrase. Every language is ranked in parts first, so that no task
    holds more than the first rows of each part."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= limit)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= limit)


def collocations(docs: DataFrame, least: int = LEAST, limit: int = FIRST_ROWS) -> DataFrame:
    """Each language's first ``limit`` phrases: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends and those into words at spaces and tabs.
    Candidates are phrases of two to five words met ``least`` times or more within pieces (``a``), but for those inside
    a longer one met as often. The score is ``floor(1000 * a * n / (l * r))`` at the lowest-scoring cut into parts met
    l and r times, n being all words of the language. A null language is ``und``, a null text empty; a repeated row
    counts again; other columns are not read. No candidates, no rows.
    """
    seed = 0
    while True:
        words = stage(word_counts(docs, seed), "words")
        if not words.groupBy("lang", "h").count().filter("count > 1").limit(1).count():
            break
        seed += 1  # two words of a language met in one hash
    common = words.filter(F.col("f") >= least)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    paths = stage(graph(docs, bitmap(common.select(F.col("h").bitwiseXOR(F.xxhash64("lang")).alias("h"))), seed), "graph")
    longest = starts(paths, bitmap(stage(frequent_pairs(paths, least), "pairs")))
    frequent = flows(longest, least)
    rows = _spelled(scored(maximal(frequent), frequent, common, totals), common)
    return first_rows(rows, limit).select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
