"""Removing every byte of a repeated 400-byte string, by a difference cover of the suffixes.

Two equal strings start anywhere, so comparing all suffixes would move every byte of the corpus many times over. A
difference cover D modulo v has, for any two positions i and j, a shift d < v that takes both into D: it is enough to
sample the suffixes at positions in D, 14 of every 183.

1. Sampled suffixes are named by triples: three symbols of equal length, each a hash of its bytes, as many as fit
   what is left of a 400-byte string after the largest shift. Names are sorted by name range, adjacent ones compared:
   those that stand alone cannot be part of a repeat, whatever follows. That leaves the texts' repeated parts.
2. The recursion needs one level, since order beyond 400 bytes does not matter: every suffix from which a surviving
   sample can be reached, sampled or not, is merged in under the name of its first 400 bytes.
3. The names are sorted again, range by range, and adjacent prefixes compared. A start with an equal neighbour is
   repeated; the 400 bytes from it go.

Texts are packed into blocks, rows of some megabytes, in a table bucketed by block. A block sends each distinct name
once to the name's range and gets a bit per name back, so a name that a third of the corpus holds costs each range one
entry per block; texts are never shuffled. Whole texts that are equal are named too, and one of each speaks for all.

Names of starts are 64 bits wide and compared within a range that a second hash chooses: two different strings
meet with a chance under 2^-70 per pair. Names of samples only choose candidates.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import mix64, partitions
from starmart.session import scratch_dir, stage

LENGTH = 400
# A perfect difference set modulo 183 (every other residue is the difference of one pair).
COVER = (0, 1, 3, 16, 23, 28, 42, 76, 82, 86, 119, 137, 154, 175)
PERIOD = 183
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Positions hashed at once.
SEGMENT = 1 << 19
SAMPLE, START, WHOLE = 0, 1, 2
_SAMPLE_BYTES = 6

BLOCKS = "block long, text binary, ids array<long>, lengths array<long>"
MESSAGES = "bucket int, kind int, block long, names binary"
ANSWERS = "block long, kind int, bucket int, twice binary, leads binary"


class Rolling:
    """Hashes of all strings of some lengths in a buffer, from prefix sums modulo 2^64."""

    def __init__(self, reach: int, seed: int):
        rng = np.random.default_rng(seed)
        self.table = rng.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
        base = int(rng.integers(0, 2**62)) * 8 + 5
        n = SEGMENT + reach
        self.power, self.inverse = (np.full(n, b % 2**64, np.uint64) for b in (base, pow(base, -1, 2**64)))
        self.power[0] = self.inverse[0] = 1
        np.multiply.accumulate(self.power, out=self.power)
        np.multiply.accumulate(self.inverse, out=self.inverse)

    def sums(self, part: np.ndarray) -> np.ndarray:
        out = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(self.table[part] * self.power[: len(part)], out=out[1:])
        return out

    def at(self, sums: np.ndarray, where: np.ndarray, length: int) -> np.ndarray:
        return mix64((sums[where + length] - sums[where]) * self.inverse[where])


def _by_segment(buffer: np.ndarray, where: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray, slice]]:
    """The parts of a buffer that hold sorted positions, with the positions in each; parts overlap by ``reach``."""
    at = 0
    while at < len(where):
        first = int(where[at])
        end = int(np.searchsorted(where, first + SEGMENT))
        yield buffer[first : first + SEGMENT + reach], where[at:end] - first, slice(at, end)
        at = end


def symbol_length(length: int, period: int) -> int:
    return (length - period + 1) // 3


def sample_places(starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The sampled positions of the texts that lie between ``starts``: those whose place in their text is in the cover,
    and from which a triple fits. Texts under ``length`` have none."""
    reach, cover, out = 3 * symbol_length(length, PERIOD), np.array(COVER), []
    pattern = np.zeros(0, np.int64)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= length:
            while not len(pattern) or pattern[-1] < b - a:
                more = len(pattern) // len(cover)
                pattern = np.concatenate([pattern, *(cover + PERIOD * k for k in range(more, 2 * more + 64))])
            out.append(a + pattern[: np.searchsorted(pattern, b - a - reach, side="right")])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def sample_names(buffer: np.ndarray, where: np.ndarray, rolling: Rolling, length: int = LENGTH) -> np.ndarray:
    """The triple name of each sampled position."""
    symbol, out = symbol_length(length, PERIOD), np.zeros(len(where), np.uint64)
    for part, at, to in _by_segment(buffer, where, 3 * symbol):
        sums = rolling.sums(part)
        name = rolling.at(sums, at, symbol)
        for k in (1, 2):
            name = mix64(name * np.uint64(0x9E3779B97F4A7C15) + rolling.at(sums, at + k * symbol, symbol))
        out[to] = name
    return out


def start_names(buffer: np.ndarray, where: np.ndarray, first: Rolling, second: Rolling, length: int = LENGTH):
    """Two independent hashes of the ``length`` bytes from each position."""
    a, b = np.zeros(len(where), np.uint64), np.zeros(len(where), np.uint64)
    for part, at, to in _by_segment(buffer, where, length):
        a[to] = first.at(first.sums(part), at, length)
        b[to] = second.at(second.sums(part), at, length)
    return a, b


def ranged(name: np.ndarray, chooser: np.ndarray, buckets: int):
    """Distinct names by range: ``(name, bucket, of, count)``, sorted by bucket and name, ``of`` the index of each
    input's name and ``count`` how often it occurs."""
    distinct, first, of, count = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
    bucket = (chooser[first] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return distinct[order], bucket[order], place[of], count[order]


class Block:
    """A block's texts and what its names say; every method gives the same for the same block, wherever it runs."""

    def __init__(self, text, lengths: list[int], buckets: int, length: int):
        self.buffer = np.frombuffer(text, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64))]).astype(np.int64)
        self.buckets, self.length = buckets, length
        reach = max(length, 3 * symbol_length(length, PERIOD))
        self.first, self.second = rollings(reach)

    def samples(self):
        where = sample_places(self.starts, self.length)
        # distinct by all 64 bits; a message carries the lower six bytes, and two names that share those in one range
        # only leave a candidate too many
        name = sample_names(self.buffer, where, self.first, self.length)
        return where, ranged(name, mix64(name), self.buckets)

    def whole(self):
        """Names of the whole texts that are long enough; 0 and -1 stand for shorter ones."""
        long_ = np.flatnonzero(np.diff(self.starts) >= self.length)
        view = self.buffer.data
        name = [xxhash.xxh3_128_intdigest(view[self.starts[i] : self.starts[i + 1]]) for i in long_]
        a = np.array([x & (2**64 - 1) for x in name], np.uint64)
        return long_, ranged(a, np.array([x >> 64 for x in name], np.uint64), self.buckets)

    def removed_texts(self, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Texts that occur elsewhere as a whole, and those of them whose starts another text names."""
        long_, (_, bucket, of, count) = self.whole()
        twice, leads = bits(answers, WHOLE, bucket)
        n = len(self.starts) - 1
        gone, silent = np.zeros(n, bool), np.zeros(n, bool)
        gone[long_] = (twice | (count > 1))[of] if len(of) else False
        # within the block the first of equal texts speaks, if no earlier block has the text
        speaker = np.zeros(len(long_), bool)
        if len(of):
            speaker[np.unique(of, return_index=True)[1]] = True
            speaker &= (leads | ~twice)[of]
        silent[long_] = gone[long_] & ~speaker
        return gone, silent

    def candidates(self, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Starts that may be repeated and are to be named, and the texts that are removed as a whole."""
        where, (_, bucket, of, count) = self.samples()
        twice, _ = bits(answers, SAMPLE, bucket)
        gone, silent = self.removed_texts(answers)
        hit = where[(twice | (count > 1))[of]] if len(of) else where
        text = np.searchsorted(self.starts, hit, side="right") - 1
        hit, text = hit[~silent[text]], text[~silent[text]]
        low = np.maximum(self.starts[text], hit - (PERIOD - 1))
        high = np.minimum(hit, self.starts[text + 1] - self.length) + 1
        fits = low < high
        change = np.zeros(len(self.buffer) + 2, np.int32)
        np.add.at(change, low[fits], 1)
        np.add.at(change, high[fits], -1)
        return np.flatnonzero(np.cumsum(change)[: len(self.buffer)] > 0), gone

    def repeated(self, answers: dict) -> tuple[np.ndarray, np.ndarray]:
        """Starts of repeated strings, and the texts that are removed as a whole."""
        where, gone = self.candidates(answers)
        _, bucket, of, count = self.named(where)
        twice, _ = bits(answers, START, bucket)
        return (where[(twice | (count > 1))[of]] if len(of) else where), gone

    def named(self, where: np.ndarray):
        name, chooser = start_names(self.buffer, where, self.first, self.second, self.length)
        return ranged(name, chooser, self.buckets)


_ROLLINGS: dict[int, tuple[Rolling, Rolling]] = {}


def rollings(reach: int) -> tuple[Rolling, Rolling]:
    if reach not in _ROLLINGS:
        _ROLLINGS[reach] = Rolling(reach, 1), Rolling(reach, 2)
    return _ROLLINGS[reach]


def bits(answers: dict, kind: int, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The answered bits of a block's names, which are sorted by bucket."""
    twice, leads = np.zeros(len(bucket), bool), np.zeros(len(bucket), bool)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else []
    for a, b in zip(edges[:-1], edges[1:]):
        two, lead = answers[kind, int(bucket[a])]
        twice[a:b] = np.unpackbits(np.frombuffer(two, np.uint8), count=b - a).astype(bool)
        leads[a:b] = np.unpackbits(np.frombuffer(lead, np.uint8), count=b - a).astype(bool)
    return twice, leads


def _messages(block: int, kind: int, name: np.ndarray, bucket: np.ndarray) -> pa.RecordBatch:
    width = _SAMPLE_BYTES if kind == SAMPLE else 8
    raw = np.ascontiguousarray(name.view(np.uint8).reshape(-1, 8)[:, :width])
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, int)
    n = len(edges) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(bucket[e]) for e in edges[:-1]], pa.int32()), pa.array([kind] * n, pa.int32()),
            pa.array([block] * n, pa.int64()), pa.array([raw[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        ],
        names=["bucket", "kind", "block", "names"],
    )


def _answer(rows: list[tuple[int, int, bytes]]) -> Iterator[tuple]:
    """For the messages ``(kind, block, names)`` of one bucket, sorted: which names another block has too, and which
    of those no earlier block has."""
    for kind in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == kind]
        width = _SAMPLE_BYTES if kind == SAMPLE else 8
        size = [len(r[2]) // width for r in own]
        wide = np.zeros((sum(size), 8), np.uint8)
        wide[:, :width] = np.frombuffer(b"".join(r[2] for r in own), np.uint8).reshape(-1, width)
        name = wide.view(np.uint64).ravel()
        order = np.argsort(name, kind="stable")
        ranked = name[order]
        same = np.concatenate([[False], ranked[1:] == ranked[:-1], [False]])
        twice, leads = np.zeros(len(name), bool), np.zeros(len(name), bool)
        twice[order] = same[1:] | same[:-1]
        leads[order] = same[1:] & ~same[:-1]
        at = 0
        for (_, block, _), n in zip(own, size):
            yield block, kind, np.packbits(twice[at : at + n]).tobytes(), np.packbits(leads[at : at + n]).tobytes()
            at += n


def _answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket, kind and block; a bucket's messages are compared when all are there."""

    def close(bucket, rows):
        out = [(block, kind, bucket, a, b) for block, kind, a, b in _answer(rows)]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["block", "kind", "bucket", "twice", "leads"])

    now, rows = None, []
    for batch in batches:
        for bucket, kind, block, names in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != now:
                if rows:
                    yield close(now, rows)
                now, rows = bucket, []
            rows.append((kind, block, names))
    if rows:
        yield close(now, rows)


def _packed(docs: DataFrame, block_bytes: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, size, ids, texts = TaskContext.get().partitionId() << 32, 0, [], []

        def close():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()), pa.array([b"".join(texts)], pa.binary()),
                    pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                ],
                names=["block", "text", "ids", "lengths"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if texts and size + len(text) > block_bytes:
                    yield close()
                    number, size, ids, texts = number + 1, 0, [], []
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        if texts:
            yield close()

    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInArrow(run, BLOCKS)


def _answered(messages: DataFrame, n: int) -> DataFrame:
    """Answers per block, staged: ``block, answers`` with one entry per kind and bucket."""
    ranges = messages.repartition(n, "bucket").sortWithinPartitions("bucket", "kind", "block")
    return stage(ranges.mapInArrow(_answers, ANSWERS), "answers").groupBy("block").agg(
        F.collect_list(F.struct("kind", "bucket", "twice", "leads")).alias("answers")
    )


def _known(cell) -> dict:
    return {(x["kind"], x["bucket"]): (x["twice"], x["leads"]) for x in (cell.as_py() or [])}


def without_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_bytes long, n_removed long, n_spans long, spans array<struct<first long, last long>>, kept
    binary`` of every row: its text's UTF-8 bytes without those that a repeated string of ``length`` bytes covers.

    A string is repeated if it starts anywhere else too, in the same text (overlapping or not) or in another row's;
    strings do not cross texts, and are judged on the input. Spans are the maximal removed runs, ``last`` excluded.
    Null texts count as empty; texts under ``length`` bytes stay whole. Equal rows are texts of their own, so each
    makes the other repeated. Null ids are kept. Only ``doc_id`` and ``text`` are used. No rows in, no rows out.
    ``length`` is 300 at least, so that samples of the cover are longer than stock phrases.
    """
    if length < PERIOD + 117:
        raise ValueError("length is under 300")
    spark = docs.sparkSession
    n = partitions(docs)
    buckets = 4 * n
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    name = f"starmart_blocks_{uuid.uuid4().hex}"
    writer = _packed(docs, block_bytes).write.option("path", scratch_dir(spark, "blocks")).option("compression", "zstd")
    writer.format("parquet").bucketBy(n, "block").saveAsTable(name)
    blocks = spark.table(name)

    def say_samples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, text, lengths in zip(*batch.columns):
                b, number = Block(text.as_buffer(), lengths.as_py(), buckets, length), block.as_py()
                _, (names, bucket, _, _) = b.samples()
                yield _messages(number, SAMPLE, names, bucket)
                _, (names, bucket, _, _) = b.whole()
                yield _messages(number, WHOLE, names, bucket)

    samples = _answered(blocks.select("block", "text", "lengths").mapInArrow(say_samples, MESSAGES), n)

    def say_starts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, text, lengths, answers in zip(*batch.columns):
                b = Block(text.as_buffer(), lengths.as_py(), buckets, length)
                where, _ = b.candidates(_known(answers))
                names, bucket, _, _ = b.named(where)
                yield _messages(block.as_py(), START, names, bucket)

    told = blocks.join(samples.hint("shuffle_merge"), "block", "left")
    starts = _answered(told.select("block", "text", "lengths", "answers").mapInArrow(say_starts, MESSAGES), n)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
        types = [pa.int64()] * 4 + [pa.list_(span), pa.binary()]
        columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
        for batch in batches:
            for text, ids, lengths, one, two in zip(*batch.columns):
                b = Block(text.as_buffer(), lengths.as_py(), buckets, length)
                where, gone = b.repeated(_known(one) | _known(two))
                edges, view, rows = np.searchsorted(where, b.starts), text.as_buffer(), []
                for i, doc_id in enumerate(ids.as_py()):
                    a, z = int(b.starts[i]), int(b.starts[i + 1])
                    own = where[edges[i] : edges[i + 1]] - a
                    if gone[i]:
                        spans = [(0, z - a)]
                    elif len(own):
                        new = np.flatnonzero(own[1:] - own[:-1] > length) + 1
                        firsts, lasts = own[np.concatenate([[0], new])], own[np.concatenate([new - 1, [len(own) - 1]])] + length
                        spans = list(zip(firsts.tolist(), lasts.tolist()))
                    else:
                        spans = []
                    cuts = [0, *(x for s in spans for x in s), z - a]
                    kept = b"".join(bytes(view[a + x : a + y]) for x, y in zip(cuts[::2], cuts[1::2]))
                    rows.append((doc_id, z - a, z - a - len(kept), len(spans), [{"first": x, "last": y} for x, y in spans], kept))
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=columns)

    whole = told.withColumnRenamed("answers", "one").join(starts.withColumnRenamed("answers", "two").hint("shuffle_merge"), "block", "left")
    return whole.select("text", "ids", "lengths", "one", "two").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<first:long,last:long>>, kept binary"
    )
