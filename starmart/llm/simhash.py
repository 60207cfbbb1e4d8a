"""SimHash near-duplicates through an inverted index over fingerprint bytes at their positions.

A pair of 64-bit fingerprints that differ in d bits differ in d bytes at most, so it shares 8 - d bytes or more at
their positions: with d = 3, five of eight. That least count is the filter. Posting lists of single bytes would hold
a 256th of all fingerprints each, and tallying them would cost the square of the input; the index therefore posts
each fingerprint under every set of five byte positions (56 lists), which holds just those pairs whose tally reaches
the least count. Verification then compares the bits.

Equal fingerprints are one before the index, and a list holds at most 2^24 of them, since 40 of their bits are
given. A list is searched as it streams through a task: what is found is a link of each member to the smallest one
reachable in its list, not the pairs. Links of all lists are joined into components by star contraction in Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import stage

SEED = 42
#: Runs longer than this are searched by flipping bits instead of comparing members.
LONG_RUN = 1 << 14


def shingle_hashes(raw: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of the A-Z-lowered text, repeats included; of the whole sequence if it has
    fewer words; none without words."""
    words = raw.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    runs = zip(*(words[i:] for i in range(shingle)))
    return np.array([digest(x, SEED) for x in map(b" ".join, runs)], np.uint64)


def majority_bits(h: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes; 0 for none."""
    if not len(h):
        return 0
    count = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        count += np.unpackbits(h[i : i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(h), bitorder="little").view(np.uint64)[0])


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    return majority_bits(shingle_hashes(raw, shingle))


def _binary(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id long, fp long`` (the 64 bits, signed) of every row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(raw, shingle) for raw in _binary(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def byte_masks(kept: int, width: int = 8) -> list[int]:
    """For every set of ``kept`` byte positions the signed 64-bit mask of its bytes."""
    masks = (sum(0xFF << 8 * i for i in c) for c in combinations(range(width), kept))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _flips(bits: int, within: np.ndarray) -> np.ndarray:
    one = [np.uint64(1) << np.uint64(b) for b in within]
    return np.array([np.bitwise_or.reduce(c) for n in range(1, bits + 1) for c in combinations(one, n)], np.uint64)


def run_roots(values: np.ndarray, max_bits: int) -> np.ndarray:
    """For sorted distinct values the position of the first member of their component, values linking at ``max_bits``
    differing bits or fewer."""
    n = len(values)
    root, left = np.full(n, -1), np.arange(n)
    varying = np.bitwise_or.reduce(values ^ values[0])
    bits = np.flatnonzero(np.unpackbits(np.array([varying]).view(np.uint8), bitorder="little"))
    flips = _flips(max_bits, bits) if n > LONG_RUN and len(bits) <= 24 else None
    order = np.argsort(values)
    ranked = values[order]
    for start in range(n):
        if root[start] >= 0:
            continue
        root[start] = start
        front = [start]
        left = left[left != start] if flips is None else left
        while front:
            if flips is None:
                if not len(left):
                    break
                member, front = values[front[-1]], front[:-1]
                near = np.bitwise_count(values[left] ^ member) <= max_bits
                found, left = left[near], left[~near]
            else:
                probe, front = values[front[-1]] ^ flips, front[:-1]
                at = np.minimum(np.searchsorted(ranked, probe), n - 1)
                found = order[at[ranked[at] == probe]]
                found = found[root[found] < 0]
            root[found] = start
            front += found.tolist()
    return root


def _links(max_bits: int):
    def of_runs(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        length = np.diff(edges)
        two = edges[:-1][length == 2]
        near = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= max_bits]
        a, b = [fp[near]], [fp[near + 1]]
        for i in np.flatnonzero(length > 2):
            own = fp[edges[i] : edges[i + 1]]
            root = run_roots(own.view(np.uint64), max_bits)
            moved = np.flatnonzero(root != np.arange(len(own)))
            a.append(own[root[moved]])
            b.append(own[moved])
        return np.concatenate(a), np.concatenate(b)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; the last, perhaps unfinished run of a batch waits for the next."""
        key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            last = int(np.searchsorted(key, key[-1])) if len(key) and key[0] <= key[-1] else 0
            if last:
                a, b = of_runs(key[:last], fp[:last])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                key, fp = key[last:], fp[last:]
        if len(key):
            a, b = of_runs(key, fp)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def links(distinct_fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """``a, b``: links that connect the fingerprints (a column ``fp`` of distinct values) as all pairs at ``max_bits``
    or fewer differing bits would."""
    masks = byte_masks(8 - max_bits)
    n = int(distinct_fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # each row becomes one for every list: dealt anew, for the planner puts small partitions together
    posted = distinct_fps.repartition(n, "fp").select(
        "fp", F.explode(F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])).alias("key")
    ).select("key", "fp")
    lists = posted.repartition(n, "key").sortWithinPartitions("key", "fp")
    return lists.mapInArrow(_links(max_bits), "a long, b long").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root``: for every node of the edges (``a``, ``b``) the smallest node of its component.

    Large-star and small-star steps in turn until no edge changes; each round is written to the shared folder. A
    node's neighbours are never gathered: a step takes one minimum per node and joins it back to the edges.
    """
    edges = stage(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).filter("u <> v").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        was, mark = mark, edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if was == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _with_component(fps: DataFrame, uniq: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """Of staged rows ``doc_id, key`` the smallest doc_id of each component, joined back to every row."""
    found = components(edges)
    rooted = uniq.join(found, uniq[key] == found["node"], "left").select(key, "least", F.coalesce("root", key).alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = rooted.select(key, "root").join(ids, "root").select(key, "component_id")
    return fps.join(ids, key)


def linked(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: the 64 bits as 16 hex digits, and the smallest doc_id that
    can be reached over fingerprints at most ``max_bits`` apart (its own included).

    Null and empty texts have fingerprint zero, which links like any other. Rows with a null doc_id take part in
    linking; a component without any id has a null one. Repeated rows come back repeated. Only ``doc_id`` and
    ``text`` are read; no rows in, no rows out.
    """
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    uniq = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    out = _with_component(fps, uniq, links(uniq.select("fp"), max_bits), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The input without near copies: of each group of ``linked`` rows the one with the smallest doc_id stays.

    Rows without an id stay only if their group has no id; of several rows that would stay for one group (repeated ones, or
    all without an id) the one with the smallest text does. All columns are kept, whatever their names. No rows in, no
    rows out.
    """
    names = {c.lower() for c in docs.columns}
    fp, root = ("_" * (max((len(n) for n in names), default=0) + 1) + n for n in ("fp", "root"))
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    uniq = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    found = components(links(uniq.select("fp"), max_bits))
    rooted = uniq.join(found, uniq["fp"] == found["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("stays"))
    # fingerprints whose group keeps a row of theirs, by that row's id
    keep = rooted.join(ids, "root").filter(F.col("least").eqNullSafe(F.col("stays"))).select("fp", "root", "stays")
    rows = stage(fps.join(keep, "fp").filter(F.col("doc_id").eqNullSafe(F.col("stays"))).select("doc_id", "root"), "stays")
    several = rows.groupBy("root").count().filter("count > 1").limit(1).count() or rows.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    same_id = docs["doc_id"].cast("long").eqNullSafe(F.col("_stays"))
    if not several:
        return docs.join(rows.select(F.col("doc_id").alias("_stays")), same_id, "left_semi")
    # several rows may stand for a group: fingerprint those that could stay once more, and take one
    few = docs.join(rows.select(F.col("doc_id").alias("_stays")).distinct(), same_id, "left_semi")
    marked = _beside(few, fp, shingle).join(keep.select(F.col("fp").alias(fp), F.col("root").alias(root), F.col("stays").alias("_stays")), fp)
    marked = marked.filter(F.col("doc_id").cast("long").eqNullSafe(F.col("_stays"))).drop("_stays")
    first = marked.groupBy(root).agg(F.min_by(F.struct(*docs.columns), F.struct(F.coalesce("text", F.lit("")), F.xxhash64(*docs.columns))).alias("r"))
    return first.select("r.*")


def _beside(docs: DataFrame, name: str, shingle: int) -> DataFrame:
    """The rows with their fingerprint in a further column."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            fps = np.array([fingerprint(raw, shingle) for raw in _binary(batch.column(at))], np.uint64)
            yield batch.append_column(name, pa.array(fps.view(np.int64)))

    schema = docs.schema
    return docs.mapInArrow(run, type(schema)(list(schema.fields)).add(name, "long"))
