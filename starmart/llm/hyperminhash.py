"""Near duplicates by HyperMinHash.

A set of word shingles is hashed into 512 buckets, and each bucket keeps of its smallest hash the number of leading zeros
and the first mantissa bits. Two sets have equal registers where the smallest hash is shared, and by chance where two
different ones look alike.

For the index registers have ten mantissa bits, four neighbouring buckets give the smallest of theirs, and bands of four
of these are keys of posting lists. For the estimate they are compressed to eight bits, three of the mantissa, and the
expected collisions are taken off.

The members of a list are compared with the one that shares lists with most others, pairs whose estimate is not too low
are verified on the whole sets, and what links is joined. Then all other pairs of a list that lie in different components
are tried as well, in blocks of bounded size: members of one component are never paired again, and no link between two
components is left out.

A pair is ruled out for certain if more registers differ than hashes can at that similarity. The only chance is in the
rest: two sets at 0.8 share no band of four in 32 with a chance of 5e-8 (of five shingles, one of them different, 1e-6),
and estimate six deviations too low with one of 1e-8; more alike sets with less.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.bitmaps import bitmap
from starmart.llm.common import mix64
from starmart.llm.simhash import components, shingle_hashes
from starmart.session import stage

SHINGLE, PERCENT = 4, 80
#: Buckets are the first nine bits of a hash. A register is 0 for an empty bucket, else one more than the count of zeros
#: over the mantissa's complement, so that the register of a smaller hash is larger: 6 and 10 bits, compressed 5 and 3.
BUCKET_BITS, MANTISSA_BITS, SHORT_MANTISSA, MOST_ZEROS = 9, 10, 3, 30
BUCKETS, FOLD, ROWS = 1 << BUCKET_BITS, 4, 4
BANDS = BUCKETS // FOLD // ROWS
#: Standard deviations that an estimate may fall short.
SLACK = 6.0
#: Members of a posting list that are compared in one block, and cells of a block looked at at once.
BLOCK, CELLS = 4096, 1 << 20


def registers(h: np.ndarray) -> np.ndarray:
    """The registers of a set of distinct hashes in rising order."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(h):
        return out
    bucket = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))  # the first of a bucket is its smallest
    low = h[first] << np.uint64(BUCKET_BITS)
    zeros = np.minimum(53 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1], 64 - BUCKET_BITS)
    after = low << np.minimum(zeros + 1, 63).astype(np.uint64)
    mantissa = (after >> np.uint64(64 - MANTISSA_BITS)).astype(np.int64)
    out[bucket[first]] = ((zeros + 1) << MANTISSA_BITS) | (mantissa ^ ((1 << MANTISSA_BITS) - 1))
    return out


def compressed(regs: np.ndarray) -> np.ndarray:
    """Registers of eight bits."""
    zeros, mantissa = np.minimum(regs >> MANTISSA_BITS, MOST_ZEROS + 1), regs & ((1 << MANTISSA_BITS) - 1)
    return np.where(regs == 0, 0, (zeros << SHORT_MANTISSA) | (mantissa >> (MANTISSA_BITS - SHORT_MANTISSA))).astype(np.uint8)


def collision_rate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The chance that two independent buckets of sets of ``a`` and ``b`` shingles, both filled, have equal registers.

    A bucket's smallest value (0 to 1) has density about m * exp(-m * x) for m shingles a bucket. A register with z
    zeros stands for a cell of width 2^-(z + 1 + mantissa bits), so the chance is the integral of the product of both
    densities, each cell by its width: a sum over z.
    """
    m, n = np.asarray(a, np.float64) / BUCKETS, np.asarray(b, np.float64) / BUCKETS
    s, total = m + n, np.zeros(np.shape(m))
    for z in range(MOST_ZEROS):
        low, width = 2.0 ** -(z + 1), 2.0 ** -(z + 1 + SHORT_MANTISSA)
        total = total + width * m * n / np.maximum(s, 1e-300) * (np.exp(-s * low) - np.exp(-2 * s * low))
    filled = -np.expm1(-m) * -np.expm1(-n)
    return np.clip(total / np.maximum(filled, 1e-300), 0.0, 1.0)


def estimate(equal: np.ndarray, used: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of equal registers among the used ones, collisions taken off."""
    c = collision_rate(a, b)
    return np.clip((equal / np.maximum(used, 1) - c) / np.maximum(1 - c, 1e-9), 0.0, 1.0)


def plausible(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two tables of compressed registers may be of sets as alike as that.

    For certain not, if more registers differ than the sets have hashes of their own at that similarity: a bucket in
    which both have the same hashes has the same register. Else by the estimate.
    """
    used = ((x | y) != 0).sum(1)
    different = (x != y).sum(1)
    own = (a + b) * (100 - percent) / (100 + percent)
    p = percent / 100
    close = estimate(used - different, used, a, b) >= p - SLACK * np.sqrt(p * (1 - p) / np.maximum(used, 1))
    return close & (different <= own + 1e-9)


def sizes_fit(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """A key for each band of each row of registers; 0 for a band without any shingle."""
    folded = np.ascontiguousarray(regs.reshape(-1, BUCKETS // FOLD, FOLD).max(2))
    bands = folded.view(np.uint64).reshape(-1, BANDS)
    keys = mix64(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.where(bands != 0, np.where(keys == 0, np.uint64(1), keys), np.uint64(0))


def _table(column: pa.Array, kind: type = np.uint8, width: int = BUCKETS) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def _set(raw: bytes | None, shingle: int) -> np.ndarray:
    return np.unique(shingle_hashes(raw or b"", shingle))


def _set_name(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs."""
    return tuple(np.frombuffer(xxhash.xxh128_digest(h.tobytes()), np.int64).tolist())


def _no_id(doc_id: pa.Array) -> np.ndarray:
    return doc_id.is_null().to_numpy(zero_copy_only=False)


def _row_hash(doc_id: np.ndarray) -> np.ndarray:
    return mix64(doc_id.view(np.uint64) + np.uint64(0x51ED270B))


_PRINT = "doc_id long, n long, s1 long, s2 long, keys binary, regs binary"


def prints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n, s1, s2, keys, regs`` of every row: the size of its set, the set's name, its band keys and compressed
    registers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [_set(raw, shingle) for raw in batch.column(1).to_pylist()]
            names = np.array([_set_name(h) for h in sets], np.int64).reshape(-1, 2)
            full = np.array([registers(h) for h in sets], np.uint16).reshape(-1, BUCKETS)
            keys = pa.array([k.tobytes() for k in band_keys(full)], pa.binary())
            regs = pa.array([r.tobytes() for r in compressed(full)], pa.binary())
            size = pa.array([len(h) for h in sets], pa.int64())
            cells = [batch.column(0), size, pa.array(names[:, 0]), pa.array(names[:, 1]), keys, regs]
            yield pa.RecordBatch.from_arrays(cells, names=["doc_id", "n", "s1", "s2", "keys", "regs"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, _PRINT)


def _posted(classes: DataFrame) -> DataFrame:
    """``key, node, band``: a row for each band of each set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _table(batch.column(1), np.uint64, BANDS)
            row, band = np.nonzero(keys)
            node = batch.column(0).to_numpy()[row]
            cells = [pa.array(keys[row, band].view(np.int64)), pa.array(node), pa.array(band.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cells, names=["key", "node", "band"])

    return classes.select("node", "keys").mapInArrow(run, "key long, node long, band int")


def _lists(classes: DataFrame) -> DataFrame:
    """The lists of two members or more, staged: ``key, band, node, size, centre``.

    The centre is the member whose lists have most members in all: a text that others were copied from shares lists
    with each of its copies, a copy only with those changed elsewhere.
    """
    posted = _posted(classes)
    sizes = posted.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    lists = stage(posted.join(sizes, "key"), "lists")
    rank = lists.groupBy("node").agg(F.sum("size").alias("rank"))
    centre = lists.select("key", "node").join(rank, "node").groupBy("key").agg(F.max(F.struct("rank", "node")).alias("top"))
    return stage(lists.join(centre.select("key", F.col("top.node").alias("centre")), "key"), "lists")


def _with_registers(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (``x, y``) that sizes and estimates leave, staged."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            keep = pa.array(plausible(_table(batch.column(3)), _table(batch.column(5)), a, b, percent))
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], names=["x", "y"])

    of = lambda side: classes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("regs").alias(f"r{side}"))
    both = pairs.join(of("x"), "x").join(of("y"), "y")
    both = both.filter(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")).select("x", "y", "nx", "rx", "ny", "ry")
    return stage(both.mapInArrow(run, "x long, y long"), "plausible")


def _sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """``node, shingles`` of the sets in pairs, staged. Of the rows of a class the one with its smallest id is read."""
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct()
    held = stage(classes.select("node", "s1", "s2", "least").join(wanted, "node"), "wanted")
    ids = docs.sparkSession.sparkContext.broadcast(bitmap(held.filter("least IS NOT NULL").select(F.col("least").alias("h"))))
    any_null = bool(held.filter("least IS NULL").limit(1).count())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no_id = _no_id(batch.column(0))
            known = ids.value.has(batch.column(0).fill_null(0).to_numpy())
            batch = batch.filter(pa.array(np.where(no_id, any_null, known)))
            sets = [_set(raw, shingle) for raw in batch.column(1).to_pylist()]
            names = np.array([_set_name(h) for h in sets], np.int64).reshape(-1, 2)
            flat = pa.array([h.view(np.int64) for h in sets], pa.list_(pa.int64()))
            cells = [batch.column(0), pa.array(names[:, 0]), pa.array(names[:, 1]), flat]
            yield pa.RecordBatch.from_arrays(cells, names=["least", "s1", "s2", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    found = rows.mapInArrow(run, "least long, s1 long, s2 long, shingles array<long>")
    if any_null or rows.groupBy("doc_id").count().filter("count > 1").limit(1).count():
        found = found.dropDuplicates(["least", "s1", "s2"])  # rows with one id and set
    same = [found[c].eqNullSafe(held[c]) for c in ("least", "s1", "s2")]
    return stage(found.join(held, same[0] & same[1] & same[2]).select("node", "shingles"), "shingles")


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs that link, staged: ``a, b``."""
    held = _sets(docs, classes, pairs, shingle)
    of = lambda side: held.select(F.col("node").alias(side), F.col("shingles").alias(f"s{side}"))
    joined = pairs.join(of("x"), "x").join(of("y"), "y")
    shared = F.size(F.array_intersect("sx", "sy"))
    links = joined.filter(100 * shared >= percent * (F.size("sx") + F.size("sy") - shared))
    return stage(links.select(F.col("x").alias("a"), F.col("y").alias("b")), "links")


def _blocks(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """The members of lists that may hold untried pairs of two components, dealt to blocks: ``key, i, j, side, band, node,
    root``.

    Pairs with the centre have been tried, so it is left out. Its component (*main*) is not compared with itself: those
    members only meet the blocks of the others. A short list is one block; of a long one every two blocks that may hold a
    pair meet in one.
    """
    of = lambda side, name: roots.select(F.col("node").alias(side), F.col("root").alias(name))
    held = lists.filter("size > 2 AND node <> centre").join(of("node", "root"), "node", "left").join(of("centre", "main"), "centre", "left")
    held = held.withColumn("root", F.coalesce("root", "node")).withColumn("main", F.coalesce("main", "centre"))
    other = F.sum((F.col("root") != F.col("main")).cast("long"))
    mixed = held.groupBy("key").agg(other.alias("others"), F.min("root").alias("r0"), F.max("root").alias("r1"))
    held = held.join(mixed.filter("r0 <> r1").select("key", "others"), "key").withColumn("is_other", F.col("root") != F.col("main"))
    short = F.col("size") <= BLOCK
    n_other, n_main = F.ceil(F.col("others") / BLOCK), F.ceil((F.col("size") - F.col("others")) / BLOCK)
    held = held.withColumn("n_other", F.when(short, 1).otherwise(n_other)).withColumn("n_all", F.when(short, 1).otherwise(n_other + n_main))
    hashed = F.xxhash64("node")
    side = F.when(short, 0).when(F.col("is_other"), F.pmod(hashed, "n_other")).otherwise(
        F.col("n_other") + F.pmod(hashed, F.greatest(F.col("n_all") - F.col("n_other"), F.lit(1)))
    )
    held = held.withColumn("side", side.cast("long"))
    all_blocks = F.sequence(F.lit(0).cast("long"), F.col("n_all") - 1)
    mine = F.filter(all_blocks, lambda b: (b < F.col("n_other")) | F.col("is_other"))
    held = held.withColumn("with_", F.explode(F.when(short, F.array(F.lit(0).cast("long"))).otherwise(mine)))
    return held.select(
        "key", F.least("side", "with_").alias("i"), F.greatest("side", "with_").alias("j"), "side", "band", "node", "root"
    )


def _cross(percent: int):
    """Of blocks sorted by key, i and j, the plausible pairs of different components; a pair that meets in several bands
    comes from the first of them."""

    def of_block(i, j, side, band, node, root, n, bands, table) -> Iterator[pa.RecordBatch]:
        length = len(node)
        rows = max(1, CELLS // length)
        for lo in range(0, length - 1, rows):
            x, y = np.arange(lo, min(lo + rows, length))[:, None], np.arange(length)[None, :]
            may = (x < y) & (root[x] != root[y]) & sizes_fit(n[x], n[y], percent)
            if i != j:
                may &= side[x] != side[y]
            u, v = np.nonzero(may)
            u = u + lo
            for at in range(0, len(u), 1 << 14):
                p, q = u[at : at + (1 << 14)], v[at : at + (1 << 14)]
                first = ((bands[p] == bands[q]) & (bands[p] != 0)).argmax(1) == band
                p, q = p[first], q[first]
                keep = plausible(table[p], table[q], n[p], n[q], percent)
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(node[p[keep]]), pa.array(node[q[keep]])], names=["x", "y"])

    def emit(cells: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, i, j = cells[:3]
        new = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        edges = np.flatnonzero(np.concatenate([[True], new, [True]]))
        for lo, hi in zip(edges[:-1], edges[1:]):
            side, band, *rest = (c[lo:hi] for c in cells[3:])
            yield from of_block(i[lo], j[lo], side, band[0], *rest)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            got = [c.to_numpy() for c in batch.columns[:8]] + [_table(batch.column(8), np.uint64, BANDS), _table(batch.column(9))]
            if held and all(c[-1] == h[0] for c, h in zip(got[:3], held[0])):  # still in the block the held rows are of
                held.append(got)
                continue
            cells = [np.concatenate(c) for c in zip(*held, got)]
            last = len(cells[0])
            while last and all(c[last - 1] == c[-1] for c in cells[:3]):
                last -= 1
            if last:
                yield from emit([c[:last] for c in cells])
            held = [[c[last:] for c in cells]]
        if held:
            yield from emit([np.concatenate(c) for c in zip(*held)])

    return run


def _crossing(lists: DataFrame, roots: DataFrame, classes: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """Every plausible pair of a list between two components that was not tried before, staged: ``x, y``."""
    blocks = _blocks(lists, roots).join(classes.select("node", "n", "keys", "regs"), "node")
    n = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "i", "j"]
    held = blocks.select(*order, "side", "band", "node", "root", "n", "keys", "regs").repartition(n, *order).sortWithinPartitions(*order)
    found = held.mapInArrow(_cross(percent), "x long, y long")
    both = tried.unionByName(tried.select(F.col("y").alias("x"), F.col("x").alias("y")))
    return stage(found.join(both, ["x", "y"], "left_anti"), "crossing")


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """The roots after further links: components of the components that those connect."""
    of = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}"))
    between = more.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = stage(between.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).distinct(), "between")
    met = stage(components(between), "met").withColumnsRenamed({"node": "old", "root": "new"})
    known = roots.join(met, roots["root"] == met["old"], "left").select("node", F.coalesce("new", "root").alias("root"))
    # sets that were alone until now
    alone = met.join(roots, met["old"] == roots["node"], "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return stage(known.unionByName(alone), "roots")


def linked(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    Rows link if ``100 * intersection >= percent * union`` of their sets of distinct shingles (A-Z lower-cased; with
    fewer words, the whole sequence). ``component_id`` is the smallest doc_id that links reach, ``kept`` whether it is
    the row's own. Rows of equal sets are one before the index; sets are compared as 64-bit hashes of their shingles and
    named by 128 bits. Null texts and texts without words have no shingles and link with nothing. Rows without an id
    take part; a component without any id has a null one and nothing kept of it. Repeated rows come back
    repeated. Only ``doc_id`` and ``text`` are read; no rows in, no rows out.
    """
    held = stage(prints(docs, shingle), "prints")
    grouped = held.filter("n > 0").groupBy("s1", "s2").agg(
        F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first("keys").alias("keys"), F.first("regs").alias("regs")
    )
    classes = stage(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    lists = _lists(classes)
    stars = lists.filter("node <> centre").select(F.col("node").alias("x"), F.col("centre").alias("y")).distinct()
    tried = _with_registers(stars, classes, percent)
    links = _verified(docs, classes, tried, shingle, percent)
    roots = components(links)
    crossing = _crossing(lists, roots, classes, tried, percent)
    if crossing.limit(1).count():
        more = _verified(docs, classes, crossing, shingle, percent)
        if more.limit(1).count():
            roots = _joined(roots, more)
    rooted = classes.select("s1", "s2", "node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("s1", "s2", "component_id")
    out = held.select("doc_id", "n", "s1", "s2").join(named, ["s1", "s2"], "left")
    out = out.withColumn("component_id", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows whose id is the smallest of their component; all columns are kept. Rows without an id go."""
    ids = linked(docs, shingle, percent).filter("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("kept_id"), "left_semi")
