"""Equi-joins that stay balanced when one key holds a large share of the rows.

A side is broadcast only when the optimizer's size estimate is inside the session's
own broadcast threshold. Beyond it the join shuffles, with every key that outweighs an
average shuffle partition split over several of them, on either side. Rows of a left join that cannot match may stay out
of the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, MapType, StringType, StructType

from starmart.session import stage

FINENESS = 4  # left pieces per average partition, so that pieces meeting in one partition even out
MAX_TRACKED = 1_000_000  # Spark's own limit on the counters of a sketch
MAX_KEPT = 64  # results of sketches that are kept for further joins of the same frame
FILTER_BITS = 1 << 23  # of the key bitmap that tells which rows may match: one megabyte

_sketched: dict[tuple, dict[int, int]] = {}


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (0 when it is switched off)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").lower().strip()
    units = {"b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}
    digits = text.rstrip("bkmg")
    return max(0, int(digits) * units.get(text[len(digits):], 1))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(*frames: DataFrame) -> bool:
    """Whether the frames together are inside the broadcast threshold."""
    limit = broadcast_limit(frames[0])
    return limit > 0 and sum(estimated_bytes(f) for f in frames) <= limit


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    built_from: list[DataFrame] | None = None,
    right_unique: bool = False,
    heavy_from: DataFrame | None = None,
    skip_unmatched: bool = False,
) -> DataFrame:
    """Join a large frame to a lookup: broadcast when its size is checked, else a balanced shuffle join.

    ``built_from`` names the inputs of a lookup that holds at most one row per row of its
    first input (a join on a unique key, a per-key reduction); their sizes stand for it,
    since the optimizer multiplies sizes over a join. ``right_unique`` and ``heavy_from``
    are those of ``balanced_join``. ``skip_unmatched`` is for a left join that most left rows find no match in:
    those whose key is not in the lookup are not shuffled (see ``split_by_keys``).
    """
    if fits_broadcast(*(built_from or [right])):
        return left.join(F.broadcast(right), on, how)
    if skip_unmatched and how == "left" and all(_sketchable(left.schema[name].dataType) for name in on):
        may, cannot = split_by_keys(left, right, on)
        joined = balanced_join(may, right, on, how, right_unique=right_unique, heavy_from=heavy_from)
        types = {f.name: f.dataType for f in right.schema.fields if f.name not in on}
        return joined.unionByName(cannot.withColumns({c: F.lit(None).cast(t) for c, t in types.items()}).select(*joined.columns))
    return balanced_join(left, right, on, how, right_unique=right_unique, heavy_from=heavy_from)


def _sketchable(kind: DataType) -> bool:
    """Whether keys of a type that are equal surely have equal hashes; texts under a collation have not."""
    if isinstance(kind, StringType):
        return kind == StringType()
    if isinstance(kind, StructType):
        return all(_sketchable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _sketchable(kind.elementType)
    return not isinstance(kind, MapType)


def _key_hash(df: DataFrame, on: list[str]) -> Column:
    """One number per key, equal for keys that join (0.0 and -0.0 do)."""
    parts, schema = [], df.schema
    for name in on:
        c, kind = F.col(name), schema[name].dataType
        if isinstance(kind, (DoubleType, FloatType)):
            c = F.when(F.isnan(c), F.lit(float("nan")).cast(kind)).otherwise(c + F.lit(0.0).cast(kind))
        parts.append(c)
    return F.xxhash64(*parts)


def _places(h: Column, bits: int) -> list[Column]:
    """Two bits of a bitmap for a hash."""
    return [h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1))]


def key_bitmap(df: DataFrame, on: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """One row with one array: the bits of the keys of a frame, 64 to an element. Built by the executors; its size is fixed,
    and a frame with more keys than it can tell apart only lets more rows through."""
    placed = df.dropna(subset=on).select(F.explode(F.array(*_places(_key_hash(df, on), bits))).alias("at"))
    cells = placed.groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("word"))
    every = df.sparkSession.range(bits // 64).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("word"))
    words = cells.unionByName(every).groupBy("cell").agg(F.bit_or("word").alias("word"))
    ordered = F.array_sort(F.collect_list(F.struct("cell", "word")))
    return words.agg(F.transform(ordered, lambda x: x["word"]).alias("words"))


def split_by_keys(left: DataFrame, right: DataFrame, on: list[str], bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """Left rows whose key the right side may hold, and those whose key it does not hold (a null key among them).

    The bitmap of the right keys is staged and reaches the scan of the left side as a scalar subquery. The left side is
    read twice, once for each result.
    """
    words = stage(key_bitmap(right, on, bits), "keybits").scalar()
    hits = [
        F.get(words, F.shiftright(at, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))) != 0
        for at in _places(_key_hash(left, on), bits)
    ]
    known = F.coalesce(hits[0] & hits[1], F.lit(False))
    for name in on:
        known = known & F.col(name).isNotNull()
    return left.filter(known), left.filter(~known)


def heavy_keys(df: DataFrame, on: list[str], partitions: int) -> dict[int, int]:
    """Hashes of the keys that hold more rows than an average shuffle partition, with the pieces to cut them in.

    One pass over the key columns; each task keeps a bounded sketch, so no key is shuffled.
    Keys with collated text have no common hash and are left to the adaptive planner. At most ``partitions`` keys can pass the threshold, and as many can be reported. Which
    keys are found steers only the balance of the join, never its rows.
    """
    schema = df.schema
    if not all(_sketchable(schema[name].dataType) for name in on):
        return {}
    keyed = df.select(*on).dropna(subset=on)
    same = (df.sparkSession.sparkContext.applicationId, keyed.semanticHash(), partitions)
    if same in _sketched:  # the same columns of the same source, for another join
        return _sketched[same]
    while len(_sketched) >= MAX_KEPT:
        _sketched.pop(next(iter(_sketched)))
    most = min(partitions, MAX_TRACKED)
    tracked = min(MAX_TRACKED, max(10_000, 10 * most))
    top = F.call_function("approx_top_k", _key_hash(keyed, on), F.lit(most), F.lit(tracked))
    row = keyed.agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    share = row["n"] / partitions
    _sketched[same] = {r["item"]: math.ceil(r["count"] / share) for r in row["top"] or [] if r["count"] > share}
    return _sketched[same]


def _pieces(df: DataFrame, on: list[str], heavy: dict[int, int], name: str) -> DataFrame:
    """``on`` and ``name``: the heavy keys themselves, as ``df`` has them, with their pieces."""
    counts = F.broadcast(df.sparkSession.createDataFrame(list(heavy.items()), f"_hash long, {name} long"))
    keyed = df.select(*on).dropna(subset=on).withColumn("_hash", _key_hash(df, on))
    return keyed.join(counts, "_hash").groupBy(*on).agg(F.max(name).alias(name))


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    partitions: int | None = None,
    right_unique: bool = False,
    heavy_from: DataFrame | None = None,
) -> DataFrame:
    """Inner or left equi-join with heavy keys cut into pieces on both sides.

    A right side with unique keys (``right_unique``) has no heavy ones and is not examined; the left side's heavy keys
    are then left to the adaptive planner, which cuts a partition of the left and reads that of the right again, so the
    frame is built without a job. ``heavy_from`` is a frame to read the left side's heavy keys from, such as the table the
    key comes from when ``left`` is itself a join; it steers the balance only.

    Rows of a heavy key are dealt into the key's pieces, and the other side's rows of that
    key are repeated once per piece. A null key matches nothing, so its rows are dealt
    over all partitions. Pieces are matched on the typed key columns, exactly as the join
    itself matches them. Dealing follows row position, so exact copies of a row spread too;
    it needs the shuffle checksums that ``session.configure`` turns on, which keep it right
    when a lost task runs again and meets its rows in another order.
    """
    if how not in ("left", "inner"):
        raise ValueError("balanced_join supports inner and left")
    left_schema, right_schema = left.schema, right.schema
    for name in on:
        if left_schema[name].dataType != right_schema[name].dataType:
            raise TypeError(f"join key {name} has two types")
    spark = left.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get("spark.sql.shuffle.orderIndependentChecksum.enabled", "false").lower() != "true":
        raise ValueError("call session.configure first: dealing by row position needs the shuffle checksums")
    source = left if heavy_from is None else heavy_from
    adaptive = all(spark.conf.get(f"spark.sql.adaptive.{x}", "true").lower() == "true" for x in ("enabled", "skewJoin.enabled"))
    left_heavy = {} if right_unique and adaptive else {k: n * FINENESS for k, n in heavy_keys(source, on, partitions).items()}
    right_heavy = {} if right_unique else heavy_keys(right, on, partitions)

    deal, null_pieces = F.monotonically_increasing_id(), partitions * FINENESS
    null_key = F.greatest(*[F.col(c).isNull() for c in on]) if len(on) > 1 else F.col(on[0]).isNull()
    out_cols = left_schema.names + [c for c in right_schema.names if c not in on]
    if not left_heavy and not right_heavy:
        dealt = left.withColumn("_piece", F.when(null_key, deal % null_pieces).otherwise(F.lit(0)))
        return dealt.join(right.withColumn("_piece", F.lit(0).cast("long")), [*on, "_piece"], how).select(*out_cols)

    # at most as many keys as partitions on either side
    cuts = []
    if left_heavy:
        cuts.append(_pieces(source, on, left_heavy, "_lp").withColumn("_rp", F.lit(1).cast("long")))
    if right_heavy:
        cuts.append(_pieces(right, on, right_heavy, "_rp").select(*on, F.lit(1).cast("long").alias("_lp"), "_rp"))
    pieces = cuts[0].select(*on, "_lp", "_rp")
    if len(cuts) > 1:
        pieces = pieces.unionByName(cuts[1]).groupBy(*on).agg(F.max("_lp").alias("_lp"), F.max("_rp").alias("_rp"))
    pieces = F.broadcast(stage(pieces, "pieces"))

    def marked(df: DataFrame) -> DataFrame:
        keyed = df.join(pieces, on, "left")
        return keyed.withColumns({"_lp": F.coalesce("_lp", F.lit(1)), "_rp": F.coalesce("_rp", F.lit(1))})

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    dealt_left = (
        marked(left)
        .withColumn("_piece", F.when(null_key, deal % null_pieces).otherwise(deal % F.col("_lp")))
        .withColumn("_copy", each("_rp"))
        .drop("_lp")
    )
    dealt_right = (
        marked(right)
        .withColumn("_copy", deal % F.col("_rp"))
        .withColumn("_piece", each("_lp"))
        .withColumn("_hit", F.lit(True))
        .drop("_lp", "_rp")
    )
    joined = dealt_left.join(dealt_right, [*on, "_piece", "_copy"], how)
    if how == "left":
        # A key cut on the right is present there, so its left rows match in some copy;
        # copies that met no right row are not result rows.
        joined = joined.filter((F.col("_rp") == 1) | F.col("_hit").isNotNull())
    return joined.select(*out_cols)


def one_per_key(lookup: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Reduce a lookup to one row per key, the one with the smallest values; null keys cannot match and go."""
    picked = lookup.dropna(subset=on).groupBy(*on).agg(F.min(F.struct(*values)).alias("_v"))
    return picked.select(*on, "_v.*")


def lookup_first(
    left: DataFrame,
    lookup: DataFrame,
    on: list[str],
    values: list[str],
    built_from: list[DataFrame] | None = None,
) -> DataFrame:
    """Left join giving every left row at most one match."""
    return lookup_join(left, one_per_key(lookup, on, values), on, "left", built_from or [lookup], right_unique=True)


def two_role_lookup(
    df: DataFrame,
    codes: DataFrame,
    code: str,
    roles: dict[str, str],
    label: str | None = None,
) -> DataFrame:
    """Join one code table under several roles, dropping rows a role does not match.

    ``roles`` maps a code column of ``df`` to the name its label gets. Without ``label``
    the codes only filter (the label is not added). Codes are unique in ``codes``.
    """
    base = df
    for column, name in roles.items():
        wanted = [F.col(code).alias(column)] + ([F.col(label).alias(name)] if label else [])
        side = codes.select(*wanted)
        side = side if label else side.distinct()
        joined = lookup_join(df, side, [column], "inner", [codes], right_unique=True, heavy_from=base)
        df = joined.select(*df.columns, *([name] if label else []))
    return df
