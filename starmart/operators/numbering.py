"""Dense ordered ids 1..n without sending all rows to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import range_partitions, stage


def dense_id(df: DataFrame, order: list[str], name: str, partitions: int | None = None, after: int = 0) -> DataFrame:
    """Add ``name`` = position of the row in ``order``, from 1, or from the number that follows ``after``.

    Rows are range-partitioned by all order columns (so a value held by a third of the
    rows is still split by the next order column), sorted per partition, and numbered by
    their place in it. The result is written once to the shared folder, since a recompute
    may cut the ranges elsewhere. The partition sizes, one number per partition, then give each
    partition its offset. ``order`` must identify a row.
    """
    partitions = partitions or range_partitions(df)
    row = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_row", row)
    )
    placed = stage(placed, "dense")
    # monotonically_increasing_id = partition number in the upper 31 bits, place in the lower 33
    part, place = F.shiftright("_row", 33).cast("int"), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["p"]: r["n"] for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets, total = [], after
    for p in sorted(sizes):
        offsets.append((p, total))
        total += sizes[p]
    # one row per range
    starts = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _start long"))
    numbered = placed.withColumn("_part", part).join(starts, "_part")
    return numbered.select(*df.columns, (F.col("_start") + place + 1).alias(name))
