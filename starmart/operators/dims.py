"""Dimension builders: distinct, first row wins, last row wins, and the type-1 upsert.

"First" and "last" mean the caller's order columns; the remaining columns break ties, so
a rerun picks the same row. Every builder is one aggregate whose map side reduces each
task to one row per key before the shuffle, so a key holding a third of the rows costs
its reducer one row per task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.operators.joins import fits_broadcast


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def _ranked(order: list[str], values: list[str]) -> Column:
    """A struct comparing by the order columns, then by the values."""
    ranks = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    return F.struct(*ranks, *([F.struct(*values).alias("r")] if values else []))


def _extreme(df: DataFrame, key: list[str], order: list[str], pick) -> DataFrame:
    names = df.columns
    order = [c for c in order if c not in key]
    rest = [c for c in names if c not in key and c not in order]
    if not order and not rest:
        return df.distinct()
    out = df.groupBy(*key).agg(pick(_ranked(order, rest)).alias("_p"))
    picked = {c: F.col(f"_p.o{i}").alias(c) for i, c in enumerate(order)} | {c: F.col(f"_p.r.{c}") for c in rest}
    return out.select(*[picked.get(c, F.col(c)) for c in names])


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in order (insert, do nothing on conflict)."""
    return _extreme(df, key, order, F.min)


def last_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in order, all columns replaced (keyed write)."""
    return _extreme(df, key, order, F.max)


def upsert_type1(df: DataFrame, key: list[str], update: list[str], order: list[str]) -> DataFrame:
    """One row per key: columns in ``update`` from the last row, the others from the first, nulls included."""
    keep = [c for c in df.columns if c not in key and c not in update and c not in order]
    aggs = [F.max(_ranked(order, update)).alias("_last")]
    if keep:
        aggs.append(F.min(_ranked(order, keep)).alias("_first"))
    out = df.groupBy(*key).agg(*aggs)
    picked = {c: F.col(f"_last.r.{c}") for c in update} | {c: F.col(f"_first.r.{c}") for c in keep}
    names = [c for c in df.columns if c in key or c in picked]
    return out.select(*[picked[c].alias(c) if c in picked else F.col(c) for c in names])


def _key_join(left: DataFrame, right: DataFrame, key: list[str], how: str) -> DataFrame:
    """Semi or anti join on a key in which null is a value like any other."""
    renamed = right.select(*[F.col(c).alias(f"_k_{c}") for c in key])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in key])
    return left.join(F.broadcast(renamed) if fits_broadcast(right) else renamed, same, how)


def rows_without(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Target rows whose key is not in the batch."""
    return _key_join(target, batch, key, "left_anti")


def new_rows_only(batch: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Batch rows whose key the target does not hold.

    For a batch within the broadcast threshold the target is first cut to the batch's keys
    where it is scanned, so the target does not shuffle.
    """
    known = target.select(*key)
    if fits_broadcast(batch):
        known = _key_join(known, batch, key, "left_semi")
    return _key_join(batch, known, key, "left_anti")


def merge_rows(target: DataFrame, batch: DataFrame, key: list[str], update: list[str]) -> DataFrame:
    """The target with the ``update`` columns of the batch's rows, and the batch rows of new keys. Both hold a key once.

    A batch within the broadcast threshold is joined to the target where it is scanned,
    without a shuffle; a larger one meets it in one full outer join.
    """
    names = target.columns
    renamed = batch.select(*[F.col(c).alias(f"_b_{c}") for c in names], F.lit(True).alias("_hit"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in key])
    if not fits_broadcast(batch):
        both = target.withColumn("_old", F.lit(True)).join(renamed, same, "full_outer")
        known, hit = F.col("_old").isNotNull(), F.col("_hit").isNotNull()
        return both.select(
            *[
                F.when(known & ~hit if c in update else known, F.col(c)).otherwise(F.col(f"_b_{c}")).alias(c)
                for c in names
            ]
        )
    side = renamed.select(*[f"_b_{c}" for c in [*key, *update]], "_hit")
    updated = target.join(F.broadcast(side), same, "left").select(
        *[F.when(F.col("_hit"), F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in names]
    )
    return updated.unionByName(new_rows_only(batch.select(*names), target, key))


def merge_type1(
    target: DataFrame, batch: DataFrame, key: list[str], update: list[str], order: list[str]
) -> DataFrame:
    """The target after an upsert of a batch: target rows come before every batch row."""
    return merge_rows(target, upsert_type1(batch, key, update, order), key, update)
