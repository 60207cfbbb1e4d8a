"""Aggregates kept up to date: a new batch is reduced to mergeable partials and merged into the stored ones.

A count or sum is its own partial, an average is a sum and a count, an extreme its value. Merging is a sum or an extreme by
group, so a group's rows are never read again; any split of the rows into batches gives the partials of all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.session import stage
from starmart.sinks.loads import merge_into

_MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    """A measure over a column: ``count`` (of rows without a column, else of its values), ``sum``, ``min``, ``max`` or
    ``avg``."""

    name: str
    kind: str
    column: str | None = None

    def partials(self) -> dict[str, tuple[str, Column]]:
        """Stored column -> how it merges, and how a batch computes it."""
        c = F.col(self.column) if self.column else F.lit(1)
        if self.kind == "avg":
            return {f"{self.name}_sum": ("sum", F.sum(c)), f"{self.name}_count": ("count", F.count(c))}
        return {self.name: (self.kind, {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](c))}

    def value(self) -> Column:
        if self.kind == "avg":
            return (F.col(f"{self.name}_sum") / F.nullif(F.col(f"{self.name}_count"), F.lit(0))).alias(self.name)
        return F.col(self.name)


def partials(df: DataFrame, group: list[str], measures: list[Measure]) -> DataFrame:
    """One row per group with the measures' partials."""
    columns = {name: c for m in measures for name, (_, c) in m.partials().items()}
    return df.groupBy(*group).agg(*[c.alias(name) for name, c in columns.items()])


def merged(stored: DataFrame, batch: DataFrame, group: list[str], measures: list[Measure]) -> DataFrame:
    """The partials of both; a null is a group of its own, and a null partial (of no values) counts as nothing."""
    how = {name: kind for m in measures for name, (kind, _) in m.partials().items()}
    both = stored.select(*group, *how).unionByName(batch.select(*group, *how))
    return both.groupBy(*group).agg(*[_MERGE[kind](name).alias(name) for name, kind in how.items()])


def finished(stored: DataFrame, group: list[str], measures: list[Measure]) -> DataFrame:
    """Groups and measures from the partials."""
    return stored.select(*group, *[m.value() for m in measures])


def add_batch(df: DataFrame, root: str, group: list[str], measures: list[Measure], buckets: int | None = None) -> str:
    """Merge a batch of new rows into the table of partials under ``root``; of a table laid out in ``buckets`` of the
    groups only those that the batch meets are rewritten. A batch given twice counts twice."""
    batch = stage(partials(df, group, measures), "partials")
    return merge_into(batch, root, group, lambda stored, batch: merged(stored, batch, group, measures), buckets)
