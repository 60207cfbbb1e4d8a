"""Load policies over Parquet tables.

A table is a folder of loads and of the commit records that say which of them count (``sinks.commits``). A load never
changes files that readers use: it writes its own and publishes a record, so a failed or repeated run never loses rows
and a broken append is not seen. A table laid out in ``buckets`` of its key has only those rewritten that a batch meets.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.keys import sequence_id
from starmart.operators.dims import first_wins, last_wins, merge_rows, new_rows_only, rows_without, upsert_type1
from starmart.session import stage
from starmart.sinks.commits import (
    Commit,
    Part,
    bucket_of,
    delete,
    exists,
    load_numbers,
    newest,
    next_number,
    publish,
    read_parts,
    read_record,
    record_numbers,
    typed_like,
    write_parts,
)

#: Folders of appended rows before an append gathers them in one: a partitioned table is a scan for each.
MOST_PARTS, MOST_PARTITIONED_PARTS = 256, 16
#: Partition values of a batch that are given to the scan as a filter; of more, the whole table is read.
MOST_PARTITIONS = 1_000


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest load that counts, or None; raises when there are versions but none that counts as finished."""
    commit = newest(spark, root)
    return f"{root}/v{commit.number}" if commit else None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    commit = newest(spark, root)
    if commit is None:
        raise FileNotFoundError(f"no finished version under {root}")
    return read_parts(spark, root, commit)


def prune_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Delete all but the newest ``keep`` states of the table, and loads that broke off.

    Returns the numbers of the loads whose files are deleted. Never a load that a kept state reads, nor one above the
    newest record, which may be being written.
    """
    numbers, records = load_numbers(spark, root), record_numbers(spark, root)
    commit = newest(spark, root)
    if keep < 1 or commit is None:
        return []
    if records:
        kept = [read_record(spark, root, n) for n in records[-keep:]]
        needed = {int(p.path.split("/")[0][1:]) for c in kept for p in c.parts}
        for n in records[:-keep]:
            delete(spark, f"{root}/_commits/{n:09d}")
    else:
        needed = set([n for n in numbers if exists(spark, f"{root}/v{n}/_SUCCESS")][-keep:])
    old = [n for n in numbers if n not in needed and n < commit.number]
    for n in old:
        delete(spark, f"{root}/v{n}")
    return old


def _publish_rows(
    df: DataFrame,
    root: str,
    others: list[Part],
    partition_by: list[str],
    key: list[str],
    buckets: int | None,
    run: str | None = None,
    sort_by: list[str] | None = None,
) -> str:
    spark = df.sparkSession
    number = next_number(spark, root)
    parts = write_parts(df, root, number, partition_by, sort_by, key, buckets, run)
    publish(spark, root, Commit(number, [*others, *parts], df.schema.json(), partition_by, key, buckets))
    return f"{root}/v{number}"


def truncate_insert(
    df: DataFrame,
    root: str,
    partition_by: list[str] | None = None,
    buckets: int | None = None,
    key: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> str:
    """Replace the table's rows. ``df`` may read the table itself. ``buckets`` lays the table out by its ``key``."""
    if buckets and not key:
        raise ValueError("a table laid out in buckets needs a key")
    return _publish_rows(df, root, [], partition_by or [], list(key or []) if buckets else [], buckets, None, sort_by)


def append(df: DataFrame, root: str) -> str:
    """Insert rows, duplicates included: a folder of its own, seen once its record is published."""
    spark = df.sparkSession
    commit = newest(spark, root)
    if commit is None:
        return truncate_insert(df, root)
    if commit.schema is not None:
        df = typed_like(df, commit).select(*[f["name"] for f in json.loads(commit.schema)["fields"]])
    loose = [p for p in commit.parts if p.bucket is None and p.run is None]
    if len(loose) >= (MOST_PARTITIONED_PARTS if commit.partition_by else MOST_PARTS):
        rows = read_parts(spark, root, commit, loose).unionByName(df)
        return _publish_rows(rows, root, [p for p in commit.parts if p not in loose], commit.partition_by, [], None)
    return _publish_rows(df, root, commit.parts, commit.partition_by, commit.key, commit.buckets)


def touched_only(stored: DataFrame, batch: DataFrame, columns: list[str]) -> DataFrame:
    """Of a table partitioned by ``columns`` the partitions that a batch has rows for, as a filter on the scan."""
    found = batch.select(*columns).distinct().limit(MOST_PARTITIONS + 1).collect()
    if len(found) > MOST_PARTITIONS:
        return stored
    values = [reduce(and_, [F.col(c).eqNullSafe(F.lit(r[c])) for c in columns]) for r in found]
    return stored.filter(reduce(or_, values, F.lit(False)))


def append_new(
    df: DataFrame, root: str, key: list[str], order: list[str] | None = None, partition_by: list[str] | None = None
) -> str:
    """Insert the rows whose key is not there yet, one per key; running it twice adds nothing.

    The reduced batch is staged, as the comparison with the table reads it more than once. ``partition_by`` lays a
    new table out; where a table's partition columns are part of the key, only partitions that the batch touches are read.
    """
    spark = df.sparkSession
    batch = first_wins(df, key, order or [])
    commit = newest(spark, root)
    if commit is None:
        return truncate_insert(batch, root, partition_by)
    batch = stage(batch, "batch")
    return append(new_rows_only(batch, _comparable(spark, root, commit, batch, key), key), root)


def _comparable(spark: SparkSession, root: str, commit: Commit, batch: DataFrame, key: list[str]) -> DataFrame:
    """The stored rows that can hold a key of the batch: its partitions or buckets, where the layout tells."""
    if commit.buckets and commit.key == key:
        return read_parts(spark, root, commit, _met(batch, commit)[0])
    stored = read_parts(spark, root, commit)
    if commit.partition_by and set(commit.partition_by) <= set(key):
        return touched_only(stored, batch, commit.partition_by)
    return stored


def _met(batch: DataFrame, commit: Commit) -> tuple[list[Part], list[Part]]:
    """The folders of the buckets that a batch has keys of, and the others. No more rows than buckets are collected."""
    number = bucket_of(commit.key, commit.buckets or 1)
    met = {r[0] for r in typed_like(batch, commit).select(number).distinct().collect()}
    return [p for p in commit.parts if p.bucket in met], [p for p in commit.parts if p.bucket not in met]


def _rewrite(
    batch: DataFrame, root: str, commit: Commit, key: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> str:
    """Publish ``merge(stored rows, batch)``. Of a table laid out in buckets of the key only those that the (staged)
    batch meets are read and written; the folders of the others go on into the new record."""
    spark = batch.sparkSession
    batch = typed_like(batch, commit)
    if not (commit.buckets and commit.key == key):
        return truncate_insert(merge(read_parts(spark, root, commit), batch), root, commit.partition_by)
    met, others = _met(batch, commit)
    if not met and not batch.limit(1).count():
        return f"{root}/v{commit.number}"
    rows = merge(read_parts(spark, root, commit, met), batch)
    return _publish_rows(rows, root, others, [], commit.key, commit.buckets)


def merge_into(
    batch: DataFrame, root: str, key: list[str], merge: Callable[[DataFrame, DataFrame], DataFrame], buckets: int | None = None
) -> str:
    """Publish ``merge(stored rows, batch)``, where rows of other keys than the (staged) batch's stay as they are; the batch
    itself makes a new table. ``buckets`` as in ``upsert``."""
    commit = newest(batch.sparkSession, root)
    if commit is None:
        return truncate_insert(batch, root, buckets=buckets, key=key)
    return _rewrite(batch, root, commit, key, merge)


def replace_by_key(df: DataFrame, root: str, key: list[str], buckets: int | None = None) -> str:
    """Insert a batch whose keys may have several rows each, in place of the stored rows of those keys.

    Loading a batch again gives the same table, also when its rows have changed. A batch of new keys is appended;
    one that meets stored keys rewrites the buckets it meets, or a table without ``buckets``.
    """
    spark = df.sparkSession
    commit = newest(spark, root)
    if commit is None:
        return truncate_insert(df, root, buckets=buckets, key=key)
    batch = stage(df, "batch")
    keys = batch.select(*key).distinct()
    if not _comparable(spark, root, commit, keys, key).join(keys, key, "left_semi").limit(1).count():
        return append(batch, root)

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return rows_without(stored, keys, key).select(*df.columns).unionByName(batch)

    return _rewrite(batch, root, commit, key, merge)


def replace_run(df: DataFrame, root: str, run: str) -> str:
    """The rows of one run in place of those that the same run loaded before; no other run's files are read or written."""
    spark = df.sparkSession
    commit = newest(spark, root)
    if commit is None:
        return _publish_rows(df, root, [], [], [], None, run)
    if commit.buckets or commit.partition_by:
        raise ValueError("runs are kept apart by folder: the table has a layout of its own")
    return _publish_rows(df, root, [p for p in commit.parts if p.run != run], [], [], None, run)


def read_run(spark: SparkSession, root: str, run: str) -> DataFrame:
    """The rows that stand in the table from one run."""
    commit = newest(spark, root)
    if commit is None:
        raise FileNotFoundError(f"no finished version under {root}")
    return read_parts(spark, root, commit, [p for p in commit.parts if p.run == run])


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """Which run's rows stand in the table: ``run, load, path, written`` (UTC), from the records."""
    commit, rows = newest(spark, root), []
    if commit:
        when = {n: read_record(spark, root, n).written for n in record_numbers(spark, root)}
        for p in commit.parts:
            number = int(p.path.split("/")[0][1:])
            rows.append((p.run, number, p.path, when.get(number)))
    return spark.createDataFrame(rows, "run string, load int, path string, written string")


def insert_first_wins(df: DataFrame, root: str, key: list[str], order: list[str]) -> str:
    """Insert, doing nothing for a key that exists; within the batch the first in order is taken."""
    return append_new(df, root, key, order)


def insert_numbered(df: DataFrame, root: str, name: str) -> str:
    """Append rows with a generated id above every id in the table."""
    spark = df.sparkSession
    commit, high = newest(spark, root), 0
    if commit is not None:
        high = read_parts(spark, root, commit).agg(F.coalesce(F.max(name), F.lit(0))).first()[0]
    return append(df.select(sequence_id(high).alias(name), "*"), root)


def upsert(df: DataFrame, root: str, key: list[str], update: list[str], order: list[str], buckets: int | None = None) -> str:
    """Insert new keys; for known keys set only the ``update`` columns, to their last value.

    ``buckets`` lays a new table out, so that later batches rewrite only what they meet.
    """
    spark = df.sparkSession
    commit = newest(spark, root)
    batch = upsert_type1(df, key, update, order)
    if commit is None:
        return truncate_insert(batch, root, buckets=buckets, key=key)
    return _rewrite(stage(batch, "batch"), root, commit, key, lambda stored, batch: merge_rows(stored, batch, key, update))


def write_last_wins(
    df: DataFrame, root: str, key: list[str], order: list[str], cols: list[str], buckets: int | None = None
) -> str:
    """Keyed write: the last row per key replaces the stored one.

    Within the batch the last in ``order`` is taken; every batch row is later than the table. ``buckets`` as in ``upsert``.
    """
    spark = df.sparkSession
    batch = last_wins(df.select(*dict.fromkeys([*cols, *order])), key, order).select(*cols)
    commit = newest(spark, root)
    if commit is None:
        return truncate_insert(batch, root, buckets=buckets, key=key)

    def merge(stored: DataFrame, batch: DataFrame) -> DataFrame:
        return rows_without(stored, batch, key).select(*cols).unionByName(batch)

    return _rewrite(stage(batch, "batch"), root, commit, key, merge)
