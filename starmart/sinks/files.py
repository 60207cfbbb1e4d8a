"""Parquet and CSV writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from starmart.session import range_partitions
from starmart.sinks.commits import delete, exists, move
from starmart.sinks.folders import can_write, write_folders


def _swap_in(spark: SparkSession, path: str, beside: str) -> None:
    """Put a finished folder in the place of the one readers know, which is kept until the new one stands."""
    old = f"{beside}-old"
    if exists(spark, path):
        move(spark, path, old)
    move(spark, beside, path)
    if exists(spark, old):
        delete(spark, old)


def _replace_by(write: Callable[[str], None], spark: SparkSession, path: str) -> None:
    """Write a folder beside ``path`` and swap it in: a write that fails leaves the last good one, and the frame may
    read the folder it replaces."""
    path = path.rstrip("/")
    folder, slash, name = path.rpartition("/")
    beside = f"{folder}{slash}.{name}-{uuid.uuid4().hex}"
    try:
        write(beside)
    except Exception:
        delete(spark, beside)
        raise
    _swap_in(spark, path, beside)


def _replace(writer: DataFrameWriter, fmt: str, spark: SparkSession, path: str) -> None:
    _replace_by(writer.mode("errorifexists").format(fmt).save, spark, path)


def bloom_options(columns: list[str]) -> dict[str, str]:
    """Writer options that give each row group a Bloom filter on some columns, sized by its distinct values.

    A lookup by such a column skips the row groups without the value, also where minimum and maximum cannot tell (random
    keys, tables ordered by something else). Filters cost up to a megabyte a row group and column.
    """
    on = {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}
    return {**on, "parquet.bloom.filter.adaptive.enabled": "true"} if on else {}


@contextmanager
def _small_partitions_kept(spark: SparkSession) -> Iterator[None]:
    """While it lasts the adaptive planner merges no small partitions; large ones are still cut."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    replace_only_written: bool = False,
    bloom: list[str] | None = None,
    many_folders: bool = False,
) -> None:
    """Replace a Parquet dataset, optionally partitioned. It is written beside and swapped in when it is whole.

    Rows are gathered by partition value before the write, so a value does not leave one
    small file per task. The gathering is a rebalance: a value holding a large share of
    the rows is cut over several tasks at run time, and small ones share a task.
    ``replace_only_written`` overwrites only the partition values present in ``df``, each when all are written.
    ``bloom`` names lookup columns that get filters (``bloom_options``).
    ``many_folders`` says that a folder holds few rows, so that the work is in making folders and not in bytes: small
    partitions are left apart, and all cores write, without Hadoop's file system where the path is a mounted one
    (``write_folders``; ``read_folders`` reads it so).
    """
    partition_by = partition_by or []
    if many_folders:
        with _small_partitions_kept(df.sparkSession):
            if replace_only_written or bloom or not can_write(df, path, partition_by):
                return write_parquet(df, path, partition_by, sort_by, replace_only_written, bloom)
            gathered = df.hint("rebalance", *partition_by)
            return _replace_by(lambda beside: write_folders(gathered, beside, partition_by, sort_by), df.sparkSession, path)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.options(**bloom_options(bloom or []))
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    if replace_only_written:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        _replace(writer, "parquet", df.sparkSession, path)


def write_songs(songs: DataFrame, path: str, folder_per_artist: bool = False) -> None:
    """Songs by year, sorted by artist so that row groups can be skipped; one folder per (year, artist) on request."""
    if folder_per_artist:
        write_parquet(songs, path, ["year", "artist_id"], many_folders=True)
    else:
        write_parquet(songs, path, ["year"], sort_by=["artist_id"])


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """Headered CSV with every value quoted, as a folder of part files."""
    writer = df.write.option("header", True).option("quoteAll", True).option("escape", '"')
    _replace(writer, "csv", df.sparkSession, path)


def write_clustered(
    df: DataFrame,
    path: str,
    key: list[str],
    cluster: list[str] | None = None,
    partitions: int | None = None,
    bloom: list[str] | None = None,
) -> None:
    """A table laid out for lookups by ``key``, rows ordered by ``cluster`` inside a key.

    Files cover disjoint key ranges, so the min/max of their row groups narrow a lookup to
    the files that can hold the key. Ranges run over key and cluster columns together:
    one key with a large share of the rows spans several files, still in order. ``bloom`` names further columns that
    lookups ask for, which the order does not help.
    """
    columns = [*key, *(cluster or [])]
    ranged = df.repartitionByRange(partitions or range_partitions(df), *columns)
    writer = ranged.sortWithinPartitions(*columns).write.options(**bloom_options(bloom or []))
    _replace(writer, "parquet", df.sparkSession, path)
