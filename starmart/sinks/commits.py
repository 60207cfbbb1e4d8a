"""Commit records: which folders make up a table.

A load writes its files to a folder of its own, ``v<number>``, and then publishes a record ``_commits/<number>`` that
lists the folders of the table as it is from now on: those of earlier loads that still count and its own. Readers
resolve the newest record, so a load that breaks off before its record changes nothing they see, and a load that
replaces part of a table writes that part only. A record is written beside and renamed; the rename fails where another
load took the number first.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The folder column of a table laid out in buckets; not a column of the table.
BUCKET = "load_bucket"


class LoadConflict(RuntimeError):
    """Another load published a record since this one read the table."""


@dataclass(frozen=True)
class Part:
    """A folder of a table, relative to its root, with the bucket it is and the run that loaded it, if any."""

    path: str
    bucket: int | None = None
    run: str | None = None


@dataclass(frozen=True)
class Commit:
    number: int
    parts: list[Part]
    schema: str | None = None
    partition_by: list[str] = field(default_factory=list)
    key: list[str] = field(default_factory=list)
    buckets: int | None = None
    written: str | None = None


def _path(spark: SparkSession, text: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def file_system(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_under(spark: SparkSession, folder: str) -> list[str]:
    fs, path = file_system(spark, folder), _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).delete(_path(spark, path), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; raises where the target is there already."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(file_system(spark, source).getUri(), conf)
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    context.rename(_path(spark, source), _path(spark, target), no_options)


def record_numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in names_under(spark, f"{root}/_commits") if n.isdigit())


def load_numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[1:]) for n in names_under(spark, root) if n.startswith("v") and n[1:].isdigit())


def read_record(spark: SparkSession, root: str, number: int) -> Commit:
    path = f"{root}/_commits/{number:09d}"
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        found = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Commit(**{**found, "parts": [Part(**p) for p in found["parts"]]})


def publish(spark: SparkSession, root: str, commit: Commit) -> None:
    """Make a load visible: the record is complete before it has its name."""
    beside, target = f"{root}/_commits/.{uuid.uuid4().hex}", f"{root}/_commits/{commit.number:09d}"
    body = asdict(commit) | {"written": datetime.now(timezone.utc).isoformat(timespec="seconds")}
    stream = file_system(spark, beside).create(_path(spark, beside), False)
    try:
        stream.write(bytearray(json.dumps(body).encode()))
    finally:
        stream.close()
    try:
        move(spark, beside, target)
    except Exception as refused:
        delete(spark, beside)
        if exists(spark, target):
            raise LoadConflict(f"{target} was published by another load") from refused
        raise


def newest(spark: SparkSession, root: str) -> Commit | None:
    """The table as it is, or None. A folder of versions without records (an older table) counts by success markers."""
    numbers = record_numbers(spark, root)
    if numbers:
        return read_record(spark, root, numbers[-1])
    versions = load_numbers(spark, root)
    done = [n for n in versions if exists(spark, f"{root}/v{n}/_SUCCESS")]
    if versions and not done:
        raise RuntimeError(f"no version under {root} is marked as finished: success markers must be on")
    return Commit(done[-1], [Part(f"v{done[-1]}")]) if done else None


def next_number(spark: SparkSession, root: str) -> int:
    return max([0, *load_numbers(spark, root), *record_numbers(spark, root)]) + 1


def bucket_of(key: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def typed_like(df: DataFrame, commit: Commit) -> DataFrame:
    """The frame with the table's column types, so that equal keys hash alike."""
    if commit.schema is None:
        return df
    types = {f.name: f.dataType for f in StructType.fromJson(json.loads(commit.schema)).fields}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])


def write_parts(
    df: DataFrame,
    root: str,
    number: int,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    key: list[str] | None = None,
    buckets: int | None = None,
    run: str | None = None,
) -> list[Part]:
    """Write a load's rows to its folder, by partition column or by bucket of the key, and say which folders that made."""
    folder, columns = f"{root}/v{number}", list(partition_by or [])
    if buckets:
        if BUCKET in df.columns:
            raise ValueError(f"a table laid out in buckets cannot have a column {BUCKET}")
        df, columns = df.withColumn(BUCKET, bucket_of(key or [], buckets)), [BUCKET]
    if columns:
        df = df.hint("rebalance", *columns)
    if sort_by:
        df = df.sortWithinPartitions(*columns, *sort_by)
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*columns) if columns else writer).parquet(folder)
    if not buckets:
        return [Part(f"v{number}", run=run)]
    made = [n for n in names_under(df.sparkSession, folder) if n.startswith(f"{BUCKET}=")]
    return [Part(f"v{number}/{n}", int(n.split("=")[1]), run) for n in sorted(made)]


def read_parts(spark: SparkSession, root: str, commit: Commit, parts: list[Part] | None = None) -> DataFrame:
    """The rows of some folders of a table (all of them by default), in one scan unless the table is partitioned."""
    parts = commit.parts if parts is None else parts
    if commit.schema is None:
        return spark.read.parquet(*[f"{root}/{p.path}" for p in parts])
    schema = StructType.fromJson(json.loads(commit.schema))
    if not parts:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if not commit.partition_by:
        return reader.parquet(*[f"{root}/{p.path}" for p in parts])
    frames = [reader.parquet(f"{root}/{p.path}").select(*schema.names) for p in parts]
    return reduce(DataFrame.unionByName, frames)
