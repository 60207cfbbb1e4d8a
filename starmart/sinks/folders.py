"""Tables of very many folders with few rows each, in a place that every machine mounts.

Hadoop's local file system starts a process for each permission it sets where its native library is missing, Spark's
writer sets up a Parquet writer for millions of rows, and its reader keeps every file on the driver. With a folder for a
few rows that is nearly all of the work. Here the tasks make the folders and files, and list and read them, through
the machines' own file system; the driver knows the first level of folders only. Folder names and files are those of
Spark's writer, so that any reader can take the table. Elsewhere, and for other types, Spark's own sinks are used.
"""

from __future__ import annotations

import os
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import suppress
from itertools import groupby, islice
from urllib.parse import unquote

from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starmart.sinks.commits import file_system

# Functions sent to Python workers travel with their code, so executors need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Types that Arrow and Spark write alike, and those whose text in a folder's name gives the value again.
DATA_TYPES = {"string", "boolean", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "binary"}
FOLDER_TYPES = {"string", "int", "bigint", "date"}

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder for null and empty text
ESCAPED = {ord(c): f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}  # as Spark's writer has it

PENDING = ".pending-"  # begins the name of a file whose attempt is not known to be done; readers skip it
ROWS, BYTES = 10_000, 32 * 2**20  # of a batch read; of a row group written


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the machines' own file system has it, or None where only Hadoop reaches it."""
    uri = file_system(spark, path).makeQualified(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def fits(schema: StructType, partition_by: list[str]) -> bool:
    """Whether a table of these columns can be written and read here."""
    names = {c.lower() for c in schema.names}
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    return (
        len(names) == len(schema.names) > len(partition_by) == len(set(partition_by))
        and all(types.get(c) in FOLDER_TYPES and not c.startswith(".") for c in partition_by)
        and all(t in DATA_TYPES for t in types.values())
    )


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _folder_text(column: str) -> Column:
    """The value as a folder's name has it, but for the escapes. Null, empty and Spark's word for them are one folder."""
    return F.nullif(F.nullif(F.make_valid_utf8(_quoted(column).cast("string")), F.lit("")), F.lit(NO_VALUE))


def _codec(spark: SparkSession) -> str | None:
    """The session's codec under Arrow's name, or None if Arrow has no such codec."""
    names = {"none": "none", "uncompressed": "none", "snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "brotli": "brotli"}
    return names.get(spark.conf.get("spark.sql.parquet.compression.codec").lower())


def can_write(df: DataFrame, path: str, partition_by: list[str]) -> bool:
    spark = df.sparkSession
    whole = int(spark.conf.get("spark.sql.files.maxRecordsPerFile")) <= 0
    return bool(partition_by and fits(df.schema, partition_by) and whole and _codec(spark) and mounted(spark, path))


def _folder(partition_by: list[str], values: tuple[str | None, ...]) -> str:
    return "/".join(
        f"{c.translate(ESCAPED)}={NO_VALUE if v is None else v.translate(ESCAPED)}" for c, v in zip(partition_by, values)
    )


def _slices(batches: Iterator, depth: int, names: list[str]) -> Iterator[tuple]:
    """Runs of rows with the same last ``depth`` columns, without those and under other names: (values, batch)."""
    for batch in batches:
        at, kept = 0, len(names)
        rows = batch.select(batch.schema.names[:kept]).rename_columns(names)
        for values, run in groupby(zip(*(batch.column(kept + i).to_pylist() for i in range(depth)))):
            n = sum(1 for _ in run)
            yield values, rows.slice(at, n)
            at += n


def _make(root: str, folder: str) -> None:
    """Make a folder and those above it, but not the root, which is gone when a write has failed or is over."""
    try:
        os.mkdir(folder)
    except FileExistsError:
        pass
    except FileNotFoundError:
        above = os.path.dirname(folder)
        if above == root:
            raise
        _make(root, above)
        _make(root, folder)


def _writer(root: str, partition_by: list[str], schema: StructType, version: str, codec: str, run_id: str) -> Callable:
    """A task's rows, in order of their folders, to one file a folder under a name of the attempt's own."""
    about = {"org.apache.spark.version": version, "org.apache.spark.sql.parquet.row.metadata": schema.json()}
    ending = {"none": "", "gzip": ".gz", "brotli": ".br"}.get(codec, f".{codec}")

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq

        task = TaskContext.get()
        attempt = str(task.taskAttemptId())
        name = f"part-{task.partitionId():05d}-{run_id}.c000{ending}.parquet"
        for values, runs in groupby(_slices(batches, len(partition_by), schema.names), key=lambda x: x[0]):
            folder = f"{root}/{_folder(partition_by, values)}"
            _make(root, folder)
            held, size, out = [], 0, None
            with pa.OSFile(f"{folder}/{PENDING}{name}.{attempt}", "wb") as file:
                for _, rows in runs:
                    if out is None:
                        described = rows.schema.with_metadata(about)
                        codes = rows.num_rows > 100  # a dictionary is of use for many rows only
                        out = pq.ParquetWriter(file, described, compression=codec, use_dictionary=codes, store_schema=False)
                    held.append(rows)
                    size += rows.nbytes
                    if size > BYTES:
                        out.write_table(pa.Table.from_batches(held))
                        held, size = [], 0
                if held:
                    out.write_table(pa.Table.from_batches(held))
                out.close()
        yield pa.RecordBatch.from_pydict({"attempt": [attempt]})

    return run


def _seen(folder: str) -> Iterator[os.DirEntry]:
    """What Spark's readers see in a folder."""
    return (e for e in os.scandir(folder) if not e.name.startswith(".") and (e.name[0] != "_" or "=" in e.name))


def _leaves(folder: str, depth: int) -> Iterator[str]:
    if depth == 0:
        yield folder
        return
    for entry in _seen(folder):
        if entry.is_dir():
            yield from _leaves(entry.path, depth - 1)


def _lister(root: str, tops: list[str], depth: int) -> Callable:
    """The folders of rows below some of the first level, as paths from the root."""

    def run(batches):
        import pyarrow as pa

        for n in (n for batch in batches for n in batch.column(0).to_pylist()):
            found = _leaves(f"{root}/{tops[n]}", depth - 1)
            while names := [x[len(root) + 1 :] for x in islice(found, ROWS)]:
                yield pa.RecordBatch.from_pydict({"folder": names})

    return run


def _value(name: str) -> str | None:
    text = name.partition("=")[2]
    return None if text == NO_VALUE else unquote(text)


def _folders(spark: SparkSession, root: str, depth: int) -> DataFrame:
    """The folders of rows, listed by tasks that share the first level and dealt anew, so that one that holds most is no
    matter."""
    tops, tasks = [e.name for e in _seen(root) if e.is_dir()], 4 * spark.sparkContext.defaultParallelism
    ids = spark.range(0, len(tops), 1, max(1, min(len(tops), tasks)))
    return ids.mapInArrow(_lister(root, tops, depth), "folder string").repartition(tasks)


def _publisher(root: str, done: set[str]) -> Callable:
    """Give the files of finished attempts the names that readers see and delete those of others. It may run again."""

    def run(batches):
        for batch in batches:
            for folder in (f"{root}/{f}" for f in batch.column(0).to_pylist()):
                for hidden in (n for n in os.listdir(folder) if n.startswith(PENDING)):
                    name, attempt = hidden.removeprefix(PENDING).rsplit(".", 1)
                    with suppress(FileNotFoundError):
                        if attempt in done:
                            os.rename(f"{folder}/{hidden}", f"{folder}/{name}")
                        else:
                            os.unlink(f"{folder}/{hidden}")
            yield batch.slice(0, 0)

    return run


def write_folders(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None = None) -> None:
    """Write a new table with a folder for each set of partition values, from rows gathered by them.

    Each attempt of a task writes files under names of its own that readers skip, and only those of attempts that Spark
    counts as done are renamed, so attempts that broke off or ran twice leave no rows in the table.
    """
    spark, root = df.sparkSession, mounted(df.sparkSession, path)
    os.makedirs(root)
    data = [c for c in df.columns if c not in partition_by]
    texts = {f"folder_{uuid.uuid4().hex}": _folder_text(c) for c in partition_by}
    ordered = df.withColumns(texts).sortWithinPartitions(*texts, *(sort_by or []))
    schema = StructType([df.schema[c] for c in data])
    run = _writer(root, partition_by, schema, spark.version, _codec(spark), uuid.uuid4().hex)
    plain = [_quoted(c).alias(f"data_{i}") for i, c in enumerate(data)]  # mapInArrow takes no names with dots
    done = ordered.select(*plain, *texts).mapInArrow(run, "attempt string").collect()
    attempts = {r.attempt for r in done}
    _folders(spark, root, len(partition_by)).mapInArrow(_publisher(root, attempts), "folder string").collect()
    open(f"{root}/_SUCCESS", "w").close()


def _reader(root: str, depth: int, schema: StructType) -> Callable:
    """The rows of folders, each with the values that the folder's names give as text."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = to_arrow_schema(schema)

        def typed(table):
            if table.schema.equals(wanted):
                return table
            there = set(table.column_names)
            columns = [table[f.name].cast(f.type) if f.name in there else pa.nulls(len(table), f.type) for f in wanted]
            return pa.table(columns, schema=wanted)

        def tables(path):
            with pa.OSFile(path) as file, pq.ParquetFile(file) as found:
                if found.metadata.num_rows <= ROWS:
                    yield typed(found.read(use_threads=False))
                else:
                    for rows in found.iter_batches(ROWS, use_threads=False):
                        yield typed(pa.Table.from_batches([rows]))

        def joined(held):
            table = pa.concat_tables([t for t, _ in held]).rename_columns([f"data_{i}" for i in range(len(wanted))])
            for i in range(depth):
                texts = [v[i] for t, v in held for _ in range(len(t))]
                table = table.append_column(f"value_{i}", pa.array(texts, pa.string()))
            return table.combine_chunks().to_batches()

        held, rows, size = [], 0, 0
        for folder in (f for batch in batches for f in batch.column(0).to_pylist()):
            values = tuple(map(_value, folder.split("/")))
            for table in (t for e in _seen(f"{root}/{folder}") if e.is_file() for t in tables(e.path)):
                held.append((table, values))
                rows, size = rows + len(table), size + table.nbytes
                if rows >= ROWS or size > BYTES:
                    yield from joined(held)
                    held, rows, size = [], 0, 0
        if held:
            yield from joined(held)

    return run


def read_folders(spark: SparkSession, path: str, schema: StructType, partition_by: list[str]) -> DataFrame:
    """A table in such folders, data columns first. The tasks list the folders, dealt over them by the first level, and
    read them, dealt anew; the driver has no list of files."""
    root = mounted(spark, path)
    if not (root and partition_by and fits(schema, partition_by)):
        return spark.read.schema(schema).parquet(path)
    depth, data = len(partition_by), StructType([f for f in schema.fields if f.name not in partition_by])
    plain = [StructField(f"data_{i}", f.dataType) for i, f in enumerate(data.fields)]
    texts = [StructField(f"value_{i}", StringType()) for i in range(depth)]
    found = _folders(spark, root, depth).mapInArrow(_reader(root, depth, data), StructType([*plain, *texts]))
    values = [F.col(f"value_{i}").cast(schema[c].dataType).alias(c) for i, c in enumerate(partition_by)]
    return found.select(*(F.col(f"data_{i}").alias(c) for i, c in enumerate(data.names)), *values)
