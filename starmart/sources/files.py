"""Readers. Every one takes an explicit schema, so there is no inference pass over the data."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmart.contracts import IMMIGRATION, IMMIGRATION_INPUT, TableContract, clean, in_order, split_rows
from starmart.functions.times import millis_to_timestamp
from starmart.operators.filters import whole_number_is
from starmart.session import stage


CORRUPT = "_corrupt_record"


def read_json_tree(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """JSON lines of every ``*.json`` file below ``root``, at any depth."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return reader.json(root)


def read_json_glob(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.json") -> DataFrame:
    """JSON lines of the matching files of one folder, not of its sub-folders."""
    return spark.read.schema(schema).json(f"{folder.rstrip('/')}/{pattern}")


def first_per_file(df: DataFrame, order: list[str]) -> DataFrame:
    """One row per input file, the first in ``order``. ``df`` must be a file scan.

    A minimum per file, so each task sends one row per file it read.
    """
    cols = df.columns
    pick = F.min(F.struct(F.struct(*order).alias("o"), F.struct(*cols).alias("r")))
    return df.groupBy(F.col("_metadata.file_path").alias("_file")).agg(pick.alias("_p")).select("_p.r.*")


def _csv_reader(spark: SparkSession, sep: str, multiline: bool):
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8")
    # quotes inside quoted fields are doubled
    return reader.option("multiLine", multiline).option("quote", '"').option("escape", '"')


def read_csv_files(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | StructType,
    sep: str = ",",
    rename: dict[str, str] | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Columns of headered CSV files by name, as one frame; the files may hold them in any order and others beside.

    ``columns`` gives names (text) or typed fields; a value that does not parse as its type fails the scan. A name
    that a path's header lacks raises. Every path is read under the header of its own files, which must agree.
    ``multiline`` allows line breaks inside quoted fields; a file is then read by one task instead of in splits.
    """
    wanted = {f.name: f.dataType for f in columns.fields} if isinstance(columns, StructType) else dict.fromkeys(columns)
    frames = []
    for path in [paths] if isinstance(paths, str) else paths:
        raw = _csv_reader(spark, sep, multiline).option("enforceSchema", False).csv(path)
        missing = [c for c in wanted if c not in raw.columns]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        frames.append(raw.select(*[F.col(f"`{c}`").cast(t).alias(c) if t else F.col(f"`{c}`") for c, t in wanted.items()]))
    df = frames[0]
    for frame in frames[1:]:
        df = df.unionByName(frame)
    return df.withColumnsRenamed(rename) if rename else df


def read_csv_by_position(
    spark: SparkSession, paths: str | list[str], columns: list[str], sep: str = ",", multiline: bool = True
) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)`` of headered CSV files whose columns are given by position, all text.

    Line breaks inside quoted fields belong to the field. A record with more or fewer fields than ``columns`` is set
    aside as its text, with ``reject_reason``. Files are parsed once, for both.
    """
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    reader = _csv_reader(spark, sep, multiline).schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    df = stage(reader.option("enforceSchema", True).csv(paths), "records")
    bad = F.col(CORRUPT).isNotNull()
    reason = F.lit(f"record: not {len(columns)} fields").alias("reject_reason")
    return df.filter(~bad).select(*columns), df.filter(bad).select(F.col(CORRUPT).alias("record"), reason)


def text_schema(paths: list[str]) -> StructType:
    """The JSON schema that holds exactly the given paths, every leaf as text."""
    tree: dict = {}
    for path in paths:
        *parents, leaf = path.split(".")
        node = tree
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = None

    def build(node: dict) -> StructType:
        out = StructType()
        for name, below in node.items():
            out.add(name, build(below) if below else "string")
        return out

    return build(tree)


def _json_as_text(spark: SparkSession, files: str | list[str], paths: list[str], malformed: str) -> DataFrame:
    """The given JSON paths as text. A line that is not JSON fails the scan, or is kept aside to be rejected."""
    schema = text_schema(paths)
    if malformed == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(files)
    if malformed == "reject":
        schema = schema.add(CORRUPT, "string")
        return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).json(files)
    raise ValueError(f"unknown treatment {malformed}")


def _loaded(
    text: DataFrame, contract: TableContract, epoch_columns: list[str], malformed: str
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Text columns cleaned, then typed. A blank is null for every type."""
    cleaned = clean(text, contract)
    counted = contract
    for c in epoch_columns:
        counted = counted.typed(c, "bigint")

    def timed(df: DataFrame) -> DataFrame:
        times = {c: millis_to_timestamp(c) for c in epoch_columns}
        return in_order(df.withColumns(times) if times else df, contract)

    if malformed == "reject":
        # parsed once, for good and rejected rows
        good, rejects = split_rows(stage(cleaned, "parsed"), counted, record=CORRUPT)
        return timed(good), rejects
    return timed(in_order(cleaned, counted))


def read_json_paths(
    spark: SparkSession,
    paths: str | list[str],
    mapping: dict[str, str],
    contract: TableContract,
    malformed: str = "fail",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Bulk load through a path list: each JSON path (``a.b`` for a nested key) fills one table column.

    Values are read as text, so a number given as ``"10"`` loads like ``10``. Blank text becomes
    null, text is cut to the contract's widths if it has any, and the rest is cast. A value that does not
    cast, or a line that is not JSON, fails the load; with ``malformed="reject"`` the result
    is ``(good, rejects)``.
    """
    raw = _json_as_text(spark, paths, list(mapping), malformed)
    named = [F.col(".".join(f"`{p}`" for p in path.split("."))).alias(c) for path, c in mapping.items()]
    named = raw.select(*named, *([CORRUPT] if malformed == "reject" else []))
    return _loaded(named, contract, [], malformed)


def read_json_auto(
    spark: SparkSession,
    paths: str | list[str],
    contract: TableContract,
    epoch_columns: list[str] | None = None,
    malformed: str = "fail",
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Bulk load by name: JSON keys fill the columns of the same name; other keys are ignored, missing ones null.

    ``epoch_columns`` are timestamps written as epoch milliseconds. Text, blanks and
    malformed values are treated as in ``read_json_paths``.
    """
    raw = _json_as_text(spark, paths, list(contract.columns), malformed)
    return _loaded(raw, contract, epoch_columns or [], malformed)


def expand_paths(template: str, contexts: list[dict] | dict) -> list[str]:
    """Fill a path template such as ``logs/{year}/{month:02d}`` for one run or several."""
    contexts = [contexts] if isinstance(contexts, dict) else contexts
    needed = {name for _, name, _, _ in Formatter().parse(template) if name}
    paths = []
    for context in contexts:
        missing = {n for n in needed if n.split(".")[0].split("[")[0] not in context}
        if missing:
            raise KeyError(f"path template needs {sorted(missing)}")
        paths.append(template.format(**context))
    return list(dict.fromkeys(paths))


def read_immigration(
    spark: SparkSession, paths: list[str], fmt: str = "parquet", visa: int = 2, mode: int = 1, malformed: str = "fail"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Immigration records of one travel purpose and mode, typed, over all files in one scan.

    Of Parquet files the filter is a range on the stored doubles, before the casts, so row groups can be skipped.
    CSV files are read by their own headers: columns in any order, others beside; a name that is missing raises, and a
    blank is null. A CSV number that does not parse fails the scan, or, with ``malformed="reject"``, the result is
    ``(records, rejects)``, the files being parsed once. Country codes become whole-number text (582.0 gives 582).
    """
    if malformed not in ("fail", "reject"):
        raise ValueError(f"unknown treatment {malformed}")
    if fmt != "csv":
        raw = spark.read.schema(IMMIGRATION_INPUT.schema).format(fmt).load(paths)
        return _with_rejects(raw, raw.limit(0), visa, mode, malformed)
    text = clean(read_csv_files(spark, paths, list(IMMIGRATION_INPUT.columns)), IMMIGRATION_INPUT)
    if malformed == "fail":
        return immigration_records(in_order(text, IMMIGRATION_INPUT), visa, mode)
    good, rejects = split_rows(stage(text, "parsed"), IMMIGRATION_INPUT)
    return _with_rejects(good, rejects, visa, mode, malformed)


def _with_rejects(raw: DataFrame, rejects: DataFrame, visa: int, mode: int, malformed: str):
    records = immigration_records(raw, visa, mode)
    if malformed == "fail":
        return records
    return records, rejects if "reject_reason" in rejects.columns else rejects.withColumn("reject_reason", F.lit(""))


def immigration_records(raw: DataFrame, visa: int = 2, mode: int = 1) -> DataFrame:
    kept = raw.filter(whole_number_is("i94visa", visa) & whole_number_is("i94mode", mode))
    codes = {c: F.col(c).try_cast("int").cast("string") for c in ("i94cit", "i94res")}
    whole = {c: F.col(c).try_cast("int") for c in ("cicid", "i94mode", "i94bir", "i94visa")}
    return in_order(kept.withColumns({**codes, **whole}), IMMIGRATION)


def line_count(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Number of text lines, header lines included."""
    return spark.read.text(paths).agg(F.count(F.lit(1)).alias("n_lines"))


def read_table(spark: SparkSession, path: str, contract: TableContract | None = None) -> DataFrame:
    """A written Parquet table; with a contract, its columns in contract order."""
    df = spark.read.parquet(path)
    return in_order(df, contract) if contract else df


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, in ``order`` when given (planned as a per-task top-n, not a full sort)."""
    return (df.orderBy(*order) if order else df).limit(n)
