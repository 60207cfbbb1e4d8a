"""Data-quality checks: one pass per table for all counts, one more per declared key."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT_COLUMNS = ["table_name", "check_name", "check_value", "passed"]


@dataclass(frozen=True)
class TableCheck:
    """Checks on one table: not empty, columns without nulls, and optionally a unique key."""

    table: str
    not_null: list[str] = field(default_factory=list)
    key: list[str] = field(default_factory=list)
    min_rows: int = 1


@dataclass(frozen=True)
class SqlCheck:
    """A query returning one value, and the value it must return."""

    name: str
    sql: str
    expected: object


class QualityError(ValueError):
    """A check failed; the message lists the failures."""


# The checks run after every load.
DEFAULT_CHECKS = [
    TableCheck("songs", not_null=["title"]),
    TableCheck("users", not_null=["last_name"]),
    TableCheck("artists", not_null=["name"]),
    TableCheck("songplays", not_null=["user_id"]),
]


def _metrics(check: TableCheck) -> dict[str, Column]:
    metrics = {"rows": F.count(F.lit(1))}
    metrics |= {f"null {c}": F.count_if(F.col(c).isNull()) for c in check.not_null}
    return metrics


def check_table(df: DataFrame, check: TableCheck) -> DataFrame:
    """Report rows for one table."""
    metrics = _metrics(check)
    row = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(metrics.values())])
    lines = []
    for i, name in enumerate(metrics):
        value = F.col(f"m{i}")
        passed = value >= check.min_rows if name == "rows" else value == 0
        lines.append(F.struct(F.lit(name).alias("check_name"), value.alias("check_value"), passed.alias("passed")))
    report = row.select(F.explode(F.array(*lines)).alias("x")).select(F.lit(check.table).alias("table_name"), "x.*")
    if check.key:
        report = report.unionByName(_key_report(df, check))
    return report.select(*REPORT_COLUMNS)


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def _key_report(df: DataFrame, check: TableCheck) -> DataFrame:
    n = duplicate_keys(df, check.key).agg(F.count(F.lit(1)).alias("check_value"))
    return n.select(
        F.lit(check.table).alias("table_name"),
        F.lit("duplicate " + ", ".join(check.key)).alias("check_name"),
        "check_value",
        (F.col("check_value") == 0).alias("passed"),
    )


def run_checks(tables: dict[str, DataFrame], checks: list[TableCheck] | None = None) -> DataFrame:
    """One report over several tables: ``(table_name, check_name, check_value, passed)``."""
    reports = [check_table(tables[c.table], c) for c in (checks or DEFAULT_CHECKS)]
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame) -> None:
    """Raise when a check failed. Collects the failures only: at most one row per declared check."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r['table_name']}: {r['check_name']} = {r['check_value']}" for r in failed)
        )


def observed(df: DataFrame, check: TableCheck) -> tuple[DataFrame, Observation]:
    """Attach the counts to a frame, so the write that consumes it also measures it."""
    observation = Observation(check.table)
    return df.observe(observation, *[m.alias(name) for name, m in _metrics(check).items()]), observation


def enforce_observed(observation: Observation, check: TableCheck) -> None:
    values = observation.get
    failed = [n for n, v in values.items() if (v < check.min_rows if n == "rows" else v != 0)]
    if failed:
        raise QualityError("; ".join(f"{check.table}: {n} = {values[n]}" for n in failed))


def run_sql_checks(spark: SparkSession, checks: list[SqlCheck]) -> DataFrame:
    """Run each query and compare its single value with the expected one, as text."""
    reports = []
    for check in checks:
        result = spark.sql(check.sql)
        value = F.col(f"`{result.columns[0]}`").cast("string")
        reports.append(
            result.select(
                F.lit(check.name).alias("check_name"),
                value.alias("check_value"),
                value.eqNullSafe(F.lit(None if check.expected is None else str(check.expected))).alias("passed"),
            )
        )
    return reduce(DataFrame.unionByName, reports).select(
        F.lit("sql").alias("table_name"), "check_name", "check_value", "passed"
    )


def require_not_null(df: DataFrame, cols: list[str], mode: str = "reject") -> tuple[DataFrame, DataFrame] | DataFrame:
    """NOT NULL enforcement: ``reject`` splits into (good, rejects); ``fail`` raises when the rows are read."""
    any_null = F.greatest(*[F.col(c).isNull() for c in cols], F.lit(False))
    if mode == "reject":
        return df.filter(~any_null), df.filter(any_null)
    if mode == "fail":
        message = F.lit("null in a required column: " + ", ".join(cols))
        first = cols[0]
        guarded = F.when(any_null, F.raise_error(message)).otherwise(F.col(first))
        return df.withColumn(first, guarded.cast(df.schema[first].dataType))
    raise ValueError(f"unknown mode {mode}")
