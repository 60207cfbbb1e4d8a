"""Catalog tables made from contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.contracts import TableContract, in_order


def create_table(
    spark: SparkSession, contract: TableContract, location: str | None = None, if_not_exists: bool = True
) -> None:
    """Create the contract's Parquet table, at ``location`` when given."""
    columns = ", ".join(f"`{c}` {t}" for c, t in contract.columns.items())
    sql = f"CREATE TABLE {'IF NOT EXISTS ' if if_not_exists else ''}{contract.name} ({columns}) USING parquet"
    if contract.partition_by:
        sql += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in contract.partition_by) + ")"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{name}")


def reset(spark: SparkSession, contracts: list[TableContract], root: str | None = None) -> None:
    """Drop every table, then create every table (the files of an external location stay)."""
    for contract in contracts:
        drop_table(spark, contract.name)
    for contract in contracts:
        create_table(spark, contract, f"{root}/{contract.name}" if root else None)


def insert_into(df: DataFrame, contract: TableContract) -> None:
    """Insert in contract column order, partition columns last as the table stores them."""
    ordered = [c for c in contract.columns if c not in contract.partition_by] + contract.partition_by
    in_order(df, contract).select(*ordered).write.insertInto(contract.name)


def register_views(frames: dict[str, DataFrame]) -> None:
    """Temporary views for SQL users."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
