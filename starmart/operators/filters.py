"""Row filters, written so that they reach the Parquet scan where they can."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plays_of(events: DataFrame, action: str = "NextSong", column: str = "page") -> DataFrame:
    """Events of one type."""
    return events.filter(F.col(column) == action)


def present(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with none of the columns null."""
    return df.dropna(subset=cols)


def nonempty(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column is neither null nor the empty text."""
    return df.filter(F.coalesce(F.col(column), F.lit("")) != "")


def whole_number_is(column: str, value: int) -> Column:
    """``int(column) = value`` for a double column, as a range the scan can use (``int`` cuts towards zero)."""
    c = F.col(column)
    if value > 0:
        return (c >= float(value)) & (c < float(value + 1))
    if value < 0:
        return (c > float(value - 1)) & (c <= float(value))
    return (c > -1.0) & (c < 1.0)


def since_year(column: str, year: int) -> Column:
    """``year(column) >= year`` as a date bound, which is pushed down where the function is not."""
    return F.col(column) >= F.lit(date(year, 1, 1))
