"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove white space of every kind at both ends (``trim`` alone removes only spaces)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    """Empty or white-space-only text becomes null; other text is left as it is."""
    c = _col(c)
    return F.when(strip(c) != "", c)


def truncate_to(c: Column | str, width: int) -> Column:
    """The first ``width`` characters."""
    return F.substring(_col(c), 1, width)


def upper_name(c: Column | str) -> Column:
    return F.upper(_col(c))


def remove_chars(c: Column | str, chars: str) -> Column:
    """Drop every occurrence of each character of ``chars``."""
    return F.translate(_col(c), chars, "")


def split_once(c: Column | str, sep: str) -> tuple[Column, Column]:
    """Text before and after the first ``sep``; the second is null when there is none."""
    c = _col(c)
    at = F.instr(c, sep)
    head = F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)
    tail = F.when(at > 0, F.substring(c, at + len(sep), F.length(c)))
    return head, tail


def clean_strings(df: DataFrame, widths: dict[str, int] | None = None, default_width: int | None = None) -> DataFrame:
    """Blank to null, and cut to width, over all string columns in one projection."""
    widths = widths or {}
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            width = widths.get(field.name, default_width)
            c = blank_to_null(c)
            c = (truncate_to(c, width) if width else c).alias(field.name)
        out.append(c)
    return df.select(*out)
