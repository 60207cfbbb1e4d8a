"""Surrogate-key expressions. The dense key is an operator (``operators.numbering``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def md5_of(*cols: Column | str) -> Column:
    """md5 over the joined text of the columns; null when any of them is null, as ``||`` gives."""
    return F.md5(F.concat(*[_text(c) for c in cols]))


def wide_key(*cols: Column | str) -> Column:
    """md5 over separated column texts, a null counting as its own value, so keys of different rows stay apart."""
    marked = [F.coalesce(F.concat(F.lit("="), _text(c)), F.lit("-")) for c in cols]
    return F.md5(F.concat_ws("\x1f", *marked))


def sequence_id(high_water: int = 0) -> Column:
    """Increasing ids with gaps, above ``high_water``.

    Ids follow the physical partitions, so assign them in the plan that is written,
    and read the written table afterwards.
    """
    return F.monotonically_increasing_id() + F.lit(high_water + 1)
