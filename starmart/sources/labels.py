"""Label catalogues: text with named sections of ``'code' = 'label'`` lines, each ended by ``;``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.functions.text import remove_chars, split_once, strip
from starmart.operators.joins import lookup_join


def read_catalogue(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row ``(text, file)`` per catalogue file."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("file")
    )


def section_codes(
    catalogues: DataFrame, section: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``(keep..., code, label)`` of one section of each catalogue text.

    The section runs from the first occurrence of its name to the next ``;``; its own line
    is dropped, tabs and quotes go, and a line counts when it has exactly one ``=``. A code
    given twice in a text keeps its later label.
    """
    keep = keep or []
    body = remove_chars(text, "\t")
    at = F.instr(body, section)
    from_section = F.substring(body, at, F.length(body))
    within = F.substring_index(from_section, ";", 1)
    complete = (at > 0) & (F.instr(from_section, ";") > 0)
    lines = F.split(remove_chars(within, "'"), "\n")
    parts = F.split("line", "=")
    pairs = (
        catalogues.filter(complete)
        .select(*keep, F.posexplode(lines).alias("pos", "line"))
        .filter((F.col("pos") > 0) & (F.size(parts) == 2))
        .select(*keep, strip(parts[0]).alias("code"), strip(parts[1]).alias("label"), "pos")
    )
    last = F.max(F.struct("pos", "label"))["label"]
    return pairs.groupBy(*keep, "code").agg(last.alias("label"))


def code_map(catalogues: DataFrame, section: str, code: str = "code", label: str = "label") -> DataFrame:
    """A section as a two-column lookup with the given column names."""
    return section_codes(catalogues, section).select(F.col("code").alias(code), F.col("label").alias(label))


def code_map_from_dict(spark: SparkSession, codes: dict[str, str], code: str = "code", label: str = "label") -> DataFrame:
    """A constant code map as a lookup frame."""
    return spark.createDataFrame(list(codes.items()), f"`{code}` string, `{label}` string")


def split_city(ports: DataFrame, label: str = "label") -> DataFrame:
    """Add ``city_name`` and ``state_code`` from a ``CITY, ST`` label; the state is null when there is no comma."""
    city, state = split_once(label, ",")
    return ports.withColumns({"city_name": strip(city), "state_code": strip(state)})


def city_codes(ports: DataFrame, states: DataFrame) -> DataFrame:
    """``(city_code, city_name, state_code, state_name)``; a port without a known state keeps null."""
    cities = split_city(ports).select(F.col("code").alias("city_code"), "city_name", "state_code")
    names = states.select(F.col("code").alias("state_code"), F.col("label").alias("state_name"))
    return lookup_join(cities, names, ["state_code"], "left", right_unique=True).select(
        "city_code", "city_name", "state_code", "state_name"
    )
