"""The immigration schema: count fact, arrival dates, city populations, temperatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.contracts import (
    CITY_COLUMNS,
    CITY_INPUT,
    LABEL_SECTIONS,
    TEMPERATURE_INPUT,
    VISA_CLASSES,
    clean,
    split_rows,
)
from starmart.functions.times import calendar, sas_days_to_date
from starmart.operators.aggregates import Measure, add_batch, finished
from starmart.operators.filters import present, since_year
from starmart.operators.joins import lookup_join, two_role_lookup
from starmart.session import stage
from starmart.sources.files import read_csv_files
from starmart.sources.labels import city_codes, code_map, code_map_from_dict, section_codes

# Fact columns, from record column to table column.
FACT_COLUMNS = {
    "arrival_date": "arrival_date",
    "i94cit": "origin_country",
    "i94res": "residency_country",
    "i94port": "arrival_city_code",
    "i94mode": "travel_mode",
    "i94bir": "age",
    "i94visa": "reason",
    "gender": "gender",
    "airline": "airline",
    "visatype": "visa_type",
}
POPULATIONS = ["male_population", "female_population", "total_population", "foreign_born"]
CITY_OUTPUT = ["city_code", "city_name", "state_code", "state_name", *POPULATIONS]


def countries(catalogues: DataFrame) -> DataFrame:
    return code_map(catalogues, LABEL_SECTIONS["country"], "country_code", "country_name")


def cities_of(catalogues: DataFrame) -> DataFrame:
    return city_codes(
        section_codes(catalogues, LABEL_SECTIONS["port"]), section_codes(catalogues, LABEL_SECTIONS["state"])
    )


def clean_records(records: DataFrame, country_codes: DataFrame, names: bool = False) -> DataFrame:
    """Arrival and departure dates added; records of an unknown residence or origin country dropped.

    ``names`` also adds ``residency_country`` and ``origin_country``.
    """
    dated = records.withColumns(
        {"arrival_date": sas_days_to_date("arrdate"), "departure_date": sas_days_to_date("depdate")}
    )
    roles = {"i94res": "residency_country", "i94cit": "origin_country"}
    return two_role_lookup(dated, country_codes, "country_code", roles, "country_name" if names else None)


def with_visa_names(spark: SparkSession, records: DataFrame, column: str = "i94visa") -> DataFrame:
    """Add ``visa_name`` for the visa class number; null for another number."""
    names = code_map_from_dict(spark, VISA_CLASSES, "code", "visa_name")
    names = names.select(F.col("code").cast(records.schema[column].dataType).alias(column), "visa_name")
    return records.join(F.broadcast(names), [column], "left")  # three rows


def immigration_fact(records: DataFrame) -> DataFrame:
    """Number of records per combination of the ten fact columns; a null is a value of its own."""
    named = records.select(*[F.col(c).alias(n) for c, n in FACT_COLUMNS.items()])
    return named.groupBy(*FACT_COLUMNS.values()).agg(F.count(F.lit(1)).alias("count"))


_COUNT = [Measure("count", "count")]
_MEAN = [Measure("average_temperature", "avg", "average_temperature")]


def add_to_fact(records: DataFrame, root: str, buckets: int | None = None) -> str:
    """Merge the counts of new records into the stored fact under ``root``."""
    named = records.select(*[F.col(c).alias(n) for c, n in FACT_COLUMNS.items()])
    return add_batch(named, root, list(FACT_COLUMNS.values()), _COUNT, buckets)


def fact_of(stored: DataFrame) -> DataFrame:
    return finished(stored, list(FACT_COLUMNS.values()), _COUNT)


def add_temperatures(temperatures: DataFrame, root: str, since: int = 1900, buckets: int | None = None) -> str:
    """Merge the sums and counts of new readings into the stored ones under ``root``."""
    kept = temperatures.filter(since_year("date", since)).withColumnRenamed("country_name", "country")
    return add_batch(kept, root, ["country", "date"], _MEAN, buckets)


def temperatures_of(stored: DataFrame) -> DataFrame:
    return finished(stored, ["country", "date"], _MEAN)


def arrival_dates(records: DataFrame, ordered: bool = False) -> DataFrame:
    """Distinct arrival dates with year, month, day; newest first when ``ordered``."""
    dates = records.select(F.col("arrival_date").alias("date")).distinct()
    dates = dates.select("date", *calendar("date", ["year", "month", "day"]))
    return dates.orderBy(F.desc("date")) if ordered else dates


def city_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """City demographics: the used columns, names upper case, counts as whole numbers."""
    return clean_cities(read_csv_files(spark, paths, list(CITY_COLUMNS), sep=";", rename=CITY_COLUMNS))


def city_rows(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(cities, rejects)`` of files parsed once: a row whose count is given and not a whole number is set aside."""
    raw = clean(read_csv_files(spark, paths, list(CITY_COLUMNS), sep=";", rename=CITY_COLUMNS), CITY_INPUT)
    good, rejects = split_rows(stage(raw, "parsed"), CITY_INPUT)
    return clean_cities(good), rejects


def clean_cities(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.upper("city_name").alias("city_name"),
        "state_code",
        F.upper("race").alias("race"),
        *[F.col(c).try_cast("int").alias(c) for c in POPULATIONS],
    )


def us_cities(cities: DataFrame, city_map: DataFrame, how: str = "sum") -> DataFrame:
    """Populations by city, for the cities with a code.

    ``how="sum"`` adds the rows of a city; ``"max"`` takes the largest, for input whose
    race rows each repeat the city's total. A staged city map is broadcast by its own size.
    """
    reduce = {"sum": F.sum, "max": F.max}[how]
    totals = cities.groupBy("state_code", "city_name").agg(*[reduce(c).cast("long").alias(c) for c in POPULATIONS])
    coded = present(city_map, ["city_code"])
    return lookup_join(totals, coded, ["city_name", "state_code"], "inner").select(*CITY_OUTPUT)


def temperature_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return clean_temperatures(read_csv_files(spark, paths, TEMPERATURE_INPUT.schema))


def temperature_rows(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(readings, rejects)`` of files parsed once: a reading whose date or number does not parse is set aside."""
    text = clean(read_csv_files(spark, paths, list(TEMPERATURE_INPUT.columns)), TEMPERATURE_INPUT)
    good, rejects = split_rows(stage(text, "parsed"), TEMPERATURE_INPUT.typed("dt", "date"))
    return clean_temperatures(good.withColumn("dt", F.col("dt").cast("string"))), rejects


def clean_temperatures(raw: DataFrame) -> DataFrame:
    """Renamed, dated, names upper case; rows without a temperature dropped."""
    named = raw.select(
        F.col("dt").try_cast("date").alias("date"),
        F.upper("Country").alias("country_name"),
        F.upper("City").alias("city_name"),
        F.col("AverageTemperature").alias("average_temperature"),
        F.col("AverageTemperatureUncertainty").alias("average_temperature_uncertainty"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
    )
    return present(named, ["average_temperature"])


def temperature_dim(temperatures: DataFrame, since: int = 1900, ordered: bool = False) -> DataFrame:
    """Mean temperature by country and date from a year on; newest first, then by country, when ``ordered``."""
    means = (
        temperatures.filter(since_year("date", since))
        .groupBy(F.col("country_name").alias("country"), "date")
        .agg(F.avg("average_temperature").alias("average_temperature"))
    )
    return means.orderBy(F.desc("date"), "country") if ordered else means


def immigration_mart(
    records: DataFrame, temperatures: DataFrame, cities: DataFrame, catalogues: DataFrame
) -> dict[str, DataFrame]:
    """All four tables. ``records`` are typed immigration records, ``catalogues`` the label texts."""
    cleaned = clean_records(records, countries(catalogues))
    return {
        "immigration_fact": immigration_fact(cleaned),
        "us_cities_dim": us_cities(cities, stage(cities_of(catalogues), "cities")),
        "temperature_dim": temperature_dim(temperatures),
        "time_dim": arrival_dates(cleaned),
    }
