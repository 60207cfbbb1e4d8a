"""Table contracts: columns, types, widths, required columns and keys, and what enforces them.

Parquet keeps neither keys nor NOT NULL, so a contract is applied by ``split_rows`` (set
malformed rows aside) and checked by ``operators.checks``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from starmart.functions.text import clean_strings


@dataclass(frozen=True)
class TableContract:
    """``columns`` maps each column, in table order, to its SQL type text."""

    name: str
    columns: dict[str, str]
    key: list[str] = field(default_factory=list)
    required: list[str] = field(default_factory=list)
    widths: dict[str, int] = field(default_factory=dict)
    partition_by: list[str] = field(default_factory=list)

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c, self.type_of(c)) for c in self.columns])

    def type_of(self, column: str) -> DataType:
        return DataType.fromDDL(self.columns[column])

    def typed(self, column: str, type_text: str) -> TableContract:
        """The contract with one column's type changed (an engine's own numeric rule, say)."""
        columns = {**self.columns, column: type_text}
        return TableContract(self.name, columns, self.key, self.required, self.widths, self.partition_by)


def in_order(df: DataFrame, contract: TableContract) -> DataFrame:
    """Columns in contract order and type, by name; a missing column becomes null, an extra one goes."""
    out, present = [], set(df.columns)
    for name, type_text in contract.columns.items():
        c = F.col(f"`{name}`") if name in present else F.lit(None)
        out.append(c.cast(type_text).alias(name))
    return df.select(*out)


def empty_frame(spark: SparkSession, contract: TableContract) -> DataFrame:
    """A typed frame without rows, to start a union from."""
    return spark.createDataFrame([], contract.schema)


def union_frames(frames: list[DataFrame], contract: TableContract) -> DataFrame:
    """Union by name after each frame is brought to the contract."""
    first, *rest = [in_order(f, contract) for f in frames]
    for frame in rest:
        first = first.unionByName(frame)
    return first


def clean(df: DataFrame, contract: TableContract) -> DataFrame:
    """Blank text to null and text cut to the contract's widths."""
    return clean_strings(df, contract.widths)


def fit_widths(df: DataFrame, widths: dict[str, int], too_wide: str = "fail") -> tuple[DataFrame, DataFrame]:
    """``(rows, set_aside)`` with no text over its width (in characters).

    ``too_wide`` says what becomes of a row that holds a longer text: ``fail`` fails the load when it meets one,
    ``reject`` sets the row aside, ``cut`` cuts the text and gives the uncut row as set aside too, so that it can
    be counted.
    """
    wide = {c: F.coalesce(F.length(c) > w, F.lit(False)) for c, w in widths.items()}
    over = reduce(or_, wide.values(), F.lit(False))
    reason = F.concat_ws("; ", *[F.when(w, F.lit(f"{c}: over {widths[c]} characters")) for c, w in wide.items()])
    aside = df.filter(over).withColumn("reject_reason", reason)
    if too_wide == "reject":
        return df.filter(~over), aside
    if too_wide == "cut":
        return df.withColumns({c: F.substring(c, 1, w) for c, w in widths.items()}), aside
    if too_wide != "fail":
        raise ValueError(f"unknown treatment {too_wide}")
    failing = {c: F.when(w, F.raise_error(F.lit(f"{c}: over {widths[c]} characters"))).otherwise(F.col(c)) for c, w in wide.items()}
    return df.withColumns(failing), aside.limit(0)


def _cast(schema: StructType, name: str, target: DataType) -> Column:
    c = F.col(f"`{name}`")
    return c if schema[name].dataType == target else c.try_cast(target)


def split_rows(df: DataFrame, contract: TableContract, record: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Cast to the contract and split into ``(good, rejects)``; together they are the input.

    A row is rejected when a value does not cast, or a required column is null. Rejects
    keep the raw columns and name the failing ones in ``reject_reason``. ``record`` names a
    column holding the text of a record that could not be parsed at all.
    """
    schema = df.schema
    casts = {n: _cast(schema, n, contract.type_of(n)) for n in contract.columns if n in schema.names}
    faults = [("record: malformed", F.col(record).isNotNull())] if record else []
    for name, value in casts.items():
        raw = F.col(f"`{name}`")
        if schema[name].dataType != contract.type_of(name):
            faults.append((f"{name}: malformed", raw.isNotNull() & value.isNull()))
        if name in contract.required:
            faults.append((f"{name}: null", raw.isNull()))
    faults += [(f"{name}: missing", F.lit(True)) for name in contract.required if name not in casts]
    bad = reduce(or_, [condition for _, condition in faults], F.lit(False))
    reason = F.concat_ws("; ", *[F.when(condition, F.lit(text)) for text, condition in faults])
    good = in_order(df.filter(~bad).select(*[v.alias(n) for n, v in casts.items()]), contract)
    return good, df.filter(bad).withColumn("reject_reason", reason)


# ---------------------------------------------------------------------------
# The tables' columns, as the input files and the marts name them.

SONG_RECORDS = TableContract(
    "song_records",
    {
        "num_songs": "int",
        "artist_id": "string",
        "artist_latitude": "double",
        "artist_longitude": "double",
        "artist_location": "string",
        "artist_name": "string",
        "song_id": "string",
        "title": "string",
        "duration": "double",
        "year": "int",
    },
    key=["song_id"],
    required=["song_id", "artist_id"],
)

EVENT_RECORDS = TableContract(
    "event_records",
    {
        "artist": "string",
        "auth": "string",
        "firstName": "string",
        "gender": "string",
        "itemInSession": "int",
        "lastName": "string",
        "length": "double",
        "level": "string",
        "location": "string",
        "method": "string",
        "page": "string",
        "registration": "double",
        "sessionId": "int",
        "song": "string",
        "status": "int",
        "ts": "bigint",
        "userAgent": "string",
        "userId": "string",
    },
)

# Staged column for each event key, in table order.
EVENT_PATHS = {
    "artist": "artist",
    "auth": "auth",
    "firstName": "first_name",
    "gender": "gender",
    "itemInSession": "item_in_session",
    "lastName": "last_name",
    "length": "length",
    "level": "level",
    "location": "location",
    "method": "method",
    "page": "page",
    "registration": "registration",
    "sessionId": "session_id",
    "song": "song",
    "status": "status",
    "ts": "ts",
    "userAgent": "user_agent",
    "userId": "user_id",
}

STAGED_EVENTS = TableContract(
    "staging_events",
    {
        "artist": "string",
        "auth": "string",
        "first_name": "string",
        "gender": "string",
        "item_in_session": "int",
        "last_name": "string",
        "length": "double",
        "level": "string",
        "location": "string",
        "method": "string",
        "page": "string",
        "registration": "double",
        "session_id": "int",
        "song": "string",
        "status": "int",
        "ts": "bigint",
        "user_agent": "string",
        "user_id": "bigint",
    },
    required=["ts"],
)

STAGED_SONGS = TableContract(
    "staging_songs",
    {
        "artist_id": "string",
        "artist_latitude": "double",
        "artist_location": "string",
        "artist_longitude": "double",
        "artist_name": "string",
        "duration": "double",
        "num_songs": "int",
        "song_id": "string",
        "title": "string",
        "year": "int",
    },
    key=["song_id"],
    required=["artist_id", "song_id"],
)

# The warehouse's song columns have this width; no other table has one.
WAREHOUSE_SONG_WIDTHS = {"artist_name": 256, "artist_location": 256, "title": 256}

SONGPLAYS = TableContract(
    "songplays",
    {
        "songplay_id": "string",
        "start_time": "timestamp",
        "user_id": "bigint",
        "level": "string",
        "song_id": "string",
        "artist_id": "string",
        "session_id": "int",
        "location": "string",
        "user_agent": "string",
    },
    key=["songplay_id"],
    required=["start_time", "user_id"],
)

USERS = TableContract(
    "users",
    {"user_id": "bigint", "first_name": "string", "last_name": "string", "gender": "string", "level": "string"},
    key=["user_id"],
    required=["user_id"],
)

SONGS = TableContract(
    "songs",
    {"song_id": "string", "title": "string", "artist_id": "string", "year": "int", "duration": "double"},
    key=["song_id"],
    required=["song_id", "title", "artist_id"],
    partition_by=["year"],
)

ARTISTS = TableContract(
    "artists",
    {"artist_id": "string", "name": "string", "location": "string", "latitude": "double", "longitude": "double"},
    key=["artist_id"],
    required=["artist_id", "name"],
)

TIME = TableContract(
    "time",
    {
        "start_time": "timestamp",
        "hour": "int",
        "day": "int",
        "week": "int",
        "month": "int",
        "year": "int",
        "weekday": "int",
    },
    key=["start_time"],
    required=["start_time"],
    partition_by=["year", "month"],
)

# The cleaned event file of the query tables: 11 columns, in this order.
SESSION_ITEMS = TableContract(
    "session_items",
    {
        "artist": "string",
        "firstName": "string",
        "gender": "string",
        "itemInSession": "int",
        "lastName": "string",
        "length": "double",
        "level": "string",
        "location": "string",
        "sessionId": "int",
        "song": "string",
        "userId": "int",
    },
    required=["itemInSession", "sessionId"],
)

# The raw event CSV: 17 columns by position.
EVENT_CSV_COLUMNS = [
    "artist", "auth", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
    "method", "page", "registration", "sessionId", "song", "status", "ts", "userId",
]

IMMIGRATION_INPUT = TableContract(
    "immigration_input",
    {
        "cicid": "double",
        "arrdate": "double",
        "i94cit": "double",
        "i94res": "double",
        "i94port": "string",
        "i94mode": "double",
        "i94addr": "string",
        "depdate": "double",
        "i94bir": "double",
        "i94visa": "double",
        "gender": "string",
        "airline": "string",
        "visatype": "string",
    },
)

IMMIGRATION = TableContract(
    "immigration",
    {
        "cicid": "int",
        "arrdate": "double",
        "i94cit": "string",
        "i94res": "string",
        "i94port": "string",
        "i94mode": "int",
        "i94addr": "string",
        "depdate": "double",
        "i94bir": "int",
        "i94visa": "int",
        "gender": "string",
        "airline": "string",
        "visatype": "string",
    },
)

TEMPERATURE_INPUT = TableContract(
    "temperature_input",
    {
        "dt": "string",
        "AverageTemperature": "double",
        "AverageTemperatureUncertainty": "double",
        "City": "string",
        "Country": "string",
        "Latitude": "string",
        "Longitude": "string",
    },
)

# City demographics: file header to table column; the file has further columns.
CITY_COLUMNS = {
    "City": "city_name",
    "State Code": "state_code",
    "Race": "race",
    "Male Population": "male_population",
    "Female Population": "female_population",
    "Total Population": "total_population",
    "Foreign-born": "foreign_born",
}
CITY_FILE_COLUMNS = [
    "City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
    "Number of Veterans", "Foreign-born", "Average Household Size", "State Code", "Race", "Count",
]

CITY_INPUT = TableContract(
    "city_input",
    {
        "city_name": "string",
        "state_code": "string",
        "race": "string",
        "male_population": "int",
        "female_population": "int",
        "total_population": "int",
        "foreign_born": "int",
    },
)

LABEL_SECTIONS = {"country": "i94cntyl", "port": "i94prtl", "mode": "i94model", "state": "i94addrl"}
VISA_CLASSES = {"1": "Business", "2": "Pleasure", "3": "Student"}
