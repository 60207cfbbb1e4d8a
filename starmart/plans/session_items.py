"""Query tables over played items: one table per question, laid out for its lookup key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.contracts import EVENT_CSV_COLUMNS, SESSION_ITEMS, TableContract, split_rows
from starmart.operators.dims import last_wins
from starmart.operators.filters import nonempty
from starmart.sinks.files import write_clustered
from starmart.sources.files import read_csv_by_position

# Each table's key, clustering columns and all columns, with the source name of each.
BY_SESSION_ITEM = {
    "key": ["session_id", "item_in_session"],
    "cluster": [],
    "columns": {
        "session_id": "sessionId",
        "item_in_session": "itemInSession",
        "artist": "artist",
        "song": "song",
        "length": "length",
    },
}
BY_USER_SESSION = {
    "key": ["user_id", "session_id"],
    "cluster": ["item_in_session"],
    "columns": {
        "user_id": "userId",
        "session_id": "sessionId",
        "artist": "artist",
        "song": "song",
        "first_name": "firstName",
        "last_name": "lastName",
        "item_in_session": "itemInSession",
    },
}
BY_SONG = {
    "key": ["song"],
    "cluster": ["first_name", "last_name"],
    "columns": {"song": "song", "first_name": "firstName", "last_name": "lastName"},
}
TABLES = {"by_session_item": BY_SESSION_ITEM, "by_user_session": BY_USER_SESSION, "by_song": BY_SONG}


def parsed_items(spark: SparkSession, paths: str | list[str], order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(items, rejects)`` of event files that are parsed once: the cleaned 11-column file, as text, without events that
    have no artist, and the records that do not have the files' number of fields, as text.

    ``order`` adds further file columns, as numbers, to put the writes of one key in sequence.
    """
    rows, rejects = read_csv_by_position(spark, paths, EVENT_CSV_COLUMNS)
    extra = [c for c in order or [] if c not in SESSION_ITEMS.columns]
    numbers = [F.col(c).try_cast("double").alias(c) for c in extra]
    return nonempty(rows, "artist").select(*SESSION_ITEMS.columns, *numbers), rejects


def clean_items(spark: SparkSession, paths: str | list[str], order: list[str] | None = None) -> DataFrame:
    """The items of ``parsed_items``."""
    return parsed_items(spark, paths, order)[0]


def rejected_items(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The rejects of ``parsed_items``."""
    return parsed_items(spark, paths)[1]


def _table_contract(table: dict, order_types: dict[str, str]) -> TableContract:
    """Each table asks only for its own columns to be well formed; order columns keep their type."""
    sources = table["columns"].values()
    columns = {c: t for c, t in SESSION_ITEMS.columns.items() if c in sources}
    key_sources = [table["columns"][c] for c in [*table["key"], *table["cluster"]]]
    required = [c for c in columns if c in key_sources or columns[c] != "string"]
    return TableContract("query_table", {**order_types, **columns}, required=required)


def query_table(items: DataFrame, table: dict, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``(rows, rejects)``: one row per full key, the last in ``order``.

    A row whose number does not parse, or whose key is null, is set aside.
    """
    columns = table["columns"]
    sources = list(dict.fromkeys([*columns.values(), *order]))
    schema = items.schema
    contract = _table_contract(table, {c: schema[c].dataType.simpleString() for c in order})
    good, rejects = split_rows(items.select(*sources), contract)
    ranks = {f"_o{i}": F.col(c) for i, c in enumerate(order)}
    named = good.select(*[F.col(s).alias(c) for c, s in columns.items()], *[c.alias(r) for r, c in ranks.items()])
    rows = last_wins(named, [*table["key"], *table["cluster"]], list(ranks))
    return rows.select(*columns), rejects


def write_query_table(rows: DataFrame, table: dict, path: str, partitions: int | None = None) -> None:
    """Files by key range; the last key column has Bloom filters, for lookups that do not give the first."""
    write_clustered(rows, path, table["key"], table["cluster"], partitions, bloom=table["key"][-1:])


def lookup(rows: DataFrame, table: dict, **key: object) -> DataFrame:
    """Rows of one key, in clustering order."""
    condition: Column = F.lit(True)
    for name in key:
        condition = condition & (F.col(name) == F.lit(key[name]))
    found = rows.filter(condition)
    return found.orderBy(*table["cluster"]) if table["cluster"] else found
