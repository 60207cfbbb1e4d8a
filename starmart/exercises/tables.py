"""Query tables: rows by (conversation, turn), by (role, conversation), by text."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.exercises import inputs
from starmart.exercises.registry import exercise, table
from starmart.plans.session_items import BY_SESSION_ITEM, BY_SONG, BY_USER_SESSION, lookup, query_table, write_query_table
from starmart.session import scratch_dir
from starmart.sinks import write_clustered


@exercise("point_lookup", "SELECT conv_id, turn, role, text FROM conversations WHERE conv_id = 3 AND turn = 1")
def point_lookup(spark, sf):
    path = scratch_dir(spark, "point")
    write_clustered(table(spark, sf, "conversations"), path, ["conv_id", "turn"])
    rows = spark.read.parquet(path).filter((F.col("conv_id") == 3) & (F.col("turn") == 1))
    return rows.select("conv_id", "turn", "role", "text")


@exercise(
    "session_ordered",
    "SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn",
)
def session_ordered(spark, sf):
    path = scratch_dir(spark, "sessions")
    write_clustered(table(spark, sf, "conversations"), path, ["conv_id"], ["turn"])
    return spark.read.parquet(path).select("conv_id", "turn", "role", "text").orderBy("conv_id", "turn")


@exercise("members_by_value", "SELECT DISTINCT event_type, user_id, CAST(value > 20 AS BOOLEAN) AS large FROM events")
def members_by_value(spark, sf):
    return table(spark, sf, "events").select("event_type", "user_id", (F.col("value") > 20).alias("large")).distinct()


_ITEMS_SQL = f"""WITH {inputs.LOG_SQL}, items AS (
  SELECT *, row_number() OVER (PARTITION BY session_id, item_in_session ORDER BY ts DESC, event_id DESC) AS rn_item,
         row_number() OVER (PARTITION BY user_id, session_id, item_in_session ORDER BY ts DESC, event_id DESC) AS rn_user
  FROM log WHERE artist IS NOT NULL)"""


def _items(spark, sf):
    return inputs.raw_log(spark, sf).filter(F.col("artist").isNotNull())


@exercise(
    "items_by_session",
    f"{_ITEMS_SQL} SELECT session_id, item_in_session, artist, song, length FROM items WHERE rn_item = 1",
)
def items_by_session(spark, sf):
    return query_table(_items(spark, sf), BY_SESSION_ITEM, ["ts", "event_id"])[0]


@exercise(
    "users_of_song",
    f"""WITH {inputs.LOG_SQL} SELECT DISTINCT song, first_name, last_name FROM log
        WHERE artist IS NOT NULL AND song = (SELECT min(song) FROM log WHERE artist IS NOT NULL) ORDER BY first_name, last_name""",
)
def users_of_song(spark, sf):
    """Everyone who heard one song, looked up by its title in the written table."""
    rows, _ = query_table(_items(spark, sf), BY_SONG, [])
    path = scratch_dir(spark, "songusers")
    write_query_table(rows, BY_SONG, path)
    written = spark.read.schema(rows.schema).parquet(path)
    return lookup(written, BY_SONG, song=written.agg(F.min("song")).first()[0])


@exercise(
    "items_of_user_session",
    f"""{_ITEMS_SQL} SELECT user_id, session_id, artist, song, first_name, last_name, item_in_session FROM items
        WHERE rn_user = 1 AND user_id = 10 AND session_id = 324 ORDER BY item_in_session""",
)
def items_of_user_session(spark, sf):
    rows, _ = query_table(_items(spark, sf), BY_USER_SESSION, ["ts", "event_id"])
    path = scratch_dir(spark, "usersession")
    write_query_table(rows, BY_USER_SESSION, path)
    return lookup(spark.read.parquet(path), BY_USER_SESSION, user_id=10, session_id=324)


@exercise("users_by_song", f"{_ITEMS_SQL} SELECT DISTINCT song, first_name, last_name FROM items")
def users_by_song(spark, sf):
    return query_table(_items(spark, sf), BY_SONG, [])[0]
