"""The music star schema: users, songs, artists, time, and the songplays fact.

Input frames are staged (``contracts.STAGED_EVENTS``, ``contracts.STAGED_SONGS``). Where
the systems this schema was written for differ, the difference is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions.keys import md5_of, wide_key
from starmart.functions.times import calendar, millis_to_timestamp, seconds_timestamp
from starmart.operators.dims import distinct_rows, first_wins, upsert_type1
from starmart.operators.filters import plays_of, present
from starmart.operators.joins import lookup_first, lookup_join
from starmart.operators.numbering import dense_id

# Dimension columns, from staged column to table column.
USER_COLUMNS = ["user_id", "first_name", "last_name", "gender", "level"]
SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]
ARTIST_COLUMNS = {
    "artist_id": "artist_id",
    "artist_name": "name",
    "artist_location": "location",
    "artist_latitude": "latitude",
    "artist_longitude": "longitude",
}
FACT_COLUMNS = ["start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location", "user_agent"]
KEY_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def start_time(precision: str = "millis") -> Column:
    """Play start from ``ts``, to the millisecond or cut to the second."""
    return {"millis": millis_to_timestamp, "seconds": seconds_timestamp}[precision]("ts")


# -- dimensions ---------------------------------------------------------------


def users_latest(plays: DataFrame, order: list[str]) -> DataFrame:
    """One row per user: names from the first play, level from the last."""
    return upsert_type1(plays.select(*dict.fromkeys([*USER_COLUMNS, *order])), ["user_id"], ["level"], order).select(
        *USER_COLUMNS
    )


def users_distinct(plays: DataFrame, required: list[str] | None = None) -> DataFrame:
    """One row per distinct user row, so a user seen on two levels has two."""
    return distinct_rows(present(plays, required) if required else plays, USER_COLUMNS)


def songs_distinct(songs: DataFrame, required: list[str] | None = None) -> DataFrame:
    return distinct_rows(present(songs, required) if required else songs, SONG_COLUMNS)


def songs_first(songs: DataFrame, order: list[str]) -> DataFrame:
    """One row per song id, the first in order."""
    return first_wins(songs.select(*dict.fromkeys([*SONG_COLUMNS, *order])), ["song_id"], order).select(*SONG_COLUMNS)


def _artists(songs: DataFrame) -> DataFrame:
    return songs.select(*[F.col(c).alias(name) for c, name in ARTIST_COLUMNS.items()])


def artists_distinct(songs: DataFrame, required: list[str] | None = None) -> DataFrame:
    artists = _artists(songs)
    return (present(artists, required) if required else artists).distinct()


def artists_first(songs: DataFrame, order: list[str]) -> DataFrame:
    """One row per artist id, from the first song record in order."""
    ordered = songs.select(
        *[F.col(c).alias(name) for c, name in ARTIST_COLUMNS.items()], *[F.col(c).alias(f"_o_{c}") for c in order]
    )
    names = list(ARTIST_COLUMNS.values())
    return first_wins(ordered, ["artist_id"], [f"_o_{c}" for c in order]).select(*names)


def time_of_plays(plays: DataFrame, precision: str = "millis", week_start: str = "monday") -> DataFrame:
    """One row per distinct start time, with its calendar columns (computed after the distinct)."""
    times = plays.select(start_time(precision).alias("start_time")).dropna().distinct()
    return times.select("start_time", *calendar("start_time", week_start=week_start))


def time_of_fact(songplays: DataFrame, week_start: str = "sunday") -> DataFrame:
    """The time dimension read off the fact."""
    times = songplays.select("start_time").distinct()
    return times.select("start_time", *calendar("start_time", week_start=week_start))


def time_with_epoch(plays: DataFrame) -> DataFrame:
    """Distinct ``ts`` with its timestamp and day, month, year."""
    times = plays.select("ts").distinct().select("ts", millis_to_timestamp("ts").alias("timestamp"))
    return times.select("ts", "timestamp", *calendar("timestamp", ["day", "month", "year"]))


# -- songplays ----------------------------------------------------------------


def song_lookup(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """``(song, artist, length, song_id, artist_id)``: songs with their artist's name."""
    named = lookup_join(
        songs.select("song_id", "artist_id", F.col("title").alias("song"), F.col("duration").alias("length")),
        artists.select("artist_id", F.col("name").alias("artist")),
        ["artist_id"],
        "inner",
        right_unique=True,
    )
    return named.select("song", "artist", "length", "song_id", "artist_id")


def songplays_lookup(
    plays: DataFrame, songs: DataFrame, artists: DataFrame, precision: str = "millis"
) -> DataFrame:
    """Every play once, with at most one song: equal title, artist name and exact length.

    When several songs fit, the smallest song id is taken.
    """
    lookup = song_lookup(songs, artists)
    joined = lookup_first(
        plays.withColumn("start_time", start_time(precision)),
        lookup,
        ["song", "artist", "length"],
        ["song_id", "artist_id"],
        built_from=[songs, artists],
    )
    return joined.select(*FACT_COLUMNS)


def _match_frame(songs: DataFrame, keys: dict[str, str]) -> DataFrame:
    renamed = {"song": "title", "artist": "artist_name"} | keys
    # a null key matches nothing, so such song rows need not travel
    return songs.select(*[F.col(c).alias(k) for k, c in renamed.items()], "song_id", "artist_id").dropna(
        subset=list(renamed)
    )


def songplays_by_title(
    plays: DataFrame, songs: DataFrame, order: list[str], key: str = "songplay_id", after: int = 0
) -> DataFrame:
    """Left join on artist name and title, with dense ids in play order, from the number that follows ``after``.

    A play whose title has several song records yields one row for each. ``order`` is
    ``ts`` and whatever makes a play unique; song and artist id complete it.
    """
    joined = lookup_join(plays, _match_frame(songs, {}), ["song", "artist"], "left", skip_unmatched=True)
    timed = joined.withColumn("start_time", start_time("millis"))
    fact = timed.select(
        *FACT_COLUMNS,
        *calendar("start_time", ["month", "year"]),
        *[F.col(c).alias(f"_o_{c}") for c in order],
    )
    numbered = dense_id(fact, [*[f"_o_{c}" for c in order], "song_id", "artist_id"], key, after=after)
    return numbered.select(key, *[c for c in fact.columns if not c.startswith("_o_")])


def songplays_rounded(plays: DataFrame, songs: DataFrame, key: str = "session_second") -> DataFrame:
    """Left join on title, artist and length in whole seconds, with an md5 key.

    ``key`` is ``session_second`` (session id and second, as the warehouse had it; two plays
    in one session-second share it) or ``wide``, the play itself: user, session, millisecond and item. A play
    that several songs match has a row for each, under one key.
    """
    rounded = "decimal(18,0)"
    sides = plays.withColumn("length", F.col("length").cast(rounded))
    lookup = _match_frame(songs.withColumn("duration", F.col("duration").cast(rounded)), {"length": "duration"})
    joined = lookup_join(sides, lookup, ["song", "artist", "length"], "left", skip_unmatched=True).withColumn(
        "start_time", start_time("seconds")
    )
    ids = {
        "session_second": md5_of("session_id", F.date_format("start_time", KEY_TIME_FORMAT)),
        "wide": wide_key("user_id", "session_id", "ts", "item_in_session"),
    }
    return joined.select(ids[key].alias("songplay_id"), *FACT_COLUMNS)


def songplays_matched(plays: DataFrame, songs: DataFrame) -> DataFrame:
    """Only plays that match a song by title and artist, start time in whole seconds, required columns present."""
    needed = present(plays, ["ts", "user_id"])
    lookup = present(_match_frame(songs, {}), ["song_id", "artist_id"])
    joined = lookup_join(needed, lookup, ["song", "artist"], "inner")
    return joined.withColumn("start_time", start_time("seconds")).select(*FACT_COLUMNS)


# -- whole marts --------------------------------------------------------------


def relational_mart(events: DataFrame, songs: DataFrame, order: list[str], action: str = "NextSong") -> dict[str, DataFrame]:
    """Keyed tables: first song and artist record wins, users upserted, one song per play at most."""
    plays = plays_of(events, action)
    song_rows, artist_rows = songs_first(songs, ["song_id"]), artists_first(songs, ["song_id"])
    return {
        "songs": song_rows,
        "artists": artist_rows,
        "time": time_of_plays(plays, "millis", "monday"),
        "users": users_latest(plays, order),
        "songplays": songplays_lookup(plays, song_rows, artist_rows),
    }


def warehouse_mart(events: DataFrame, songs: DataFrame, action: str = "NextSong") -> dict[str, DataFrame]:
    """Tables with required columns: incomplete rows are left out, unmatched plays too."""
    plays = plays_of(events, action)
    return {
        "songplays": songplays_matched(plays, songs),
        "users": users_distinct(plays, ["user_id", "first_name", "last_name"]),
        "songs": songs_distinct(songs, ["song_id", "artist_id", "title"]),
        "artists": artists_distinct(songs, ["artist_id", "name"]),
        "time": time_of_plays(plays, "seconds", "sunday"),
    }


def lake_mart(
    events: DataFrame, songs: DataFrame, order: list[str], action: str = "NextSong", after: int = 0
) -> dict[str, DataFrame]:
    """Distinct rows and a fact numbered in play order, above ``after``, for partitioned Parquet."""
    plays = plays_of(events, action)
    return {
        "songs": songs_distinct(songs),
        "artists": artists_distinct(songs),
        "users": users_distinct(plays),
        "time": time_with_epoch(plays),
        "songplays": songplays_by_title(plays, songs, order, after=after),
    }


def scheduled_mart(events: DataFrame, songs: DataFrame, action: str = "NextSong") -> dict[str, DataFrame]:
    """Content-keyed fact first, then the dimensions, time read off the fact."""
    plays = plays_of(events, action)
    songplays = songplays_rounded(plays, songs)
    return {
        "songplays": songplays,
        "users": users_distinct(plays),
        "songs": songs_distinct(songs),
        "artists": artists_distinct(songs),
        "time": time_of_fact(songplays),
    }
