"""The marts over the stand-in log, song records and immigration records."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.contracts import EVENT_CSV_COLUMNS, EVENT_RECORDS
from starmart.exercises import inputs
from starmart.exercises.registry import ORACLES, exercise
from starmart.operators.filters import plays_of
from starmart.plans import immigration, music
from starmart.plans.runs import (
    backfill,
    run_immigration,
    run_lake,
    run_lake_increment,
    run_query_tables,
    run_relational,
    run_scheduled,
    run_warehouse,
)
from starmart.session import scratch_dir, stage
from starmart.sinks import read_current
from starmart.sources.files import immigration_records, read_immigration
from starmart.streaming.incremental import load_new_events

ORDER = ["ts", "event_id"]
_MS = "epoch_ms(p.ts)"
_SEC = "date_trunc('second', epoch_ms(p.ts))"
_FACT = "p.user_id, p.level, s.song_id, s.artist_id, p.session_id, p.location, p.user_agent"


def _calendar_sql(source: str, weekday: str) -> str:
    return f"""SELECT DISTINCT start_time, CAST(hour(start_time) AS INTEGER) AS hour, CAST(day(start_time) AS INTEGER) AS day,
      CAST(week(start_time) AS INTEGER) AS week, CAST(month(start_time) AS INTEGER) AS month,
      CAST(year(start_time) AS INTEGER) AS year, CAST({weekday} AS INTEGER) AS weekday FROM {source}"""


def _inputs(spark, sf):
    return inputs.log(spark, sf), inputs.songs(spark, sf)


# -- keyed tables -------------------------------------------------------------

_ARTISTS_FIRST = """artists AS (SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
  artist_longitude AS longitude FROM (SELECT *, row_number() OVER (PARTITION BY artist_id ORDER BY song_id) AS rn FROM song_records)
  WHERE rn = 1)"""
_RELATIONAL_PLAYS = f"""{inputs.MUSIC_SQL}, {_ARTISTS_FIRST},
  found AS (SELECT title, name, duration, min(song_id) AS song_id FROM song_records JOIN artists USING (artist_id) GROUP BY 1, 2, 3),
  s AS (SELECT found.*, r.artist_id FROM found JOIN song_records r ON r.song_id = found.song_id)"""


@exercise("relational_users", f"""{inputs.MUSIC_SQL} SELECT user_id, first_name, last_name, gender, level FROM (
  SELECT user_id, first_value(first_name) OVER f AS first_name, first_value(last_name) OVER f AS last_name,
         first_value(gender) OVER f AS gender, first_value(level) OVER l AS level, row_number() OVER f AS rn FROM plays
  WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id), l AS (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)) WHERE rn = 1""")
def relational_users(spark, sf):
    return music.users_latest(plays_of(inputs.log(spark, sf)), ORDER)


@exercise("relational_songs", f"{inputs.MUSIC_SQL} SELECT song_id, title, artist_id, year, duration FROM song_records")
def relational_songs(spark, sf):
    return music.songs_first(inputs.songs(spark, sf), ["song_id"])


@exercise("relational_artists", f"{inputs.MUSIC_SQL}, {_ARTISTS_FIRST} SELECT * FROM artists")
def relational_artists(spark, sf):
    return music.artists_first(inputs.songs(spark, sf), ["song_id"])


@exercise(
    "relational_time",
    f"{inputs.MUSIC_SQL} " + _calendar_sql(f"(SELECT {_MS} AS start_time FROM plays p)", "isodow(start_time) - 1"),
)
def relational_time(spark, sf):
    return music.time_of_plays(plays_of(inputs.log(spark, sf)), "millis", "monday")


@exercise(
    "relational_songplays",
    f"""{_RELATIONAL_PLAYS} SELECT {_MS} AS start_time, {_FACT} FROM plays p
        LEFT JOIN s ON p.song = s.title AND p.artist = s.name AND p.length = s.duration""",
)
def relational_songplays(spark, sf):
    return music.relational_mart(*_inputs(spark, sf), ORDER)["songplays"]


# -- required columns ---------------------------------------------------------

_WAREHOUSE = f"""{inputs.MUSIC_SQL} SELECT {_SEC} AS start_time, {_FACT} FROM plays p
  JOIN song_records s ON p.song = s.title AND p.artist = s.artist_name"""


@exercise("warehouse_songplays", _WAREHOUSE)
def warehouse_songplays(spark, sf):
    return music.songplays_matched(plays_of(inputs.log(spark, sf)), inputs.songs(spark, sf))


@exercise(
    "warehouse_users",
    f"{inputs.MUSIC_SQL} SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays",
)
def warehouse_users(spark, sf):
    return music.users_distinct(plays_of(inputs.log(spark, sf)), ["user_id", "first_name", "last_name"])


@exercise(
    "warehouse_time",
    f"{inputs.MUSIC_SQL} " + _calendar_sql(f"(SELECT {_SEC} AS start_time FROM plays p)", "dayofweek(start_time)"),
)
def warehouse_time(spark, sf):
    return music.time_of_plays(plays_of(inputs.log(spark, sf)), "seconds", "sunday")


@exercise("warehouse_songs", f"{inputs.MUSIC_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM song_records WHERE title IS NOT NULL")
def warehouse_songs(spark, sf):
    return music.warehouse_mart(*_inputs(spark, sf))["songs"]


@exercise(
    "warehouse_artists",
    f"""{inputs.MUSIC_SQL} SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
        artist_latitude AS latitude, artist_longitude AS longitude FROM song_records""",
)
def warehouse_artists(spark, sf):
    return music.warehouse_mart(*_inputs(spark, sf))["artists"]


# -- data lake ----------------------------------------------------------------

_LAKE = f"""{inputs.MUSIC_SQL} SELECT row_number() OVER (ORDER BY p.ts, p.event_id, s.song_id NULLS FIRST, s.artist_id) AS songplay_id,
  {_MS} AS start_time, {_FACT}, CAST(month({_MS}) AS INTEGER) AS month, CAST(year({_MS}) AS INTEGER) AS year
  FROM plays p LEFT JOIN song_records s ON p.artist = s.artist_name AND p.song = s.title"""


@exercise("lake_songplays", _LAKE)
def lake_songplays(spark, sf):
    return music.songplays_by_title(plays_of(inputs.log(spark, sf)), inputs.songs(spark, sf), ORDER)


@exercise(
    "lake_time",
    f"""{inputs.MUSIC_SQL} SELECT DISTINCT ts, epoch_ms(ts) AS timestamp, CAST(day(epoch_ms(ts)) AS INTEGER) AS day,
        CAST(month(epoch_ms(ts)) AS INTEGER) AS month, CAST(year(epoch_ms(ts)) AS INTEGER) AS year FROM plays""",
)
def lake_time(spark, sf):
    return music.time_with_epoch(plays_of(inputs.log(spark, sf)))


@exercise(
    "lake_artists",
    f"""{inputs.MUSIC_SQL} SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
        artist_latitude AS latitude, artist_longitude AS longitude FROM song_records""",
)
def lake_artists(spark, sf):
    return music.artists_distinct(inputs.songs(spark, sf))


@exercise("lake_songs", f"{inputs.MUSIC_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM song_records")
def lake_songs(spark, sf):
    return music.lake_mart(*_inputs(spark, sf), ORDER)["songs"]


@exercise("lake_users", f"{inputs.MUSIC_SQL} SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays")
def lake_users(spark, sf):
    return music.users_distinct(plays_of(inputs.log(spark, sf)))


# -- content keys -------------------------------------------------------------

_SCHEDULED = f"""{inputs.MUSIC_SQL}, fact AS (
  SELECT md5(CAST(p.session_id AS VARCHAR) || strftime({_SEC}, '%Y-%m-%d %H:%M:%S')) AS songplay_id,
         {_SEC} AS start_time, {_FACT}
  FROM plays p LEFT JOIN song_records s ON p.song = s.title AND p.artist = s.artist_name
    AND CAST(p.length AS DECIMAL(18,0)) = CAST(s.duration AS DECIMAL(18,0)))"""


@exercise("scheduled_songplays", f"{_SCHEDULED} SELECT * FROM fact")
def scheduled_songplays(spark, sf):
    return music.songplays_rounded(plays_of(inputs.log(spark, sf)), inputs.songs(spark, sf))


@exercise("scheduled_time", f"{_SCHEDULED} " + _calendar_sql("fact", "dayofweek(start_time)"))
def scheduled_time(spark, sf):
    return music.scheduled_mart(*_inputs(spark, sf))["time"]


@exercise("scheduled_users", f"{inputs.MUSIC_SQL} SELECT DISTINCT user_id, first_name, last_name, gender, level FROM plays")
def scheduled_users(spark, sf):
    return music.scheduled_mart(*_inputs(spark, sf))["users"]


@exercise("scheduled_songs", f"{inputs.MUSIC_SQL} SELECT DISTINCT song_id, title, artist_id, year, duration FROM song_records")
def scheduled_songs(spark, sf):
    return music.scheduled_mart(*_inputs(spark, sf))["songs"]


@exercise(
    "scheduled_artists",
    f"""{inputs.MUSIC_SQL} SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location,
        artist_latitude AS latitude, artist_longitude AS longitude FROM song_records""",
)
def scheduled_artists(spark, sf):
    return music.scheduled_mart(*_inputs(spark, sf))["artists"]


# -- whole runs over files ----------------------------------------------------


def _music_files(spark, sf, label):
    """The log by day of month and the song records, as JSON below one folder."""
    root = scratch_dir(spark, label)
    raw = inputs.raw_log(spark, sf)
    raw.withColumn("dir", F.dayofmonth(F.timestamp_millis("ts"))).write.partitionBy("dir").json(f"{root}/in/log")
    inputs.songs(spark, sf).write.json(f"{root}/in/songs")
    return root


_FACT_NAMES = ["start_time", *[c.split(".")[1] for c in _FACT.split(", ")]]
_FACT_ROWS = f"{_SCHEDULED} SELECT {', '.join(_FACT_NAMES)} FROM fact"


@exercise("run_scheduled_twice", _FACT_ROWS)
def run_scheduled_twice(spark, sf):
    """All days loaded by templated path in two runs, the second one repeated; the fact without its key."""
    root = _music_files(spark, sf, "scheduled")
    for day in ("?", "??", "??"):
        run_scheduled(spark, root + "/in/log/dir={day}", f"{root}/in/songs", f"{root}/out", {"day": day})
    return read_current(spark, f"{root}/out/songplays").select(*_FACT_NAMES)


@exercise("run_scheduled_late_songs", _FACT_ROWS)
def run_scheduled_late_songs(spark, sf):
    """The same events loaded before and after half of the song records arrived: the fact follows the records."""
    root = _music_files(spark, sf, "latesongs")
    inputs.songs(spark, sf).filter(F.crc32("song_id") % 2 == 0).write.json(f"{root}/in/early")
    for songs in ("early", "songs"):
        run_scheduled(spark, f"{root}/in/log/*", f"{root}/in/{songs}", f"{root}/out")
    return read_current(spark, f"{root}/out/songplays").select(*_FACT_NAMES)


@exercise(
    "run_relational_load",
    f"""{_RELATIONAL_PLAYS} SELECT {_MS} AS start_time, {_FACT} FROM plays p
        LEFT JOIN s ON p.song = s.title AND p.artist = s.name AND p.length = s.duration""",
)
def run_relational_load(spark, sf):
    """All days loaded from JSON into keyed tables; the numbered fact without its number."""
    root = _music_files(spark, sf, "relational")
    run_relational(spark, f"{root}/in/log/*", f"{root}/in/songs", f"{root}/out", ["ts", "session_id", "item_in_session"])
    return read_current(spark, f"{root}/out/songplays").drop("songplay_id")


@exercise("run_warehouse_load", _WAREHOUSE)
def run_warehouse_load(spark, sf):
    """All days loaded twice (tables are replaced); the numbered fact without its number."""
    root = _music_files(spark, sf, "warehouse")
    for _ in range(2):
        run_warehouse(spark, f"{root}/in/log/*", f"{root}/in/songs", f"{root}/out")
    return read_current(spark, f"{root}/out/songplays").drop("songplay_id")


@exercise(
    "run_query_tables_load",
    f"""WITH {inputs.LOG_SQL}, items AS (SELECT *, row_number() OVER (PARTITION BY session_id, item_in_session ORDER BY ts DESC, artist DESC,
          first_name DESC, gender DESC, last_name DESC, length DESC) AS rn FROM log WHERE artist IS NOT NULL)
        SELECT session_id, item_in_session, artist, song, length FROM items WHERE rn = 1""",
)
def run_query_tables_load(spark, sf):
    """The log as headered event CSV files, loaded into the three query tables; the first one read back."""
    root = scratch_dir(spark, "querytables")
    inputs.raw_log(spark, sf).select(*EVENT_CSV_COLUMNS).write.option("header", True).csv(f"{root}/in")
    run_query_tables(spark, f"{root}/in", f"{root}/out", ["ts"])
    return spark.read.parquet(f"{root}/out/by_session_item")


_LAKE_ROWS = f"""{inputs.MUSIC_SQL} SELECT {_MS} AS start_time, {_FACT}, CAST(month({_MS}) AS INTEGER) AS month,
  CAST(year({_MS}) AS INTEGER) AS year
  FROM plays p LEFT JOIN song_records s ON p.artist = s.artist_name AND p.song = s.title"""
_LAKE_ORDER = ["ts", "session_id", "item_in_session", "user_agent"]


@exercise("run_lake_load", _LAKE_ROWS)
def run_lake_load(spark, sf):
    """All days into the partitioned tables; the fact without its number."""
    root = _music_files(spark, sf, "lake")
    run_lake(spark, f"{root}/in/log/*", f"{root}/in/songs", f"{root}/out", _LAKE_ORDER)
    return spark.read.parquet(f"{root}/out/songplays").drop("songplay_id")


@exercise("run_lake_reload", f"SELECT * FROM ({_LAKE_ROWS}) x WHERE day(start_time) > 9")
def run_lake_reload(spark, sf):
    """Two loads of other days into one root: each replaces all tables, so the fact holds the later one."""
    root = _music_files(spark, sf, "lakereload")
    for days in ("dir=?", "dir=??"):
        run_lake(spark, f"{root}/in/log/{days}", f"{root}/in/songs", f"{root}/out", _LAKE_ORDER)
    return spark.read.parquet(f"{root}/out/songplays").drop("songplay_id")


@exercise(
    "run_lake_two_months",
    f"""{_LAKE_ROWS.replace('SELECT epoch_ms', 'SELECT row_number() OVER (ORDER BY day(epoch_ms(p.ts)) > 9, p.ts, p.session_id, p.item_in_session, p.user_agent, s.song_id NULLS FIRST, s.artist_id) AS songplay_id, epoch_ms', 1)}""",
)
def run_lake_two_months(spark, sf):
    """Two loads into tables that keep their rows: the second numbers its plays on from the first, without a gap."""
    root = _music_files(spark, sf, "lakemonths")
    for days in ("dir=?", "dir=??"):
        run_lake_increment(spark, f"{root}/in/log/{days}", f"{root}/in/songs", f"{root}/out", _LAKE_ORDER)
    return read_current(spark, f"{root}/out/songplays")


@exercise("stream_new_files", _FACT_ROWS)
def stream_new_files(spark, sf):
    """Two incremental runs, the second after new files arrived: each takes only the files that are new."""
    root = _music_files(spark, sf, "stream")
    songs, out = inputs.songs(spark, sf), f"{root}/out"
    for part, days in enumerate(("dir=?", "dir=??")):
        rows = spark.read.schema(EVENT_RECORDS.schema).json(f"{root}/in/log/{days}")
        rows.write.json(f"{root}/arrived/{part}")
        load_new_events(spark, f"{root}/arrived", songs, out, f"{root}/checkpoint").awaitTermination()
    return read_current(spark, f"{out}/songplays").select(*_FACT_NAMES)


@exercise("run_scheduled_backfill", _FACT_ROWS)
def run_scheduled_backfill(spark, sf):
    """Two runs kept apart, the first with half of its events and other song records; then the first again, whole: its
    rows are replaced by those of the whole files, and those of the second run stay as they were loaded."""
    root = _music_files(spark, sf, "backfill")
    half = spark.read.schema(EVENT_RECORDS.schema).json(f"{root}/in/log/dir=?").filter("ts % 2 = 0")
    half.write.json(f"{root}/early/log")
    inputs.songs(spark, sf).filter(F.crc32("song_id") % 2 == 0).write.json(f"{root}/early/songs")
    out, first, second = f"{root}/out", {"day": "?"}, {"day": "??"}
    backfill(spark, f"{root}/early/log", f"{root}/early/songs", out, [first])
    backfill(spark, root + "/in/log/dir={day}", f"{root}/in/songs", out, [second])
    backfill(spark, root + "/in/log/dir={day}", f"{root}/in/songs", out, [first])
    return read_current(spark, f"{out}/songplays").select(*_FACT_NAMES)


@exercise("stream_replayed_files", _FACT_ROWS)
def stream_replayed_files(spark, sf):
    """Two incremental runs, the second one meeting all events of the first again in files of other names."""
    root = _music_files(spark, sf, "replayed")
    songs, out = inputs.songs(spark, sf), f"{root}/out"
    for part, days in enumerate(("dir=?", "dir=*")):
        rows = spark.read.schema(EVENT_RECORDS.schema).json(f"{root}/in/log/{days}")
        rows.write.json(f"{root}/arrived/{part}")
        load_new_events(spark, f"{root}/arrived", songs, out, f"{root}/checkpoint", buckets=4).awaitTermination()
    return read_current(spark, f"{out}/songplays").select(*_FACT_NAMES)


@exercise(
    "stream_rejects",
    f"""WITH {inputs.LOG_SQL}
        SELECT ts // 1000 * 1000 AS ts, 'good' AS outcome FROM plays WHERE event_id % 7 > 2
        UNION ALL SELECT NULL, 'ts: malformed' FROM log WHERE event_id % 7 = 0
        UNION ALL SELECT NULL, 'record: malformed; ts: null' FROM log WHERE event_id % 7 = 1
        UNION ALL SELECT NULL, 'user_id: malformed' FROM log WHERE event_id % 7 = 2""",
)
def stream_rejects(spark, sf):
    """A seventh each of the lines cut short, with a time or a user id that is text; all arrive twice."""
    root = scratch_dir(spark, "streamrejects")
    raw = inputs.raw_log(spark, sf)
    kind = F.col("event_id") % 7
    typed = raw.withColumn("ts", F.when(kind == 0, F.concat(F.lit("t"), "event_id")).otherwise(F.col("ts").cast("string")))
    typed = typed.withColumn("userId", F.when(kind == 2, F.concat(F.lit("u"), "event_id")).otherwise(F.col("userId")))
    typed = typed.withColumn("userAgent", F.col("event_id").cast("string"))  # tells equal plays apart
    line = F.to_json(F.struct(*typed.columns))
    lines = typed.select(F.when(kind == 1, F.concat(F.lit("["), "event_id", line)).otherwise(line).alias("value"))
    for part in range(2):
        lines.write.text(f"{root}/arrived/{part}")
        songs = inputs.songs(spark, sf).limit(0)
        load_new_events(spark, f"{root}/arrived", songs, f"{root}/out", f"{root}/checkpoint", pattern="*.txt").awaitTermination()
    rejects = read_current(spark, f"{root}/out/rejects/stream")
    fact = read_current(spark, f"{root}/out/songplays")
    good = fact.select(F.unix_millis("start_time").alias("ts"), F.lit("good").alias("outcome"))
    return good.unionByName(rejects.select(F.lit(None).cast("long").alias("ts"), F.col("reject_reason").alias("outcome")))


# -- every table of a run -----------------------------------------------------

# Columns that are not text, whole numbers or dates, by how both sides write them down.
_MILLIS = {"start_time", "timestamp"}
_THOUSANDTHS = {"duration", "latitude", "longitude", "length", "average_temperature"}


def _lines_sql(tables: dict[str, tuple[str, list[str]]]) -> str:
    """All rows of some tables as one: the table's name and its columns, joined."""

    def text(c: str) -> str:
        c = f'"{c}"'
        if c.strip('"') in _MILLIS:
            c = f"epoch_ms({c})"
        elif c.strip('"') in _THOUSANDTHS:
            c = f"CAST(floor({c} * 1000 + 0.5) AS BIGINT)"
        return f"coalesce(CAST({c} AS VARCHAR), '~')"

    parts = [f"SELECT '{t}' AS tbl, concat_ws('|', {', '.join(map(text, cols))}) AS line FROM ({sql}) x" for t, (sql, cols) in tables.items()]
    return " UNION ALL ".join(parts)


def _lines(frames: dict, tables: dict[str, tuple[str, list[str]]]):
    def text(c: str):
        x = F.col(c)
        if c in _MILLIS:
            x = F.unix_millis(x)
        elif c in _THOUSANDTHS:
            x = F.floor(x * 1000 + 0.5)
        return F.coalesce(x.cast("string"), F.lit("~"))

    out = None
    for t, (_, cols) in tables.items():
        part = frames[t].select(F.lit(t).alias("tbl"), F.concat_ws("|", *map(text, cols)).alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


_TIME_COLUMNS = ["start_time", "hour", "day", "week", "month", "year", "weekday"]
_ARTIST_COLUMNS = ["artist_id", "name", "location", "latitude", "longitude"]


def _checks_sql(mart: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS name, count(*) AS n FROM ({ORACLES[f'{mart}_{c}']}) x" for c in ("users", "songs", "artists"))


def _mart_tables(mart: str, fact: str) -> dict[str, tuple[str, list[str]]]:
    return {
        "songplays": (fact, _FACT_NAMES),
        "users": (ORACLES[f"{mart}_users"], music.USER_COLUMNS),
        "songs": (ORACLES[f"{mart}_songs"], music.SONG_COLUMNS),
        "artists": (ORACLES[f"{mart}_artists"], _ARTIST_COLUMNS),
        "time": (ORACLES[f"{mart}_time"], _TIME_COLUMNS),
    }


_SCHEDULED_TABLES = _mart_tables("scheduled", _FACT_ROWS) | {"counts": (_checks_sql("scheduled"), ["name", "n"])}
_RELATIONAL_TABLES = _mart_tables("relational", ORACLES["run_relational_load"]) | {
    "users": (
        f"""{inputs.MUSIC_SQL} SELECT user_id, first_name, last_name, gender, level FROM (
          SELECT user_id, first_value(first_name) OVER f AS first_name, first_value(last_name) OVER f AS last_name,
                 first_value(gender) OVER f AS gender, first_value(level) OVER l AS level, row_number() OVER f AS rn FROM plays
          WINDOW f AS (PARTITION BY user_id ORDER BY ts, session_id, item_in_session, first_name, last_name, gender),
                 l AS (PARTITION BY user_id ORDER BY ts DESC, session_id DESC, item_in_session DESC, level DESC)) WHERE rn = 1""",
        music.USER_COLUMNS,
    )
}
_WAREHOUSE_TABLES = _mart_tables("warehouse", _WAREHOUSE)
_LAKE_TABLES = _mart_tables("lake", _LAKE_ROWS) | {
    "songplays": (_LAKE_ROWS, [*_FACT_NAMES, "year", "month"]),
    "time": (ORACLES["lake_time"], ["ts", "timestamp", "day", "year", "month"]),
}


def _current(spark, root, tables):
    return {t: read_current(spark, f"{root}/{t}") for t in tables if t != "counts"}


@exercise("run_scheduled_tables", _lines_sql(_SCHEDULED_TABLES))
def run_scheduled_tables(spark, sf):
    """Every table of one scheduled run, and the row counts of its check report."""
    root = _music_files(spark, sf, "scheduledtables")
    report = run_scheduled(spark, f"{root}/in/log/*", f"{root}/in/songs", f"{root}/out")
    counts = report.filter("check_name = 'rows' AND table_name <> 'songplays'").select(
        F.col("table_name").alias("name"), F.col("check_value").alias("n")
    )
    return _lines({**_current(spark, f"{root}/out", _SCHEDULED_TABLES), "counts": counts}, _SCHEDULED_TABLES)


@exercise("run_relational_tables", _lines_sql(_RELATIONAL_TABLES))
def run_relational_tables(spark, sf):
    """Every table of one load into keyed tables, users laid out in buckets."""
    root = _music_files(spark, sf, "relationaltables")
    order = ["ts", "session_id", "item_in_session"]
    run_relational(spark, f"{root}/in/log/*", f"{root}/in/songs", f"{root}/out", order, buckets=4)
    return _lines(_current(spark, f"{root}/out", _RELATIONAL_TABLES), _RELATIONAL_TABLES)


@exercise("run_warehouse_tables", _lines_sql(_WAREHOUSE_TABLES))
def run_warehouse_tables(spark, sf):
    root = _music_files(spark, sf, "warehousetables")
    run_warehouse(spark, f"{root}/in/log/*", f"{root}/in/songs", f"{root}/out")
    return _lines(_current(spark, f"{root}/out", _WAREHOUSE_TABLES), _WAREHOUSE_TABLES)


@exercise("run_lake_tables", _lines_sql(_LAKE_TABLES))
def run_lake_tables(spark, sf):
    root = _music_files(spark, sf, "laketables")
    run_lake(spark, f"{root}/in/log/*", f"{root}/in/songs", f"{root}/out", _LAKE_ORDER)
    return _lines({t: spark.read.parquet(f"{root}/out/{t}") for t in _LAKE_TABLES}, _LAKE_TABLES)


def _last_items(columns: list[str], key: list[str]) -> str:
    """One row per key of a query table: the last by time, then by the table's columns in order."""
    rest = [c for c in columns if c not in key]
    order = ", ".join(f"{c} DESC" for c in ["ts", *rest])
    return f"""WITH {inputs.LOG_SQL} SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER
      (PARTITION BY {', '.join(key)} ORDER BY {order}) AS rn FROM log WHERE artist IS NOT NULL) WHERE rn = 1"""


_QUERY_TABLES = {
    "by_session_item": (
        _last_items(["session_id", "item_in_session", "artist", "song", "length"], ["session_id", "item_in_session"]),
        ["session_id", "item_in_session", "artist", "song", "length"],
    ),
    "by_user_session": (
        _last_items(
            ["user_id", "session_id", "item_in_session", "artist", "song", "first_name", "last_name"],
            ["user_id", "session_id", "item_in_session"],
        ),
        ["user_id", "session_id", "item_in_session", "artist", "song", "first_name", "last_name"],
    ),
    "by_song": (
        f"WITH {inputs.LOG_SQL} SELECT DISTINCT song, first_name, last_name FROM log WHERE artist IS NOT NULL",
        ["song", "first_name", "last_name"],
    ),
}
_ASK = {
    "session 0": ("by_session_item", "item_in_session = 4", ["session_id", "artist", "song", "length"]),
    "user sessions": ("by_user_session", "session_id % 10 = 2", ["user_id", "item_in_session", "artist", "song"]),
    "song": ("by_song", "song LIKE 'a%'", ["song", "first_name", "last_name"]),
}
_ASKED = {
    **_QUERY_TABLES,
    **{name: (f"SELECT * FROM ({_QUERY_TABLES[t][0]}) y WHERE {condition}", cols) for name, (t, condition, cols) in _ASK.items()},
    "rejects": (
        f"WITH {inputs.LOG_SQL} SELECT 'record: not {len(EVENT_CSV_COLUMNS)} fields' AS reason, count(*) AS n FROM log WHERE event_id % 9 = 0",
        ["reason", "n"],
    ),
}


@exercise("run_query_tables_all", _lines_sql(_ASKED))
def run_query_tables_all(spark, sf):
    """The three tables of one run, questions asked of each as it was written, and the records set aside: a line of two
    fields for every ninth event."""
    root = scratch_dir(spark, "querytablesall")
    raw = inputs.raw_log(spark, sf)
    raw.select(*EVENT_CSV_COLUMNS).write.option("header", True).csv(f"{root}/in/whole")
    short = raw.filter("event_id % 9 = 0").select(F.col("artist").alias("a"), F.lit("x").alias("b"))
    short.write.option("header", True).csv(f"{root}/in/short")
    run_query_tables(spark, [f"{root}/in/whole", f"{root}/in/short"], f"{root}/out", ["ts"])
    frames = {t: spark.read.parquet(f"{root}/out/{t}") for t in _QUERY_TABLES}
    rejects = spark.read.parquet(f"{root}/out/rejects/records").groupBy(F.col("reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    asked = {name: frames[t].filter(condition) for name, (t, condition, _) in _ASK.items()}
    return _lines({**frames, **asked, "rejects": rejects}, _ASKED)


# -- immigration --------------------------------------------------------------

_COUNTRIES = "countries AS (SELECT DISTINCT CAST(s_nationkey + 100 AS VARCHAR) AS code FROM supplier)"
_KNOWN = f"""WITH {inputs.IMMIGRATION_SQL}, {_COUNTRIES}, known AS (SELECT * FROM records
  WHERE i94cit IN (SELECT code FROM countries) AND i94res IN (SELECT code FROM countries))"""
_FACT_SQL = (
    f"{_KNOWN} SELECT "
    + ", ".join(f"{column} AS {name}" for column, name in immigration.FACT_COLUMNS.items())
    + ', count(*) AS "count" FROM known GROUP BY ALL'
)
_CITY_SQL = f"WITH {inputs.CITIES_SQL}, {inputs.CITY_CODES_SQL} SELECT m.*, " + ", ".join(
    f"CAST({{f}}(c.{p}) AS BIGINT) AS {p}" for p in immigration.POPULATIONS
) + """ FROM cities c JOIN city_map m ON m.city_name = c.city_name AND m.state_code = c.state_code
  GROUP BY m.city_code, m.city_name, m.state_code, m.state_name"""


def _records(spark, sf, names=False):
    raw = immigration_records(inputs.immigration_input(spark, sf))
    return immigration.clean_records(raw, immigration.countries(inputs.catalogues(spark, sf)), names)


@exercise("immigration_fact", _FACT_SQL)
def immigration_fact(spark, sf):
    return immigration.immigration_fact(_records(spark, sf))


@exercise("immigration_fact_incremental", _FACT_SQL)
def immigration_fact_incremental(spark, sf):
    """The fact kept up to date by three batches of records, each reduced to counts and merged into the buckets it meets."""
    root, records = scratch_dir(spark, "factincremental"), stage(_records(spark, sf), "records")
    for part in range(3):
        immigration.add_to_fact(records.filter(F.col("cicid") % 3 == part), root, buckets=8)
    return immigration.fact_of(read_current(spark, root))


@exercise(
    "temperature_dim_incremental",
    f"""WITH {inputs.TEMPERATURE_SQL} SELECT country_name AS country, date, avg(average_temperature) AS average_temperature
        FROM temperatures WHERE year(date) >= 1900 GROUP BY 1, 2""",
)
def temperature_dim_incremental(spark, sf):
    """Mean temperatures from the sums and counts of two batches."""
    root = scratch_dir(spark, "temperatureincremental")
    readings = stage(immigration.clean_temperatures(inputs.temperature_file(spark, sf)), "readings")
    for part in range(2):
        immigration.add_temperatures(readings.filter(F.crc32("city_name") % 2 == part), root, buckets=8)
    return immigration.temperatures_of(read_current(spark, root))


@exercise(
    "immigration_named",
    f"""{_KNOWN} SELECT cicid, arrival_date, departure_date, i94cit, i94res, 'COUNTRY ' || i94res AS residency_country,
        'COUNTRY ' || i94cit AS origin_country, 'Pleasure' AS visa_name FROM known""",
)
def immigration_named(spark, sf):
    named = immigration.with_visa_names(spark, _records(spark, sf, names=True))
    return named.select(
        "cicid", "arrival_date", "departure_date", "i94cit", "i94res", "residency_country", "origin_country", "visa_name"
    )


@exercise(
    "immigration_dates",
    f"""{_KNOWN} SELECT DISTINCT arrival_date AS date, CAST(year(arrival_date) AS INTEGER) AS year,
        CAST(month(arrival_date) AS INTEGER) AS month, CAST(day(arrival_date) AS INTEGER) AS day FROM known ORDER BY date DESC""",
)
def immigration_dates(spark, sf):
    return immigration.arrival_dates(_records(spark, sf), ordered=True)


@exercise("us_cities_dim", _CITY_SQL.format(f="sum"))
def us_cities_dim(spark, sf):
    return _cities(spark, sf, "sum")


@exercise("us_cities_dim_max", _CITY_SQL.format(f="max"))
def us_cities_dim_max(spark, sf):
    return _cities(spark, sf, "max")


def _cities(spark, sf, how):
    rows = immigration.clean_cities(inputs.city_file(spark, sf).withColumnsRenamed(immigration.CITY_COLUMNS))
    return immigration.us_cities(rows, stage(immigration.cities_of(inputs.catalogues(spark, sf)), "cities"), how)


@exercise(
    "temperature_dim",
    f"""WITH {inputs.TEMPERATURE_SQL} SELECT country_name AS country, date, avg(average_temperature) AS average_temperature
        FROM temperatures WHERE year(date) >= 1900 GROUP BY 1, 2 ORDER BY date DESC, country""",
)
def temperature_dim(spark, sf):
    readings = immigration.clean_temperatures(inputs.temperature_file(spark, sf))
    return immigration.temperature_dim(readings, ordered=True)


@exercise("run_immigration_load", _FACT_SQL)
def run_immigration_load(spark, sf):
    """All four inputs from files, all four tables written and checked; the fact read back."""
    root = scratch_dir(spark, "immigrationrun")
    inputs.immigration_input(spark, sf).write.parquet(f"{root}/in/records")
    inputs.temperature_file(spark, sf).write.option("header", True).csv(f"{root}/in/temperatures")
    inputs.city_file(spark, sf).write.option("header", True).option("sep", ";").csv(f"{root}/in/cities")
    inputs.catalogue_file(spark, sf).write.text(f"{root}/in/labels")
    run_immigration(
        spark,
        [f"{root}/in/records"],
        f"{root}/in/temperatures",
        f"{root}/in/cities",
        f"{root}/in/labels",
        f"{root}/out",
    )
    fact = spark.read.parquet(f"{root}/out/immigration_fact")
    return fact.select(*immigration.FACT_COLUMNS.values(), "count")


_IMMIGRATION_TABLES = {
    "immigration_fact": (_FACT_SQL, [*immigration.FACT_COLUMNS.values(), "count"]),
    "us_cities_dim": (
        f"""WITH {inputs.CITIES_SQL}, ports AS (SELECT s_nationkey AS n, min(s_suppkey) AS port FROM supplier GROUP BY 1)
            SELECT 'P' || port AS city_code, 'CITY ' || port AS city_name, 'ST' || n AS state_code, 'STATE ' || n AS state_name, """
        + ", ".join(f"CAST(sum({p}) AS BIGINT) AS {p}" for p in immigration.POPULATIONS)
        + " FROM cities JOIN ports ON city_name = 'CITY ' || port AND state_code = 'ST' || n GROUP BY port, n",
        immigration.CITY_OUTPUT,
    ),
    "temperature_dim": (ORACLES["temperature_dim"], ["country", "date", "average_temperature"]),
    "time_dim": (ORACLES["immigration_dates"], ["date", "year", "month", "day"]),
    "bad_records": (
        f"WITH {inputs.IMMIGRATION_SQL} SELECT 'i94bir: malformed' AS reason, count(*) AS n FROM immigration_input",
        ["reason", "n"],
    ),
    "bad_cities": ("SELECT 'total_population: malformed' AS reason, count(*) AS n FROM customer", ["reason", "n"]),
}


@exercise("run_immigration_tables", _lines_sql(_IMMIGRATION_TABLES))
def run_immigration_tables(spark, sf):
    """All four tables from CSV records under a header of another order with further columns; every record and every city
    row also comes once with a number that does not parse, and is set aside."""
    root = scratch_dir(spark, "immigrationtables")
    _immigration_csv(spark, sf, f"{root}/in/records")
    inputs.temperature_file(spark, sf).write.option("header", True).csv(f"{root}/in/temperatures")
    cities = inputs.city_file(spark, sf)
    broken = cities.withColumn("Total Population", F.lit("many"))
    cities.unionByName(broken).write.option("header", True).option("sep", ";").csv(f"{root}/in/cities")
    inputs.catalogue_file(spark, sf).write.text(f"{root}/in/labels")
    paths = [f"{root}/in/{t}" for t in ("temperatures", "cities", "labels")]
    run_immigration(spark, [f"{root}/in/records"], *paths, f"{root}/out", fmt="csv", malformed="reject")
    frames = {t: spark.read.parquet(f"{root}/out/{t}") for t in _IMMIGRATION_TABLES if not t.startswith("bad")}
    for name in ("records", "cities"):
        rejects = spark.read.parquet(f"{root}/out/rejects/{name}")
        frames[f"bad_{name}"] = rejects.groupBy(F.col("reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    return _lines(frames, _IMMIGRATION_TABLES)


def _immigration_csv(spark, sf, path):
    rows = inputs.immigration_input(spark, sf)
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns])
    both = texts.unionByName(texts.withColumn("i94bir", F.lit("old")))
    ordered = both.select(F.lit("x").alias("admnum"), *reversed(both.columns), F.lit("").alias("dtaddto"))
    ordered.write.option("header", True).csv(path)


@exercise(
    "src_immigration_csv",
    f"""WITH {inputs.IMMIGRATION_SQL} SELECT cicid, i94cit, i94res, i94port, i94mode, i94addr, i94bir, i94visa, gender, airline, visatype,
          'good' AS outcome FROM records
        UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'i94bir: malformed' FROM immigration_input""",
)
def src_immigration_csv(spark, sf):
    """Records as CSV under a header of another order with further columns; each also once with an age that is no number."""
    root = scratch_dir(spark, "immigrationcsv")
    _immigration_csv(spark, sf, root)
    records, rejects = read_immigration(spark, [root], "csv", malformed="reject")
    good = records.drop("arrdate", "depdate").withColumn("outcome", F.lit("good"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in good.schema.fields if f.name != "outcome"]
    return good.unionByName(rejects.select(*nothing, F.col("reject_reason").alias("outcome")))
