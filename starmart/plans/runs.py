"""Whole runs: stage, build, load and check, in dependency order."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.contracts import (
    EVENT_PATHS,
    SESSION_ITEMS,
    STAGED_EVENTS,
    STAGED_SONGS,
    WAREHOUSE_SONG_WIDTHS,
    fit_widths,
)
from starmart.functions.keys import sequence_id
from starmart.operators.checks import TableCheck, enforce, run_checks
from starmart.plans import immigration, music, session_items
from starmart.session import stage
from starmart.sinks.files import write_parquet, write_quoted_csv, write_songs
from starmart.sinks.commits import newest, read_parts
from starmart.sinks.loads import (
    append,
    append_new,
    insert_first_wins,
    insert_numbered,
    ledger,
    read_current,
    read_run,
    replace_by_key,
    replace_run,
    truncate_insert,
    upsert,
)
from starmart.sources.files import expand_paths, read_immigration, read_json_auto, read_json_paths
from starmart.sources.labels import read_catalogue


def _parsed(read, malformed: str, name: str, root: str) -> DataFrame:
    """Rows of a bulk load; rejected ones, if they are to be set aside, are written under ``rejects``."""
    if malformed != "reject":
        return read(malformed=malformed)
    good, rejects = read(malformed=malformed)
    write_parquet(rejects, f"{root}/rejects/{name}")
    return good


def stage_music(
    spark: SparkSession,
    event_paths: str | list[str],
    song_paths: str | list[str],
    root: str,
    run: dict | None = None,
    malformed: str = "fail",
    by_run: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Raw JSON to staged Parquet, replaced on every run; paths may be templates filled from ``run``.

    ``malformed="reject"`` sets lines and values that do not parse aside, under ``rejects``. ``by_run`` keeps the staged
    events of each run, replaces those of this one and returns those.
    """

    def paths(given: str | list[str]) -> list[str]:
        given = [given] if isinstance(given, str) else given
        return [p for g in given for p in expand_paths(g, run or {})]

    events = _parsed(partial(read_json_paths, spark, paths(event_paths), EVENT_PATHS, STAGED_EVENTS), malformed, "staging_events", root)
    songs = _parsed(partial(read_json_auto, spark, paths(song_paths), STAGED_SONGS), malformed, "staging_songs", root)
    truncate_insert(songs, f"{root}/staging_songs")
    staged_songs = read_current(spark, f"{root}/staging_songs")
    if by_run:
        replace_run(events, f"{root}/staging_events", run_name(run))
        return read_run(spark, f"{root}/staging_events", run_name(run)), staged_songs
    truncate_insert(events, f"{root}/staging_events")
    return read_current(spark, f"{root}/staging_events"), staged_songs


def run_name(run: dict | None) -> str:
    """A run's name in the ledger, from the values that fill its paths."""
    if not run:
        raise ValueError("a run that is kept apart needs the values that name it")
    return ",".join(f"{k}={run[k]}" for k in sorted(run))


def run_scheduled(
    spark: SparkSession,
    event_paths: str | list[str],
    song_paths: str | list[str],
    root: str,
    run: dict | None = None,
    checks: list[TableCheck] | None = None,
    action: str = "NextSong",
    malformed: str = "fail",
    by_run: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """One scheduled run: stage both inputs, load the fact, then the four dimensions, then the checks.

    Plays are identified by user, session, time and item; a repeated run replaces the plays of its
    events, so song records that arrived meanwhile count. Dimensions are replaced. The time dimension is read off the loaded fact.
    ``buckets`` lays a new fact out by its key, so that a repeated run rewrites only what it meets.

    ``by_run`` keeps what each run loaded apart, under the values of ``run``: a repeated run replaces exactly its own
    plays and staged events, without reading those of others, and users are those of all runs. An event belongs to
    the run whose files hold it. A table is loaded in one of the two ways.
    Returns the check report, and raises when a check fails.
    """
    events, songs = stage_music(spark, event_paths, song_paths, root, run, malformed, by_run)
    plays = music.plays_of(events, action)
    rows = music.songplays_rounded(plays, songs, key="wide")
    if by_run:
        replace_run(rows, f"{root}/songplays", run_name(run))
        plays = music.plays_of(read_current(spark, f"{root}/staging_events"), action)
    else:
        replace_by_key(rows, f"{root}/songplays", ["songplay_id"], buckets)
    fact = read_current(spark, f"{root}/songplays")
    truncate_insert(music.users_distinct(plays), f"{root}/users")
    truncate_insert(music.songs_distinct(songs), f"{root}/songs")
    truncate_insert(music.artists_distinct(songs), f"{root}/artists")
    truncate_insert(music.time_of_fact(fact), f"{root}/time")
    tables = {t: read_current(spark, f"{root}/{t}") for t in ("songplays", "users", "songs", "artists", "time")}
    report = run_checks(tables, checks)
    enforce(report)
    return report


def backfill(
    spark: SparkSession,
    event_paths: str | list[str],
    song_paths: str | list[str],
    root: str,
    runs: list[dict],
    checks: list[TableCheck] | None = None,
    action: str = "NextSong",
    malformed: str = "fail",
) -> DataFrame:
    """Load some runs again, in any order, each in place of what it loaded before; returns the ledger of the fact:
    which run's rows stand in it, from which load and since when."""
    for run in runs:
        run_scheduled(spark, event_paths, song_paths, root, run, checks, action, malformed, by_run=True)
    return ledger(spark, f"{root}/songplays")


def run_relational(
    spark: SparkSession,
    event_paths: str | list[str],
    song_paths: str | list[str],
    root: str,
    order: list[str],
    action: str = "NextSong",
    malformed: str = "fail",
    buckets: int | None = None,
) -> None:
    """One load into keyed tables: songs and artists before the plays that look them up.

    ``order`` are the staged event columns that put one user's events in sequence. ``buckets`` lays new users out by
    their key, so that a later load rewrites only those it meets.
    """
    events, songs = stage_music(spark, event_paths, song_paths, root, malformed=malformed)
    plays = music.plays_of(events, action)
    insert_first_wins(music.songs_first(songs, ["song_id"]), f"{root}/songs", ["song_id"], [])
    insert_first_wins(music.artists_first(songs, ["song_id"]), f"{root}/artists", ["artist_id"], [])
    insert_first_wins(music.time_of_plays(plays), f"{root}/time", ["start_time"], [])
    known = plays.select(*dict.fromkeys([*music.USER_COLUMNS, *order]))
    upsert(known, f"{root}/users", ["user_id"], ["level"], order, buckets)
    stored_songs, stored_artists = read_current(spark, f"{root}/songs"), read_current(spark, f"{root}/artists")
    insert_numbered(music.songplays_lookup(plays, stored_songs, stored_artists), f"{root}/songplays", "songplay_id")


def run_warehouse(
    spark: SparkSession,
    event_paths: str | list[str],
    song_paths: str | list[str],
    root: str,
    action: str = "NextSong",
    too_wide: str = "fail",
    malformed: str = "fail",
) -> int:
    """Stage both inputs and replace the five tables; plays get a generated number.

    Song texts have a width here. Returns how many song records were over it, set aside under ``rejects/songs``
    (``too_wide="reject"``) or cut (``"cut"``); by default the first one fails the run.
    """
    events, songs = stage_music(spark, event_paths, song_paths, root, malformed=malformed)
    songs, aside = fit_widths(songs, WAREHOUSE_SONG_WIDTHS, too_wide)
    write_parquet(aside, f"{root}/rejects/songs")
    mart = music.warehouse_mart(events, songs, action)
    numbered = mart["songplays"].select(sequence_id().alias("songplay_id"), "*")
    for name, df in {**mart, "songplays": numbered}.items():
        truncate_insert(df, f"{root}/{name}")
    return spark.read.schema(aside.schema).parquet(f"{root}/rejects/songs").count()


def run_lake(
    spark: SparkSession,
    event_paths: str | list[str],
    song_paths: str | list[str],
    root: str,
    order: list[str],
    action: str = "NextSong",
    malformed: str = "fail",
) -> None:
    """Raw JSON to the partitioned data-lake tables.

    The plays are filtered and pruned while the JSON is parsed, once, and staged for the five tables.
    """
    events = _parsed(partial(read_json_paths, spark, event_paths, EVENT_PATHS, STAGED_EVENTS), malformed, "events", root)
    needed = [*music.USER_COLUMNS, "page", "ts", "song", "artist", "session_id", "location", "user_agent", *order]
    plays = stage(music.plays_of(events, action).select(*dict.fromkeys(needed)), "plays")
    songs = stage(_parsed(partial(read_json_auto, spark, song_paths, STAGED_SONGS), malformed, "songs", root), "songs")
    write_lake_mart(music.lake_mart(plays, songs, order, action), root)


def run_lake_increment(
    spark: SparkSession,
    event_paths: str | list[str],
    song_paths: str | list[str],
    root: str,
    order: list[str],
    action: str = "NextSong",
    malformed: str = "fail",
) -> None:
    """Add the plays of further files to data-lake tables that keep their rows (committed loads under ``root``).

    Plays are numbered on from the highest stored number, without a gap. Of the dimensions only rows that are not there
    yet are added. The fact is published last, so a load that breaks off before can be run again.
    """
    events = _parsed(partial(read_json_paths, spark, event_paths, EVENT_PATHS, STAGED_EVENTS), malformed, "events", root)
    needed = [*music.USER_COLUMNS, "page", "ts", "song", "artist", "session_id", "location", "user_agent", *order]
    plays = stage(music.plays_of(events, action).select(*dict.fromkeys(needed)), "plays")
    songs = stage(_parsed(partial(read_json_auto, spark, song_paths, STAGED_SONGS), malformed, "songs", root), "songs")
    fact = f"{root}/songplays"
    stored = newest(spark, fact)
    high = read_parts(spark, fact, stored).agg(F.coalesce(F.max("songplay_id"), F.lit(0))).first()[0] if stored else 0
    mart = music.lake_mart(plays, songs, order, action, after=high)
    for name, partition_by in (("songs", ["year"]), ("artists", []), ("users", []), ("time", ["year", "month"])):
        append_new(mart[name], f"{root}/{name}", mart[name].columns, partition_by=partition_by)
    if stored:
        append(mart["songplays"], fact)
    else:
        truncate_insert(mart["songplays"], fact, ["year", "month"])


def run_query_tables(
    spark: SparkSession, event_paths: str | list[str], root: str, order: list[str] | None = None
) -> None:
    """Event CSV files to the cleaned file and the three query tables, each with its rejected rows beside it."""
    order = order or []
    parsed, broken = session_items.parsed_items(spark, event_paths, order)
    items = stage(parsed, "items")
    write_quoted_csv(items.select(*SESSION_ITEMS.columns), f"{root}/cleaned")
    for name, table in session_items.TABLES.items():
        rows, rejects = session_items.query_table(items, table, order)
        session_items.write_query_table(rows, table, f"{root}/{name}")
        write_parquet(rejects, f"{root}/rejects/{name}")
    write_parquet(broken, f"{root}/rejects/records")


def write_lake_mart(mart: dict[str, DataFrame], root: str) -> None:
    """The data-lake layout, each table replaced as a whole: songs by year, time and songplays by year and month."""
    write_songs(mart["songs"], f"{root}/songs")
    write_parquet(mart["artists"], f"{root}/artists")
    write_parquet(mart["users"], f"{root}/users")
    write_parquet(mart["time"], f"{root}/time", ["year", "month"])
    write_parquet(mart["songplays"], f"{root}/songplays", ["year", "month"])


def _written(mart: dict[str, DataFrame], name: str, root: str) -> DataFrame:
    """A table read back under its own schema, which a folder without files cannot give."""
    return mart[name].sparkSession.read.schema(mart[name].schema).parquet(f"{root}/{name}")


def write_immigration_mart(mart: dict[str, DataFrame], root: str) -> None:
    """The fact by arrival date and temperatures by date; the arrival dates are read off the written fact."""
    write_parquet(mart["immigration_fact"], f"{root}/immigration_fact", ["arrival_date"])
    write_parquet(mart["us_cities_dim"], f"{root}/us_cities_dim")
    write_parquet(mart["temperature_dim"], f"{root}/temperature_dim", ["date"])
    fact = _written(mart, "immigration_fact", root)
    write_parquet(immigration.arrival_dates(fact), f"{root}/time_dim")


def run_immigration(
    spark: SparkSession,
    record_paths: list[str],
    temperature_path: str,
    city_path: str,
    catalogue_path: str,
    root: str,
    fmt: str = "parquet",
    malformed: str = "fail",
) -> DataFrame:
    """Load, clean, build and write the immigration tables, then check that none is empty.

    ``malformed="reject"`` sets immigration records, city rows and temperature readings with a number or date that does
    not parse aside, under ``rejects``. By default such a record or reading fails the run, while a city's
    unparsable count is null and not summed.
    """
    if malformed == "reject":
        records, bad_records = read_immigration(spark, record_paths, fmt, malformed="reject")
        cities, bad_cities = immigration.city_rows(spark, city_path)
        temperatures, bad_temperatures = immigration.temperature_rows(spark, temperature_path)
        for name, rows in (("records", bad_records), ("cities", bad_cities), ("temperatures", bad_temperatures)):
            write_parquet(rows, f"{root}/rejects/{name}")
    else:
        records = read_immigration(spark, record_paths, fmt)
        cities = immigration.city_records(spark, city_path)
        temperatures = immigration.temperature_records(spark, temperature_path)
    mart = immigration.immigration_mart(records, temperatures, cities, read_catalogue(spark, catalogue_path))
    write_immigration_mart(mart, root)
    report = run_checks({t: _written(mart, t, root) for t in mart}, [TableCheck(t) for t in mart])
    enforce(report)
    return report
