import json

import pytest

from starmart.__main__ import main, parser
from starmart.contracts import EVENT_CSV_COLUMNS
from starmart.operators.checks import QualityError, TableCheck
from starmart.plans import music
from starmart.plans.runs import backfill, run_lake, run_relational, run_scheduled, run_warehouse, stage_music
from starmart.sinks import read_current
from starmart.streaming.incremental import load_new_events

DAY1, DAY2 = 1541990258796, 1542076658796


def event(ts, user="10", item=0, level="free", song="T", artist="A", page="NextSong", length=152.92, **more):
    return {
        "artist": artist, "auth": "Logged In", "firstName": "Ann", "gender": "F", "itemInSession": item, "lastName": "Lee",
        "length": length, "level": level, "location": " ", "method": "PUT", "page": page, "registration": 1.0,
        "sessionId": 182, "song": song, "status": 200, "ts": ts, "userAgent": "agent", "userId": user, **more,
    }


def song(song_id, duration=152.92, **more):
    return {
        "num_songs": 1, "artist_id": "A1", "artist_latitude": None, "artist_longitude": None, "artist_location": "",
        "artist_name": "A", "song_id": song_id, "title": "T", "duration": duration, "year": 0, **more,
    }


def put(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r) for r in records))


@pytest.fixture
def files(tmp_path):
    put(tmp_path / "log" / "2018" / "11" / "12.json", event(DAY1), event(DAY1 + 5, item=1, level="paid", page="Home"))
    put(tmp_path / "log" / "2018" / "12" / "13.json", event(DAY2, level="paid"), event(DAY2 + 1, item=1, song="Unknown", level="paid"))
    put(tmp_path / "songs" / "a.json", song("S1"))
    put(tmp_path / "songs" / "b.json", song("S2", duration=400.0))
    return tmp_path


def test_scheduled_run_twice(spark, files, rows):
    root, template = str(files / "out"), str(files / "log" / "{year}" / "{month:02d}")
    for month in (11, 12, 12):
        report = run_scheduled(spark, template, str(files / "songs"), root, {"year": 2018, "month": month})
    assert all(r["passed"] for r in report.collect())
    plays = read_current(spark, f"{root}/songplays")
    assert sorted(str(r["song_id"]) for r in plays.collect()) == ["None", "S1", "S1"]
    assert {r["location"] for r in plays.collect()} == {None}  # blank is null
    assert read_current(spark, f"{root}/time").count() == 2
    assert rows(read_current(spark, f"{root}/users").select("user_id", "level")) == [(10, "paid")]
    assert read_current(spark, f"{root}/artists").count() == 1


def test_failed_check_stops_the_run(spark, files):
    with pytest.raises(QualityError, match="songplays: null song_id = 1"):
        run_scheduled(
            spark, str(files / "log" / "2018" / "*"), str(files / "songs"), str(files / "out"),
            checks=[TableCheck("songplays", ["song_id"])],
        )


def test_relational_run(spark, files, rows):
    root = str(files / "out")
    run_relational(spark, str(files / "log" / "2018" / "*"), str(files / "songs"), root, ["ts", "item_in_session"])
    assert rows(read_current(spark, f"{root}/users")) == [(10, "Ann", "Lee", "F", "paid")]
    plays = read_current(spark, f"{root}/songplays")
    assert sorted(str(r["song_id"]) for r in plays.collect()) == ["None", "S1", "S1"]
    assert plays.select("songplay_id").distinct().count() == 3
    assert {r["weekday"] for r in read_current(spark, f"{root}/time").collect()} == {0, 1}
    # the same load again: keyed tables stay, numbered plays are appended
    run_relational(spark, str(files / "log" / "2018" / "*"), str(files / "songs"), root, ["ts", "item_in_session"])
    counts = {t: read_current(spark, f"{root}/{t}").count() for t in ("users", "songs", "artists", "time", "songplays")}
    assert counts == {"users": 1, "songs": 2, "artists": 1, "time": 3, "songplays": 6}


def test_lake_run(spark, files, rows):
    root = str(files / "out")
    run_lake(spark, str(files / "log" / "2018" / "*"), str(files / "songs"), root, ["ts", "item_in_session"])
    plays = spark.read.parquet(f"{root}/songplays")
    assert rows(plays.select("songplay_id", "song_id", "year", "month")) == [
        (1, "S1", 2018, 11), (2, "S2", 2018, 11), (3, "S1", 2018, 11), (4, "S2", 2018, 11), (5, None, 2018, 11),
    ]
    assert rows(spark.read.parquet(f"{root}/users").select("level")) == [("free",), ("paid",)]
    assert spark.read.parquet(f"{root}/time").columns == ["ts", "timestamp", "day", "year", "month"]


def test_other_action(spark, files):
    events, songs = stage_music(spark, str(files / "log" / "2018" / "*"), str(files / "songs"), str(files / "stage"))
    assert music.plays_of(events, "Home").count() == 1
    mart = music.warehouse_mart(events, songs)
    assert mart["songplays"].count() == 4 and mart["users"].count() == 2 and mart["time"].count() == 2
    wide = music.songplays_rounded(music.plays_of(events), songs, key="wide")
    assert wide.count() == wide.select("songplay_id").distinct().count()


def test_stream_takes_new_files_only(spark, files, rows):
    root, checkpoint = str(files / "out"), str(files / "checkpoint")
    songs = spark.createDataFrame([("S1", "A1", "A", "T", 152.92)], "song_id string, artist_id string, artist_name string, title string, duration double")

    def run():
        query = load_new_events(spark, str(files / "log"), songs, root, checkpoint)
        query.awaitTermination()
        return read_current(spark, f"{root}/songplays").count()

    assert run() == 3
    assert run() == 3
    put(files / "log" / "2018" / "12" / "14.json", event(DAY2 + 9, item=7, level="free"), event(DAY2, level="paid"))
    assert run() == 4  # the repeated event adds nothing
    assert rows(read_current(spark, f"{root}/users").select("user_id", "level")) == [(10, "free")]


def test_command_line(spark, files, rows):
    events, songs, out = str(files / "log" / "2018" / "*"), str(files / "songs"), str(files / "out")
    main(["warehouse", "--events", events, "--songs", songs, "--out", out])
    assert read_current(spark, f"{out}/songplays").count() == 4
    main(["scheduled", "--events", str(files / "log" / "{y}" / "*"), "--songs", songs, "--out", f"{out}2", "--run", "y=2018"])
    assert read_current(spark, f"{out}2/songplays").count() == 3
    assert parser().parse_args(["lake", "--events", "a", "--songs", "b", "--out", "c"]).order[0] == "ts"


def test_query_tables_run(spark, tmp_path, rows):
    header = ",".join(EVENT_CSV_COLUMNS)
    line = "A,in,Ann,F,{item},Lee,{length},free,Rome,PUT,NextSong,1,182,{song},200,{ts},10"
    lines = [line.format(item=0, length=1.5, song="Late", ts=9), line.format(item=0, length=1.5, song="Early", ts=1),
             line.format(item="x", length=1.5, song="Bad", ts=1)]
    (tmp_path / "e.csv").write_text("\n".join([header, *lines]) + "\n")
    main(["query-tables", "--events", str(tmp_path / "e.csv"), "--out", str(tmp_path / "out"), "--order", "ts"])
    out = str(tmp_path / "out")
    assert rows(spark.read.parquet(f"{out}/by_session_item")) == [(182, 0, "A", "Late", 1.5)]
    assert spark.read.parquet(f"{out}/by_song").count() == 3
    assert spark.read.parquet(f"{out}/rejects/by_session_item").first()["reject_reason"] == "itemInSession: malformed"
    assert spark.read.text(f"{out}/cleaned").first()[0].startswith('"artist","firstName","gender","itemInSession"')


def test_late_song_records_replace_the_plays(spark, files):
    root, logs = str(files / "out"), str(files / "log" / "*" / "*")
    put(files / "early" / "a.json", song("S9", duration=1.0))
    for songs in ("early", "songs", "songs"):
        run_scheduled(spark, logs, str(files / songs), root, checks=[TableCheck("songplays")])
    plays = read_current(spark, f"{root}/songplays")
    assert sorted(str(r["song_id"]) for r in plays.collect()) == ["None", "S1", "S1"]


def test_play_identity_holds_the_user(spark, files):
    put(files / "two" / "a.json", event(DAY1, user="10"), event(DAY1, user="11"))
    root = str(files / "out")
    run_scheduled(spark, str(files / "two"), str(files / "songs"), root, checks=[TableCheck("songplays")])
    assert sorted(r["user_id"] for r in read_current(spark, f"{root}/songplays").collect()) == [10, 11]


def test_lake_reload_replaces_everything(spark, files):
    root = str(files / "out")
    for month in ("11", "12"):
        run_lake(spark, str(files / "log" / "2018" / month), str(files / "songs"), root, ["ts", "session_id", "item_in_session"])
    ids = [r["songplay_id"] for r in spark.read.parquet(f"{root}/songplays").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    assert spark.read.parquet(f"{root}/time").select("month").distinct().count() == 1


def test_long_texts_stay_whole(spark, files):
    title = "t" * 257
    put(files / "log" / "long" / "a.json", *[event(DAY1 + i, item=i, song=title + str(i), location="l" * 300) for i in range(3)])
    put(files / "songs" / "long.json", song("S7", title=title + "1"))
    root = str(files / "out")
    run_lake(spark, str(files / "log" / "long"), str(files / "songs"), root, ["ts", "session_id", "item_in_session"])
    rows = spark.read.parquet(f"{root}/songplays").collect()
    assert {len(r["location"]) for r in rows} == {300} and sorted(str(r["song_id"]) for r in rows) == ["None", "None", "S7"]
    with pytest.raises(Exception, match="title: over 256 characters"):
        run_warehouse(spark, str(files / "log" / "*" / "*"), str(files / "songs"), f"{root}/w")
    assert run_warehouse(spark, str(files / "log" / "*" / "*"), str(files / "songs"), f"{root}/w", too_wide="reject") == 1
    assert read_current(spark, f"{root}/w/songs").filter("song_id = 'S7'").count() == 0


def test_unfinished_versions_raise(spark, tmp_path):
    spark.range(1).write.parquet(f"{tmp_path}/t/v1")
    (tmp_path / "t" / "v1" / "_SUCCESS").unlink()
    with pytest.raises(RuntimeError, match="finished"):
        read_current(spark, f"{tmp_path}/t")


@pytest.mark.parametrize("run", [run_lake, run_relational])
def test_malformed_lines_are_set_aside(spark, files, run):
    (files / "log" / "2018" / "11" / "bad.json").write_text('{"broken": \n' + json.dumps(event(DAY1 + 9, item=2, length="long")))
    root, order = str(files / "out"), ["ts", "session_id", "item_in_session"]
    arguments = (spark, str(files / "log" / "*" / "*"), str(files / "songs"), root, order)
    with pytest.raises(Exception):
        run(*arguments)
    run(*arguments, malformed="reject")
    rejects = spark.read.parquet(f"{root}/rejects/{'events' if run is run_lake else 'staging_events'}")
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["length: malformed", "record: malformed; ts: null"]


def test_backfill_replaces_one_run(spark, files, rows):
    root, template = str(files / "out"), str(files / "log" / "{year}" / "{month:02d}")
    months = [{"year": 2018, "month": m} for m in (11, 12)]
    checks = [TableCheck("songplays")]
    backfill(spark, template, str(files / "songs"), root, months, checks)
    put(files / "log" / "2018" / "11" / "12.json", event(DAY1 + 7, user="11", item=3))  # the file of the first run was wrong
    found = backfill(spark, template, str(files / "songs"), root, months[:1], checks)
    assert rows(found.select("run", "load")) == [("month=11,year=2018", 3), ("month=12,year=2018", 2)]
    plays = read_current(spark, f"{root}/songplays")
    assert sorted(r["user_id"] for r in plays.collect()) == [10, 10, 11]
    assert sorted(r["user_id"] for r in read_current(spark, f"{root}/users").collect()) == [10, 11]  # of all runs
    with pytest.raises(ValueError, match="name it"):
        run_scheduled(spark, str(files / "log" / "*" / "*"), str(files / "songs"), root, None, checks, by_run=True)


def test_stream_sets_bad_lines_aside_and_drops_replays(spark, files):
    root, checkpoint, folder = str(files / "out"), str(files / "checkpoint"), files / "arrived"
    songs = spark.createDataFrame([("S1", "A1", "A", "T", 152.92)], "song_id string, artist_id string, artist_name string, title string, duration double")
    good = json.dumps(event(DAY1))
    bad = [good[: len(good) // 2], json.dumps(event("soon", item=1)), json.dumps(event(DAY1, item=2) | {"userId": "x"}), json.dumps(event(DAY1, item=3, length="  "))]

    def run(name, lines):
        folder.mkdir(exist_ok=True)
        (folder / name).write_text("\n".join(lines))
        query = load_new_events(spark, str(folder), songs, root, checkpoint)
        query.awaitTermination()
        return sum(s["customMetrics"]["numDroppedDuplicateRows"] for p in query.recentProgress for s in p["stateOperators"])

    assert run("a.json", [good, *bad]) == 0
    plays = read_current(spark, f"{root}/songplays").collect()
    assert len(plays) == 2 and all(r["start_time"] for r in plays)  # a blank length is null, as in the batch load
    assert run("b.json", [good, *bad, json.dumps(event(DAY1 - 10**10, item=9))]) == 5  # and a new event, long past
    assert read_current(spark, f"{root}/songplays").count() == 3
    reasons = [r["reject_reason"] for r in read_current(spark, f"{root}/rejects/stream").collect()]
    assert sorted(reasons) == ["record: malformed; ts: null", "ts: malformed", "user_id: malformed"]


def test_rejects_and_good_rows_come_of_one_parse(spark, files, plan):
    """Without what is staged by them the two results scan the staged lines, not the JSON."""
    from starmart.contracts import STAGED_SONGS
    from starmart.sources import read_json_auto

    good, rejects = read_json_auto(spark, str(files / "songs"), STAGED_SONGS, malformed="reject")
    for df in (good, rejects):
        assert "FileScan parquet" in plan(df) and "FileScan json" not in plan(df)
