import os
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starmart.exercises import QUERIES
from starmart.sinks import read_folders, write_parquet, write_songs
from starmart.sinks import files, folders

ODD = [
    ("a", 2000, None), ("b", 2000, ""), ("c", None, "A:1/ü %=é"), ("d", 2001, "__HIVE_DEFAULT_PARTITION__"),
    ("e", 2001, "A1"), ("f", 2001, "A1"), (None, 2001, "a1"), ("", -1, "'[x]{y^z"), ("g", -1, "*?\\\"#\t.."),
]


def songs_of(spark, rows):
    return spark.createDataFrame(rows, "song_id string, year int, artist_id string")


def by_spark(monkeypatch, df, path, columns):
    with monkeypatch.context() as m:
        m.setattr(files, "can_write", lambda *a: False)
        write_parquet(df, str(path), columns, many_folders=True)


def test_a_folder_does_not_cost_processes(spark, tmp_path):
    """Hadoop without its native library starts several for each folder."""
    stat = Path("/proc/stat")
    if not stat.exists():
        pytest.skip("no count of processes")
    started = lambda: int(next(x.split()[1] for x in stat.read_text().splitlines() if x.startswith("processes")))
    songs = spark.range(800).selectExpr("concat('S', id) AS song_id", "int(2000 + id % 2) AS year", "concat('A', id) AS artist_id")
    write_songs(songs.limit(1), str(tmp_path / "first"), folder_per_artist=True)  # workers and threads
    before = started()
    write_songs(songs, str(tmp_path / "ya"), folder_per_artist=True)
    assert started() - before < 800
    assert len(list((tmp_path / "ya").glob("year=*/artist_id=*/*.parquet"))) == 800


def test_reading_keeps_no_files_on_the_driver(spark, tmp_path):
    songs = songs_of(spark, [(f"S{i}", 2000 + i % 2, f"A{i}") for i in range(30)])
    write_songs(songs, str(tmp_path / "ya"), folder_per_artist=True)
    found = read_folders(spark, str(tmp_path / "ya"), songs.schema, ["year", "artist_id"])
    assert found.inputFiles() == [] and found.count() == 30


def test_the_query_reads_by_tasks(spark):
    found = QUERIES["snk_songs_year_artist"](spark, "/root/testdata/sf0.001")
    assert found.inputFiles() == [] and found.columns == ["song_id", "title", "duration", "year", "artist_id"]


def test_odd_values_have_the_folders_of_sparks_writer(spark, tmp_path, rows, monkeypatch):
    """Its own folders are compared in ASCII only: what Java makes of other letters depends on the machine's locale."""
    df = songs_of(spark, ODD)
    write_parquet(df, str(tmp_path / "ours"), ["year", "artist_id"], many_folders=True)
    plain = df.filter("year IS NOT NULL")
    by_spark(monkeypatch, plain, tmp_path / "spark", ["year", "artist_id"])
    names = lambda top: {str(p.relative_to(top)) for p in top.glob("year=*/*")}
    assert names(tmp_path / "ours") == names(tmp_path / "spark") | {"year=__HIVE_DEFAULT_PARTITION__/artist_id=A%3A1%2Fü %25%3Dé"}
    wanted = sorted(
        [(s, y, None if a in ("", "__HIVE_DEFAULT_PARTITION__") else a) for s, y, a in ODD], key=lambda t: [(v is not None, str(v)) for v in t]
    )
    assert rows(read_folders(spark, str(tmp_path / "ours"), df.schema, ["year", "artist_id"])) == wanted
    for top in ("ours", "spark"):  # each reader takes what either wrote
        back = read_folders(spark, str(tmp_path / top), df.schema, ["year", "artist_id"]).filter("year IS NOT NULL")
        assert rows(back) == rows(spark.read.schema(df.schema).parquet(str(tmp_path / top)).select(*back.columns).filter("year IS NOT NULL"))


def test_types_and_levels(spark, tmp_path, rows):
    df = spark.createDataFrame(
        [(1, 2**40, 1.5, True, b"x", date(2020, 1, 2), datetime(2020, 1, 2, 3, 4, 5, 6), "t", date(1999, 12, 31)), (None,) * 9],
        "i int, l bigint, d double, b boolean, y binary, day date, at timestamp, `a.b` string, `c.d` date",
    )
    for n, columns in enumerate((["i"], ["l", "c.d"], ["i", "l", "day"])):
        path = str(tmp_path / str(n))
        folders.write_folders(df, path, columns)
        assert os.path.exists(f"{path}/_SUCCESS")
        back = read_folders(spark, path, df.schema, columns).select(*[f"`{c}`" for c in df.columns])
        assert [f.dataType for f in back.schema] == [f.dataType for f in df.schema] and rows(back) == rows(df)
        seen = spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
        assert rows(seen) == rows(df)
        inferred = spark.read.parquet(path).schema
        assert all(inferred[f.name].dataType == f.dataType for f in df.schema if f.name not in columns)


def test_one_folder_with_many_rows(spark, tmp_path, monkeypatch):
    """Several batches, row groups and tasks for one folder, in the order asked for."""
    monkeypatch.setattr(folders, "BYTES", 100_000)
    df = spark.range(0, 60_000, 1, 8).selectExpr("id", "int(1) AS year", "if(id < 59000, 'hot', concat('A', id % 50)) AS artist_id")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20kb")
    try:
        write_parquet(df, str(tmp_path / "t"), ["year", "artist_id"], sort_by=["id"], many_folders=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t/year=1/artist_id=hot").glob("*.parquet"))) > 1
    for back in (read_folders(spark, str(tmp_path / "t"), df.schema, ["year", "artist_id"]), spark.read.parquet(str(tmp_path / "t"))):
        assert back.count() == 60_000 and back.select("id").distinct().count() == 60_000
        assert back.filter("artist_id = 'hot'").count() == 59_000


def test_attempts_that_break_off_leave_no_rows(spark, tmp_path):
    """A file of an attempt that no one counts as done is not read, and deleted when the others get their names."""
    root = tmp_path / "t"
    df = songs_of(spark, [(f"S{i}", 2000, f"A{i}") for i in range(6)])
    folders.write_folders(df, str(root), ["year", "artist_id"])
    done = next((root / "year=2000/artist_id=A0").glob("*.parquet"))
    left, late = (done.parent / f"{folders.PENDING}part-0000{n}-x.parquet.{n}" for n in (1, 2))
    for file in (left, late):
        file.write_bytes(done.read_bytes())
    assert read_folders(spark, str(root), df.schema, ["year", "artist_id"]).count() == spark.read.parquet(str(root)).count() == 6
    for _ in range(2):
        names = folders._folders(spark, str(root), 2)
        names.mapInArrow(folders._publisher(str(root), {"2"}), "folder string").collect()
    assert not left.exists() and not late.exists()
    assert read_folders(spark, str(root), df.schema, ["year", "artist_id"]).count() == spark.read.parquet(str(root)).count() == 7


def test_a_failed_write_keeps_the_last_table(spark, tmp_path):
    root = tmp_path / "t"
    df = songs_of(spark, [("S1", 2000, "A1")])
    write_parquet(df, str(root), ["year", "artist_id"], many_folders=True)
    broken = df.withColumn("song_id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        write_parquet(broken, str(root), ["year", "artist_id"], many_folders=True)
    assert os.listdir(tmp_path) == ["t"] and read_folders(spark, str(root), df.schema, ["year", "artist_id"]).count() == 1
    write_parquet(df.limit(0), str(root), ["year", "artist_id"], many_folders=True)
    assert read_folders(spark, str(root), df.schema, ["year", "artist_id"]).count() == 0


def test_elsewhere_sparks_own_sinks_are_used(spark, tmp_path):
    df = songs_of(spark, [("S1", 2000, "A1")])
    columns = ["year", "artist_id"]
    assert folders.can_write(df, str(tmp_path / "t"), columns) and folders.can_write(df, f"file://{tmp_path}/t", columns)
    spark.conf.set("fs.viewfs.mounttable.store.link./t", f"file://{tmp_path}")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./t", f"file://{tmp_path}")
    assert not folders.can_write(df, "viewfs://store/t/x", columns)
    write_parquet(df, "viewfs://store/t/x", columns, many_folders=True)
    assert read_folders(spark, "viewfs://store/t/x", df.schema, columns).count() == 1
    assert not folders.can_write(df.withColumn("list", F.array("song_id")), str(tmp_path / "t"), columns)
    assert not folders.can_write(df.withColumn("year", F.col("year").cast("double")), str(tmp_path / "t"), columns)
    assert not folders.can_write(df.select(*columns), str(tmp_path / "t"), columns)
    nested = df.withColumn("list", F.array("song_id"))
    write_parquet(nested, str(tmp_path / "n"), columns, many_folders=True)
    assert read_folders(spark, str(tmp_path / "n"), nested.schema, columns).count() == 1
