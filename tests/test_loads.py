import pytest
from pyspark.sql import functions as F

from starmart.contracts import SONGS, TIME
from starmart.session import clear_scratch, stage
from starmart.sinks import (
    append,
    append_new,
    current_version,
    insert_first_wins,
    insert_numbered,
    read_current,
    truncate_insert,
    upsert,
    write_clustered,
    write_last_wins,
    write_parquet,
    write_songs,
)
from starmart.sinks.loads import prune_versions, replace_by_key
from starmart.sinks.tables import create_table, drop_table, insert_into, register_views, reset


@pytest.fixture
def users(spark):
    rows = [(1, "Ann", "free", 1), (1, "Anna", "paid", 2), (2, None, "free", 1), (2, "Bob", "free", 3)]
    return spark.createDataFrame(rows, "user_id int, first_name string, level string, ts int")


def test_append_keeps_duplicates_and_append_new_does_not(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    for _ in range(2):
        append(df, str(tmp_path / "a"))
        append_new(df, str(tmp_path / "n"), ["k"])
    assert read_current(spark, str(tmp_path / "a")).count() == 4
    assert rows(read_current(spark, str(tmp_path / "n"))) == [(1, "a"), (2, "b")]


def test_truncate_insert_may_read_its_target(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    truncate_insert(spark.range(5), root)
    for _ in range(2):
        truncate_insert(read_current(spark, root).filter("id > 2"), root)
    assert rows(read_current(spark, root)) == [(3,), (4,)]
    assert current_version(spark, root).endswith("/v3")


def test_unfinished_version_is_not_read(spark, tmp_path):
    root = tmp_path / "t"
    truncate_insert(spark.range(5), str(root))
    (root / "v2").mkdir()
    assert read_current(spark, str(root)).count() == 5
    assert truncate_insert(spark.range(3), str(root)).endswith("/v3")
    with pytest.raises(FileNotFoundError):
        read_current(spark, str(tmp_path / "none"))


def test_first_wins_against_the_table(spark, tmp_path, rows, users):
    root = str(tmp_path / "u")
    insert_first_wins(users.filter("user_id = 1").drop("ts"), root, ["user_id"], ["first_name"])
    insert_first_wins(users.drop("ts"), root, ["user_id"], ["first_name"])
    assert rows(read_current(spark, root)) == [(1, "Ann", "free"), (2, None, "free")]


def test_upsert_twice(spark, tmp_path, rows, users):
    root = str(tmp_path / "u")
    for _ in range(2):
        upsert(users, root, ["user_id"], ["level"], ["ts"])
        assert rows(read_current(spark, root)) == [(1, "Ann", "paid"), (2, None, "free")]


def test_last_wins_twice(spark, tmp_path, rows, users):
    root = str(tmp_path / "u")
    cols = ["user_id", "first_name", "level"]
    for _ in range(2):
        write_last_wins(users, root, ["user_id"], ["ts"], cols)
        assert rows(read_current(spark, root)) == [(1, "Anna", "paid"), (2, "Bob", "free")]


def test_numbers_go_on_above_the_table(spark, tmp_path):
    root = str(tmp_path / "n")
    for load in range(3):
        insert_numbered(spark.range(50).repartition(4).withColumn("load", F.lit(load)), root, "key")
    df = read_current(spark, root)
    assert df.select("key").distinct().count() == 150
    spans = df.groupBy("load").agg(F.min("key"), F.max("key")).orderBy("load").collect()
    assert spans[0][2] < spans[1][1] and spans[1][2] < spans[2][1] and spans[0][1] >= 1


def test_partitioned_write_gathers_and_reruns(spark, tmp_path):
    path = tmp_path / "p"
    df = spark.range(1_000).repartition(8).select("id", (F.col("id") % 4).alias("year"))
    write_parquet(df, str(path), ["year"])
    assert all(len(list(d.glob("*.parquet"))) == 1 for d in path.glob("year=*"))
    write_parquet(df.filter("year = 1").limit(3), str(path), ["year"], replace_only_written=True)
    assert spark.read.parquet(str(path)).count() == 753


def test_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "hot"
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20kb")
    try:
        df = spark.range(40_000).repartition(8).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(0).alias("year"))
        write_parquet(df, str(path), ["year"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((path / "year=0").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 40_000


def test_songs_layouts(spark, tmp_path):
    df = spark.createDataFrame([("S1", "t", "A1", 2000, 1.0), ("S2", "t", "A2", 2000, 1.0)], SONGS.schema)
    write_songs(df, str(tmp_path / "y"))
    assert [p.name for p in (tmp_path / "y").glob("year=*/*") if p.is_dir()] == []
    write_songs(df, str(tmp_path / "ya"), folder_per_artist=True)
    assert sorted(p.name for p in (tmp_path / "ya").glob("year=*/*")) == ["artist_id=A1", "artist_id=A2"]


def test_folders_per_artist_are_written_by_several_tasks(spark, tmp_path):
    songs = spark.range(40).selectExpr("id AS song_id", "'t' AS title", "concat('A', id % 20) AS artist_id", "int(2000 + id % 4) AS year")
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    write_songs(songs, str(tmp_path / "ya"), folder_per_artist=True)
    files = list((tmp_path / "ya").glob("year=*/artist_id=*/*.parquet"))
    assert len(files) == 20 and len({f.name.split("-")[1] for f in files}) > 1
    assert spark.conf.get(setting) == before
    assert spark.read.parquet(str(tmp_path / "ya")).count() == 40


def test_clustered_files_cover_disjoint_ranges(spark, tmp_path):
    path = str(tmp_path / "c")
    # one key holds most rows
    df = spark.range(8_000).select(F.when(F.col("id") % 4 > 0, 5).otherwise(F.col("id")).alias("k"), F.col("id").alias("item"))
    write_clustered(df.repartition(5), path, ["k"], ["item"], partitions=8)
    files = spark.read.parquet(path).withColumn("f", F.input_file_name())
    spans = sorted(tuple(r)[1:] for r in files.groupBy("f").agg(F.min(F.struct("k", "item")), F.max(F.struct("k", "item"))).collect())
    assert len(spans) == 8
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    found = spark.read.parquet(path).filter("k = 5 and item = 1")
    assert found.count() == 1
    assert "EqualTo(k,5)" in found._jdf.queryExecution().executedPlan().toString()


def test_tables(spark, tmp_path):
    try:
        reset(spark, [SONGS, TIME], str(tmp_path))
        create_table(spark, SONGS, str(tmp_path / "songs"))  # a second creation is no error
        df = spark.createDataFrame([("S1", 2000, "t", "A1", 1.0)], "song_id string, year int, title string, artist_id string, duration double")
        insert_into(df, SONGS)
        row = spark.table("songs").first()
        assert (row["song_id"], row["year"], row["duration"]) == ("S1", 2000, 1.0)
        register_views({"some_songs": df})
        assert spark.sql("SELECT count(*) FROM some_songs").first()[0] == 1
    finally:
        drop_table(spark, "songs")
        drop_table(spark, "time")
    assert not spark.catalog.tableExists("songs")


def test_old_versions_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        truncate_insert(spark.range(n + 1), root)
    (tmp_path / "t" / "v2" / "_SUCCESS").unlink()  # a load that broke off
    assert prune_versions(spark, root, keep=2) == [1, 2]
    assert read_current(spark, root).count() == 4 and prune_versions(spark, root, keep=2) == []
    assert prune_versions(spark, str(tmp_path / "nothing")) == []


def test_replace_by_key(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    replace_by_key(rows((1, "a"), (1, "b"), (2, "c")), root, ["k"])
    replace_by_key(rows((3, "d")), root, ["k"])
    for _ in range(2):
        replace_by_key(rows((1, "x"), (4, "y")), root, ["k"])
    assert sorted(map(tuple, read_current(spark, root).collect())) == [(1, "x"), (2, "c"), (3, "d"), (4, "y")]


def test_scratch_is_cleared(spark):
    staged = stage(spark.range(3))
    assert staged.count() == 3 and clear_scratch(spark)
    with pytest.raises(Exception):
        spark.read.parquet(staged.inputFiles()[0])
