import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starmart.operators import joins
from starmart.operators.joins import balanced_join, heavy_keys, lookup_first, lookup_join, one_per_key, split_by_keys, two_role_lookup
from starmart.plans.music import songplays_lookup

SONGS = [("S1", "T", "A", 152.92), ("S2", "T", "A", 152.92), ("S3", "T", "A", 153.40)]
PLAYS = [("p1", "T", "A", 152.92), ("p2", "T", "A", 153.10), ("p3", None, "A", 152.92)]


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def frames(spark):
    songs = spark.createDataFrame(SONGS, "song_id string, song string, artist string, length double")
    plays = spark.createDataFrame(PLAYS, "play string, song string, artist string, length double")
    return plays, songs


def by_play(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["play"], set()).add(r["song_id"])
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_song_lookups(spark, broadcast, request):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    plays, songs = frames(spark)
    exact = lookup_first(plays, songs, ["song", "artist", "length"], ["song_id"])
    assert by_play(exact) == {"p1": {"S1"}, "p2": {None}, "p3": {None}}
    assert exact.count() == 3
    by_title = lookup_join(plays, songs.drop("length"), ["song", "artist"], "left")
    every = {"S1", "S2", "S3"}
    assert by_play(by_title) == {"p1": every, "p2": every, "p3": {None}}
    assert by_title.count() == 7
    rounded = [f.withColumn("length", F.col("length").cast("decimal(18,0)")) for f in (plays, songs)]
    assert by_play(lookup_join(*rounded, ["song", "artist", "length"])) == {"p1": every, "p2": every, "p3": {None}}
    matched = lookup_join(plays, songs.drop("length"), ["song", "artist"], "inner")
    assert matched.count() == 6 and set(by_play(matched)) == {"p1", "p2"}


def brute(left, right, how):
    out = Counter()
    for k, v in left:
        matches = [w for j, w in right if k is not None and j == k]
        for w in matches:
            out[(k, v, w)] += 1
        if not matches and how == "left":
            out[(k, v, None)] += 1
    return out


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("seed", range(4))
def test_balanced_join_equals_brute_force(spark, no_broadcast, how, seed):
    rng = random.Random(seed)
    hot_left, hot_right = rng.choice([(1, 1), (1, 2), (1, 99), (99, 2)])

    def side(n, hot):
        rows = [(hot if rng.random() < 0.4 else rng.choice([None, *range(3, 40)]), rng.randrange(3)) for _ in range(n)]
        return rows

    left, right = side(300, hot_left), side(60, hot_right)
    df = balanced_join(
        spark.createDataFrame(left, "k int, v int").repartition(3),
        spark.createDataFrame(right, "k int, w int").repartition(2),
        ["k"], how, partitions=8,
    )
    assert Counter(tuple(r) for r in df.select("k", "v", "w").collect()) == brute(left, right, how)


def test_heavy_keys(spark):
    df = spark.range(9_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"))
    heavy = heavy_keys(df, ["k"], 16)
    assert list(heavy) == [spark.range(1).select(F.xxhash64(F.lit(7).cast("long"))).first()[0]]
    assert max(heavy.values()) >= 8  # half of the rows that have a key


def test_more_than_a_thousand_heavy_keys(spark):
    df = spark.range(120_000).select(F.when(F.col("id") < 108_000, F.col("id") % 1200).otherwise(F.col("id")).alias("k"))
    assert len(heavy_keys(df, ["k"], 4000)) == 1200  # 90 rows each, an average partition has 30


#: Two keys of each type that are close but not equal, and a text that writes the first of them.
KEYS = {
    "timestamp": ("timestamp'2024-01-01 00:00:00.796000'", "timestamp'2024-01-01 00:00:00.796001'"),
    "timestamp_ntz": ("timestamp_ntz'2024-01-01 00:00:00.796000'", "timestamp_ntz'2024-01-01 00:00:00.796001'"),
    "decimal": ("1.10BD", "1.11BD"), "double": ("double('NaN')", "-0.0D"), "float": ("float(0.1)", "float(0.2)"),
    "date": ("date'2024-01-01'", "date'2024-01-02'"), "binary": ("X'00ff'", "X'00fe'"),
    "interval": ("interval '1' day", "interval '1' hour"), "text": ("'a'", "'A'"), "struct": ("struct(0.0D, 'x')", "struct(1.0D, 'x')"),
    "array": ("array(1, null)", "array(1)"),
}


@pytest.mark.parametrize("hot_side", ["left", "right"])
@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("kind", KEYS)
def test_key_types(spark, no_broadcast, kind, how, hot_side):
    hot, near = KEYS[kind]
    many = spark.range(60).selectExpr(f"CASE WHEN id < 50 THEN {hot} WHEN id < 55 THEN {near} END AS k", "id AS v")
    few = spark.sql(f"SELECT {hot} AS k, 1L AS w UNION ALL SELECT {near}, 2L UNION ALL SELECT null, 3L")
    left, right = (many, few) if hot_side == "left" else (few, many)
    got = balanced_join(left, right, ["k"], how, partitions=8).select("v", "w")
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, left.join(right, ["k"], how).select("v", "w").collect()))


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_collated_keys_and_unmatched_neighbours(spark, no_broadcast, hot_side):
    many = spark.range(900).selectExpr("CASE WHEN id % 9 = 0 THEN 'A' ELSE 'a' END COLLATE UTF8_LCASE AS k", "id AS v")
    few = spark.sql("SELECT 'a' COLLATE UTF8_LCASE AS k, 1L AS w UNION ALL SELECT 'b' COLLATE UTF8_LCASE, 2L")
    left, right = (many, few) if hot_side == "left" else (few, many)
    joined = balanced_join(left, right, ["k"], "left", partitions=8)
    assert joined.count() == (900 if hot_side == "left" else 901)


def test_needs_the_shuffle_checksums(spark):
    key = "spark.sql.shuffle.orderIndependentChecksum.enabled"
    spark.conf.set(key, "false")
    try:
        with pytest.raises(ValueError, match="configure"):
            balanced_join(spark.range(1), spark.range(1), ["id"])
    finally:
        spark.conf.set(key, "true")


def test_hot_and_null_keys_spread_over_partitions(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        n = 12_000
        left = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), "id"
        )
        right = spark.range(n).select(F.col("id").alias("k"), F.lit("r").alias("r"))
        joined = balanced_join(left, right, ["k"], "left", partitions=16)
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == n and max(sizes) < 3 * n / 16
        plain = left.join(right, ["k"], "left")
        plain_sizes = [r[0] for r in plain.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert max(plain_sizes) > n / 3
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_double_keys_of_both_zeros(spark, no_broadcast):
    left = spark.createDataFrame([(0.0, 1)] * 20 + [(-0.0, 2)] * 20, "k double, v int")
    right = spark.createDataFrame([(-0.0, 5)] * 10 + [(0.0, 6)] * 10, "k double, w int")
    joined = balanced_join(left, right, ["k"], "left", partitions=4)
    assert joined.count() == 800 and joined.filter("w is null").count() == 0


def test_key_types_must_agree(spark):
    with pytest.raises(TypeError):
        balanced_join(spark.range(1).selectExpr("id as k"), spark.range(1).selectExpr("cast(id as int) as k"), ["k"])


def test_small_lookup_is_broadcast_and_large_one_is_not(spark, plan, tmp_path):
    spark.range(1000).selectExpr("id as k", "id as v").write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    left = spark.range(100_000).selectExpr("id % 1000 as k")
    assert "BroadcastHashJoin" in plan(lookup_join(left, small, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
    try:
        assert "BroadcastHashJoin" not in plan(lookup_join(left, small, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_per_key_takes_the_smallest(spark, rows):
    df = spark.createDataFrame([("T", "S2", "b"), ("T", "S1", "z"), (None, "S0", "a")], "song string, song_id string, x string")
    assert rows(one_per_key(df, ["song"], ["song_id", "x"])) == [("T", "S1", "z")]


def test_two_roles(spark, rows):
    codes = spark.createDataFrame([("1", "ONE"), ("2", "TWO")], "code string, name string")
    df = spark.createDataFrame([(1, "1", "2"), (2, "1", "9"), (3, None, "1")], "id int, a string, b string")
    roles = {"a": "a_name", "b": "b_name"}
    assert rows(two_role_lookup(df, codes, "code", roles, "name")) == [(1, "1", "2", "ONE", "TWO")]
    assert rows(two_role_lookup(df, codes, "code", roles)) == [(1, "1", "2")]


def test_every_play_once(spark):
    plays, songs = frames(spark)
    plays = plays.select("song", "artist", "length", F.lit(1541990258796).alias("ts"), F.lit(1).alias("user_id"),
                         *[F.lit("x").alias(c) for c in ("level", "session_id", "location", "user_agent")])
    records = songs.select("song_id", F.lit("A1").alias("artist_id"), F.col("song").alias("title"), F.col("length").alias("duration"))
    artists = spark.createDataFrame([("A1", "A")], "artist_id string, name string")
    fact = songplays_lookup(plays, records, artists)
    assert fact.count() == 3
    assert sorted(str(r["song_id"]) for r in fact.collect()) == ["None", "None", "S1"]


@pytest.mark.parametrize("bits", [64, 1 << 23])
@pytest.mark.parametrize("seed", range(3))
def test_rows_that_cannot_match_are_added_back(spark, no_broadcast, monkeypatch, bits, seed, plan):
    rng = random.Random(seed)
    left = [(rng.choice([None, *range(40)]), rng.choice([None, "a", "b"]), i) for i in range(400)]
    right = [(rng.choice([None, *range(30, 60)]), rng.choice([None, "a", "c"]), i) for i in range(80)]
    monkeypatch.setattr(joins.split_by_keys, "__defaults__", (bits,))
    a = spark.createDataFrame(left, "k int, t string, v int").repartition(3)
    b = spark.createDataFrame(right, "k int, t string, w int")
    df = lookup_join(a, b, ["k", "t"], "left", skip_unmatched=True)
    got = Counter(map(tuple, df.select("k", "t", "v", "w").collect()))
    assert got == Counter(map(tuple, a.join(b, ["k", "t"], "left").select("k", "t", "v", "w").collect()))
    may, cannot = split_by_keys(a, b, ["k", "t"], bits)
    keys = {(k, t) for k, t, _ in right if k is not None and t is not None}
    met = {tuple(r)[:2] for r in may.collect()}
    assert may.count() + cannot.count() == 400 and not {tuple(r)[:2] for r in cannot.collect()} & keys
    if bits > 64:
        assert met <= keys and "Subquery" in plan(may) and "Exchange" in plan(df)


def jobs_before_the_action(spark, build):
    spark.sparkContext.setJobGroup("built", "jobs of building a frame")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("built"))
    finally:
        spark.sparkContext.setJobGroup("other", "")


def test_frames_are_built_with_one_job_a_source(spark, no_broadcast, tmp_path):
    for name in ("plays", "songs"):
        spark.range(3000).selectExpr("id % 7 AS k", "id AS v").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("plays", "songs"))
    unique = b.groupBy("k").agg(F.min("v").alias("w"))
    assert jobs_before_the_action(spark, lambda: balanced_join(a, unique, ["k"], right_unique=True)) == 0
    joins._sketched.clear()
    balanced_join(a, b.withColumnRenamed("v", "w"), ["k"])  # sketches either side, and stages the pieces
    kept = dict(joins._sketched)
    assert len(kept) == 2
    balanced_join(a, b.withColumnRenamed("v", "x"), ["k"])  # the same keys of the same sources
    assert joins._sketched == kept


def test_hot_left_key_of_a_unique_lookup_is_split_by_the_planner(spark, no_broadcast):
    from conftest import plan_of

    sizes = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10kb", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(60_000).repartition(6).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).alias("k"), "id")
        df = balanced_join(left, spark.range(500).select(F.col("id").alias("k"), F.col("id").alias("w")), ["k"], right_unique=True)
        assert df.count() == 60_000
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for k in sizes:
            spark.conf.unset(k)
