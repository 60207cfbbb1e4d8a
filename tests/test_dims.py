from pyspark.sql import functions as F

from starmart.operators.dims import distinct_rows, first_wins, last_wins, merge_type1, new_rows_only, upsert_type1

USERS = [(1, "Ann", "free", 1), (1, "Anna", "paid", 2), (2, None, "free", 1), (2, "Bob", "free", 3)]
SCHEMA = "user_id int, first_name string, level string, ts int"


def test_policies(spark, rows):
    df = spark.createDataFrame(USERS, SCHEMA).repartition(3)
    assert rows(upsert_type1(df, ["user_id"], ["level"], ["ts"])) == [(1, "Ann", "paid"), (2, None, "free")]
    assert rows(first_wins(df, ["user_id"], ["ts"]).drop("ts")) == [(1, "Ann", "free"), (2, None, "free")]
    assert rows(last_wins(df, ["user_id"], ["ts"]).drop("ts")) == [(1, "Anna", "paid"), (2, "Bob", "free")]
    assert len(rows(distinct_rows(df, ["user_id", "level"]))) == 3


def test_second_run_changes_nothing(spark, rows):
    df = spark.createDataFrame(USERS, SCHEMA)
    once = upsert_type1(df, ["user_id"], ["level"], ["ts"])
    assert rows(merge_type1(once, df, ["user_id"], ["level"], ["ts"])) == rows(once)


def test_merge_keeps_the_stored_names(spark, rows):
    target = spark.createDataFrame([(1, "Old", "free"), (3, None, "paid")], "user_id int, first_name string, level string")
    batch = spark.createDataFrame(USERS, SCHEMA)
    want = [(1, "Old", "paid"), (2, None, "free"), (3, None, "paid")]
    assert rows(merge_type1(target, batch, ["user_id"], ["level"], ["ts"])) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(merge_type1(target, batch, ["user_id"], ["level"], ["ts"])) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ties_are_broken_by_the_other_columns(spark, rows):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 1)], "k int, v string, ts int")
    for n in (1, 2, 5):
        assert rows(first_wins(df.repartition(n), ["k"], ["ts"])) == [(1, "a", 1)]


def test_new_rows_with_null_keys(spark, rows):
    target = spark.createDataFrame([(1,), (None,)], "k int")
    batch = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "k int, v string")
    assert rows(new_rows_only(batch, target, ["k"])) == [(2, "z")]


def test_target_is_not_shuffled_for_a_small_batch(spark, plan, tmp_path):
    spark.range(10_000).select(F.col("id").alias("k"), F.lit("x").alias("level")).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.range(5).select(F.col("id").alias("k"))
    assert "BroadcastHashJoin" in plan(new_rows_only(batch, target, ["k"]))
    assert "SortMergeJoin" not in plan(new_rows_only(batch, target, ["k"]))
