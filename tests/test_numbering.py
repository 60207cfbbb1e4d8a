from pyspark.sql import functions as F

from starmart.operators.numbering import dense_id
from starmart.session import input_bytes, range_partitions


def test_dense_ids_are_one_to_n_in_order(spark):
    df = spark.range(5_000).select((F.col("id") * 7919 % 5_000).alias("a"), F.col("id").alias("b")).repartition(7)
    got = dense_id(df, ["a", "b"], "n", partitions=6).orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 5_001))
    assert [(r["a"], r["b"]) for r in got] == sorted((r["a"], r["b"]) for r in got)


def test_a_value_with_most_rows_is_split(spark):
    df = spark.range(6_000).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("a"), "id")
    numbered = dense_id(df, ["a", "id"], "n", partitions=6)
    assert numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[:] == (1, 6_000, 6_000)


def test_no_rows(spark):
    assert dense_id(spark.range(0), ["id"], "n").count() == 0


def test_no_single_task(spark, plan):
    assert "SinglePartition" not in plan(dense_id(spark.range(100), ["id"], "n"))


def test_partitions_follow_the_input(spark, tmp_path):
    spark.range(100_000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert range_partitions(df) == 4
    n = input_bytes(df)
    assert range_partitions(df, target_bytes=n // 10) in (10, 11)
    assert range_partitions(df.join(df, "id"), target_bytes=n // 10) in (20, 21, 22)
