"""Aggregates kept up to date equal those of all rows, however the rows are cut into batches."""

import random

import pytest
from pyspark.sql import functions as F

from starmart.operators.aggregates import Measure, add_batch, finished
from starmart.operators.numbering import dense_id
from starmart.sinks import read_current
from starmart.sinks.commits import newest

MEASURES = [Measure("n", "count"), Measure("known", "count", "v"), Measure("total", "sum", "v"), Measure("low", "min", "v"),
            Measure("high", "max", "v"), Measure("mean", "avg", "v")]


@pytest.mark.parametrize("buckets", [None, 4])
@pytest.mark.parametrize("seed", range(2))
def test_batches_add_up(spark, tmp_path, seed, buckets):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", "c", None]), r.choice([1, 2, None]), r.choice([None, *range(9)])) for _ in range(200)]
    root, schema = str(tmp_path / "t"), "g string, h int, v int"
    for lo, hi in ((0, 3), (3, 120), (120, 120), (120, 200)):
        add_batch(spark.createDataFrame(rows[lo:hi], schema), root, ["g", "h"], MEASURES, buckets)
    got = finished(read_current(spark, root), ["g", "h"], MEASURES)
    want = spark.createDataFrame(rows, schema).groupBy("g", "h").agg(
        F.count(F.lit(1)), F.count("v"), F.sum("v"), F.min("v"), F.max("v"), F.avg("v")
    )
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_only_met_buckets_change(spark, tmp_path):
    root = str(tmp_path / "t")
    add_batch(spark.range(100).selectExpr("id AS g", "id AS v"), root, ["g"], MEASURES, 8)
    before = {p.bucket: p.path for p in newest(spark, root).parts}
    add_batch(spark.range(1).selectExpr("5L AS g", "id AS v"), root, ["g"], MEASURES)
    after = {p.bucket: p.path for p in newest(spark, root).parts}
    assert sum(before[b] != after[b] for b in before) == 1


def test_numbers_go_on_without_a_gap(spark):
    first = dense_id(spark.range(50).repartition(5), ["id"], "n", partitions=4)
    second = dense_id(spark.range(100, 130).repartition(3), ["id"], "n", partitions=3, after=50)
    got = [r["n"] for r in first.unionByName(second).orderBy("id").collect()]
    assert got == list(range(1, 81))
