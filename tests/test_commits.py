"""Commit records: broken loads, conflicts, partial rewrites, runs kept apart, partitions and buckets that are read."""

import os

import pytest
from pyspark.sql import functions as F

from starmart.sinks import append, append_new, read_current, truncate_insert, upsert, write_last_wins, write_parquet
from starmart.sinks import loads
from starmart.sinks.commits import LoadConflict, bucket_of, newest, publish
from starmart.sinks.loads import ledger, prune_versions, replace_by_key, replace_run


def files_of(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "k long, v string, ts int")


def test_broken_append_is_not_seen(spark, tmp_path, monkeypatch, rows):
    root = str(tmp_path / "t")
    append(spark.range(3), root)
    with monkeypatch.context() as m:
        m.setattr(loads, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            append(spark.range(3, 5), root)
    assert read_current(spark, root).count() == 3 and (tmp_path / "t" / "v2" / "_SUCCESS").exists()
    append(spark.range(10, 11), root)
    assert rows(read_current(spark, root)) == [(0,), (1,), (10,), (2,)]
    append(spark.range(11, 12), root)
    assert prune_versions(spark, root, keep=1) == [2] and read_current(spark, root).count() == 5


def test_two_loads_at_once(spark, tmp_path):
    root = str(tmp_path / "t")
    append(spark.range(3), root)
    commit = newest(spark, root)
    with pytest.raises(LoadConflict):
        publish(spark, root, commit)
    assert newest(spark, root) == commit and not list((tmp_path / "t" / "_commits").glob(".[0-9a-f]*[!c]"))


@pytest.mark.parametrize("policy", ["upsert", "last wins", "replace"])
def test_only_met_buckets_are_rewritten(spark, tmp_path, policy):
    root = str(tmp_path / "t")
    first = spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("ts"))
    load = {
        "upsert": lambda df: upsert(df, root, ["k"], ["v"], ["ts"], buckets=8),
        "last wins": lambda df: write_last_wins(df, root, ["k"], ["ts"], ["k", "v"], buckets=8),
        "replace": lambda df: replace_by_key(df.drop("ts"), root, ["k"], buckets=8),
    }[policy]
    load(first)
    before, parts = files_of(root), newest(spark, root).parts
    assert {p.bucket for p in parts} == set(range(8))
    # keys as another type, one of them new in a bucket of its own
    load(spark.createDataFrame([(5, "new", 2), (5000, "new", 2)], "k int, v string, ts int"))
    met = {r[0] for r in spark.createDataFrame([(5,), (5000,)], "k long").select(bucket_of(["k"], 8)).collect()}
    after = newest(spark, root).parts
    assert {p for p in after if p.bucket not in met} == {p for p in parts if p.bucket not in met}
    assert all(files_of(root)[f] == t for f, t in before.items())
    got = {r["k"]: r["v"] for r in read_current(spark, root).collect()}
    assert len(got) == 401 and got[5] == got[5000] == "new" and got[6] == "old"
    written = {f for f in files_of(root) if f not in before}
    assert {int(f.split("load_bucket=")[1].split("/")[0]) for f in written} == met
    load(spark.createDataFrame([], "k long, v string, ts int"))  # an empty batch
    assert newest(spark, root).parts == after


def test_appended_rows_of_buckets_are_rewritten_too(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    upsert(keyed(spark, (1, "a", 1), (2, "b", 1), (None, "n", 1)), root, ["k"], ["v"], ["ts"], buckets=3)
    append_new(keyed(spark, (2, "x", 1), (3, "c", 1)).drop("ts"), root, ["k"])
    upsert(keyed(spark, (3, "d", 2), (None, "m", 2)), root, ["k"], ["v"], ["ts"])
    assert rows(read_current(spark, root)) == [(None, "m"), (1, "a"), (2, "b"), (3, "d")]
    with pytest.raises(ValueError, match="needs a key"):
        truncate_insert(spark.range(2), str(tmp_path / "u"), buckets=2)


def test_runs_are_replaced_alone(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    for run, n in (("day=1", 3), ("day=2", 2), ("day=3", 1)):
        replace_run(spark.range(n).withColumn("run", F.lit(run)), root, run)
    before = files_of(root)
    replace_run(spark.range(5).withColumn("run", F.lit("day=2")), root, "day=2")
    assert rows(read_current(spark, root).groupBy("run").count()) == [("day=1", 3), ("day=2", 5), ("day=3", 1)]
    assert all(files_of(root)[f] == t for f, t in before.items())
    found = ledger(spark, root).collect()
    assert {(r["run"], r["load"]) for r in found} == {("day=1", 1), ("day=3", 3), ("day=2", 4)} and all(r["written"] for r in found)
    replace_run(spark.range(0).withColumn("run", F.lit("day=1")), root, "day=1")  # a run without rows any more
    assert read_current(spark, root).count() == 6
    prune_versions(spark, root, keep=1)
    assert read_current(spark, root).count() == 6 and ledger(spark, str(tmp_path / "none")).count() == 0


def test_append_new_reads_only_touched_partitions(spark, tmp_path, plan, rows):
    root = str(tmp_path / "t")
    df = spark.range(1200).select("id", (F.col("id") % 12).cast("int").alias("month"))
    append_new(df.filter("id < 600"), root, ["id", "month"], partition_by=["month"])
    append_new(df.filter("month < 3"), root, ["id", "month"])
    append_new(df.filter("month < 3"), root, ["id", "month"])
    assert read_current(spark, root).count() == 600 + 150 and len(newest(spark, root).parts) == 3
    batch = df.filter("month in (1, 7)")
    seen = loads._comparable(spark, root, newest(spark, root), batch, ["id", "month"])
    text = plan(seen)
    assert "PartitionFilters: [((month" in text and "7)" in text
    assert {r[0] for r in seen.select("month").distinct().collect()} == {1, 7}
    for _ in range(20):  # many small appends are gathered in one
        append(df.filter("id = 3"), root)
    assert len(newest(spark, root).parts) <= loads.MOST_PARTITIONED_PARTS and read_current(spark, root).count() == 770


def test_failed_overwrite_leaves_the_last_table(spark, tmp_path):
    path = tmp_path / "p"
    write_parquet(spark.range(4), str(path))
    broken = spark.range(4).withColumn("x", F.when(F.col("id") > 2, F.raise_error(F.lit("no"))).otherwise(F.lit("a")))
    with pytest.raises(Exception, match="no"):
        write_parquet(broken, str(path))
    assert spark.read.parquet(str(path)).count() == 4 and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["p"]
    write_parquet(spark.read.parquet(str(path)).filter("id > 1"), str(path))  # reads what it replaces
    assert spark.read.parquet(str(path)).count() == 2


def test_tables_without_rows_keep_their_columns(spark, tmp_path):
    root = str(tmp_path / "t")
    truncate_insert(spark.range(0).withColumn("year", F.lit(1)), root, ["year"])
    assert read_current(spark, root).columns == ["id", "year"] and read_current(spark, root).count() == 0
    truncate_insert(spark.range(0), root, buckets=4, key=["id"])
    assert read_current(spark, root).columns == ["id"]


def scanned_rows(df):
    """Rows that the file scan of a plan gave out, from its metric."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    plan = leaves.apply(0)
    plan = plan.executedPlan().collectLeaves().apply(0) if plan.getClass().getSimpleName().startswith("Adaptive") else plan
    return plan.metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups_by_bloom_filter(spark, tmp_path):
    df = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("key"), "id").repartition(8)
    paths = {bloom: str(tmp_path / f"t{bloom}") for bloom in (False, True)}
    for bloom, path in paths.items():
        write_parquet(df, path, bloom=["key"] if bloom else None)
    keys = [df.first()["key"], "7" * 32]  # one that is there and one that is not, both inside every file's range
    found = {b: [scanned_rows(spark.read.parquet(p).filter(F.col("key") == k)) for k in keys] for b, p in paths.items()}
    assert found[False] == [40_000, 40_000]
    assert found[True][0] <= 10_000 and found[True][1] == 0
    assert spark.read.parquet(paths[True]).filter(F.col("key") == keys[0]).count() == 1
