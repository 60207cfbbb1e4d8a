import pytest
from pyspark.sql import functions as F

from starmart.operators.checks import (
    DEFAULT_CHECKS,
    QualityError,
    SqlCheck,
    TableCheck,
    enforce,
    enforce_observed,
    observed,
    require_not_null,
    run_checks,
    run_sql_checks,
)


def tables(spark):
    return {
        "songs": spark.createDataFrame([("t",)], "title string"),
        "users": spark.createDataFrame([("l",)], "last_name string"),
        "artists": spark.createDataFrame([("n",)], "name string"),
        "songplays": spark.createDataFrame([(1,)], "user_id int"),
    }


def test_default_checks(spark):
    assert [(c.table, c.not_null) for c in DEFAULT_CHECKS] == [
        ("songs", ["title"]), ("users", ["last_name"]), ("artists", ["name"]), ("songplays", ["user_id"]),
    ]
    report = run_checks(tables(spark))
    assert report.count() == 8
    enforce(report)


def test_empty_null_and_duplicate_fail(spark):
    t = tables(spark)
    t["songs"] = t["songs"].filter("false")
    with pytest.raises(QualityError, match="songs: rows = 0"):
        enforce(run_checks(t))
    t = tables(spark)
    t["users"] = spark.createDataFrame([("a",), (None,)], "last_name string")
    with pytest.raises(QualityError, match="users: null last_name = 1"):
        enforce(run_checks(t))
    twice = {"songs": spark.createDataFrame([("t",), ("t",)], "title string")}
    with pytest.raises(QualityError, match="duplicate title = 1"):
        enforce(run_checks(twice, [TableCheck("songs", key=["title"])]))


def test_one_scan_per_table(spark, plan, tmp_path):
    spark.range(10).selectExpr("id as a", "id as b").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert plan(run_checks({"t": df}, [TableCheck("t", ["a", "b"])])).count("FileScan") == 1


def test_observed_write(spark):
    check = TableCheck("users", ["a"])
    df, seen = observed(spark.createDataFrame([(1,), (None,)], "a int"), check)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 2, "null a": 1}
    with pytest.raises(QualityError, match="null a = 1"):
        enforce_observed(seen, check)


def test_sql_checks(spark):
    report = run_sql_checks(spark, [SqlCheck("two", "SELECT 1 + 1", 2), SqlCheck("none", "SELECT max(id) FROM range(0)", None)])
    assert [r["passed"] for r in report.collect()] == [True, True]


def test_not_null_modes(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "k int, v string")
    good, rejects = require_not_null(df, ["k", "v"])
    assert (good.count(), rejects.count()) == (1, 2)
    assert require_not_null(df.filter(F.col("v").isNotNull() & F.col("k").isNotNull()), ["k"], "fail").count() == 1
    with pytest.raises(Exception, match="null in a required column: k, v"):
        require_not_null(df, ["k", "v"], "fail").collect()
