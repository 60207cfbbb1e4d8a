from pyspark.sql import functions as F

from starmart.contracts import TableContract, empty_frame, in_order, split_rows, union_frames

ITEMS = TableContract("items", {"item": "int", "length": "double"}, required=["item", "length"])


def test_good_and_rejected(spark, rows):
    raw = [("4", "152.9"), ("x", "1.0"), ("4.7", "1.0"), ("4", ""), (" 5 ", "2"), (None, "1")]
    df = spark.createDataFrame(raw, "item string, length string")
    good, rejects = split_rows(df, ITEMS)
    assert rows(good) == [(4, 152.9), (5, 2.0)]
    reasons = {(r["item"], r["length"]): r["reject_reason"] for r in rejects.collect()}
    assert reasons == {
        ("x", "1.0"): "item: malformed",
        ("4.7", "1.0"): "item: malformed",
        ("4", ""): "length: malformed",
        (None, "1"): "item: null",
    }
    assert good.count() + rejects.count() == df.count()


def test_optional_null_is_good(spark):
    contract = TableContract("t", {"a": "int", "b": "string"})
    good, rejects = split_rows(spark.createDataFrame([(None, None)], "a string, b string"), contract)
    assert (good.count(), rejects.count()) == (1, 0)


def test_missing_required_column_rejects_all(spark):
    good, rejects = split_rows(spark.createDataFrame([("1",)], "item string"), ITEMS)
    assert (good.count(), rejects.count()) == (0, 1)


def test_order_and_union(spark, rows):
    a = spark.createDataFrame([(1.5, 1, "x")], "length double, item int, extra string")
    b = spark.createDataFrame([(2,)], "item int")
    assert rows(union_frames([empty_frame(spark, ITEMS), a, b], ITEMS)) == [(1, 1.5), (2, None)]
    assert in_order(a, ITEMS).schema == ITEMS.schema
    rounded = ITEMS.typed("length", "decimal(18,0)")
    got = in_order(a.withColumn("length", F.lit(152.92036)), rounded).first()
    assert str(got["length"]) == "153"
