import datetime as dt
import hashlib

from pyspark.sql import functions as F

from starmart.functions import (
    blank_to_null,
    calendar,
    clean_strings,
    md5_of,
    millis_to_timestamp,
    sas_days_to_date,
    seconds_timestamp,
    split_once,
    strip,
    wide_key,
)


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_calendar_of_an_epoch(spark):
    ts = F.lit(1541990258796)
    assert one(spark, millis_to_timestamp(ts)) == (dt.datetime(2018, 11, 12, 2, 37, 38, 796000),)
    assert one(spark, seconds_timestamp(ts)) == (dt.datetime(2018, 11, 12, 2, 37, 38),)
    t = millis_to_timestamp(ts)
    assert one(spark, *calendar(t)) == (2, 12, 46, 11, 2018, 0)
    assert one(spark, *calendar(t, week_start="sunday"))[-1] == 1


def test_iso_week_crosses_the_year(spark):
    day = F.lit("2018-12-31").cast("date")
    assert one(spark, *calendar(day, ["week", "year"])) == (1, 2018)


def test_seconds_before_1970_cut_towards_zero(spark):
    assert one(spark, seconds_timestamp(F.lit(-1500))) == (dt.datetime(1969, 12, 31, 23, 59, 59),)


def test_sas_days(spark, rows):
    df = spark.createDataFrame([(20573.0,), (None,), (float("nan"),), (1e12,), (0.9,), (-1.0,), (3e6,)], "d double")
    got = [r[0] for r in df.select(sas_days_to_date("d")).collect()]
    day0 = dt.date(1960, 1, 1)
    assert got == [dt.date(2016, 4, 29), None, None, None, day0, dt.date(1959, 12, 31), None]


def test_blank_and_width(spark):
    df = spark.createDataFrame([("", "x" * 300), ("  ", " "), (" a ", "b"), ("\t\n\xa0", None)], "a string, b string")
    got = [tuple(r) for r in clean_strings(df, {"b": 256}).collect()]
    assert got == [(None, "x" * 256), (None, None), (" a ", "b"), (None, None)]
    assert one(spark, blank_to_null(F.lit(" a ")), strip(F.lit("　a\r\n"))) == (" a ", "a")


def test_split_once(spark):
    assert one(spark, *split_once(F.lit("A, B, C"), ",")) == ("A", " B, C")
    assert one(spark, *split_once(F.lit("A"), ",")) == ("A", None)


def test_keys(spark):
    want = hashlib.md5(b"3382018-11-12 02:37:01").hexdigest()
    assert want == "11d820877c53ce6015325fd577676329"
    assert one(spark, md5_of(F.lit(338), F.lit("2018-11-12 02:37:01"))) == (want,)
    assert one(spark, md5_of(F.lit(338), F.lit(None))) == (None,)
    a, b = one(spark, wide_key(F.lit("a"), F.lit(None)), wide_key(F.lit(None), F.lit("a")))
    assert a != b
