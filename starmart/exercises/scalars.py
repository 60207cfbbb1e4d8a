"""Filters, projections, calendar and text functions, keys, casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.contracts import TableContract, empty_frame, in_order, split_rows, union_frames
from starmart.exercises.registry import exercise, table
from starmart.functions import (
    blank_to_null,
    calendar,
    clean_strings,
    md5_of,
    millis_to_timestamp,
    remove_chars,
    sas_days_to_date,
    seconds_timestamp,
    sequence_id,
    split_once,
    strip,
    truncate_to,
    upper_name,
    wide_key,
)
from starmart.operators.filters import nonempty, plays_of, present, since_year, whole_number_is
from starmart.operators.numbering import dense_id
from starmart.session import stage
from starmart.sources import preview


def _ms(column: str = "ts") -> Column:
    return F.unix_millis(F.col(column).cast("timestamp"))


# -- projections and filters --------------------------------------------------


@exercise(
    "play_filter",
    "SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'purchase'",
)
def play_filter(spark, sf):
    return plays_of(table(spark, sf, "events"), "purchase", "event_type").select("event_id", "user_id", "ts", "value")


@exercise(
    "rename_and_compute",
    """SELECT e.event_id, e.event_type AS page, epoch_us(e.ts) // 1000 AS ts_ms,
              date_trunc('second', e.ts) AS start_time, e.user_id
       FROM (SELECT *, 1 AS one FROM events) e WHERE e.one = 1""",
)
def rename_and_compute(spark, sf):
    derived = table(spark, sf, "events").select(_ms().alias("ts_ms"), "*")
    timed = derived.withColumns({"start_time": seconds_timestamp("ts_ms")})
    return timed.withColumnsRenamed({"event_type": "page"}).select("event_id", "page", "ts_ms", "start_time", "user_id")


@exercise(
    "nonempty_field",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS artist FROM events
       WHERE event_id % 4 <> 0 AND event_id % 7 <> 0""",
)
def nonempty_field(spark, sf):
    e = table(spark, sf, "events")
    artist = F.when(F.col("event_id") % 7 != 0, F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("event_type")))
    return nonempty(e.select("event_id", artist.alias("artist")), "artist")


@exercise(
    "not_null_gate",
    """SELECT doc_id, quality, toxic FROM
       (SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN quality END AS quality,
               CASE WHEN doc_id % 5 <> 0 THEN toxic END AS toxic FROM labels)
       WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
)
def not_null_gate(spark, sf):
    rows = table(spark, sf, "labels").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 != 0, F.col("quality")).alias("quality"),
        F.when(F.col("doc_id") % 5 != 0, F.col("toxic")).alias("toxic"),
    )
    return present(rows, ["quality", "toxic"])


@exercise(
    "whole_number_filter",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_linenumber FROM lineitem
       WHERE trunc(l_quantity) = 2 AND l_linenumber = 1""",
)
def whole_number_filter(spark, sf):
    rows = table(spark, sf, "lineitem").filter(whole_number_is("l_quantity", 2) & (F.col("l_linenumber") == 1))
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_linenumber")


@exercise(
    "since_year_filter",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders WHERE year(o_orderdate) >= 1998",
)
def since_year_filter(spark, sf):
    rows = table(spark, sf, "orders").filter(since_year("o_orderdate", 1998))
    return rows.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))


@exercise("preview_rows", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def preview_rows(spark, sf):
    return preview(table(spark, sf, "orders"), 5, [F.desc("o_totalprice"), F.col("o_orderkey")])


@exercise("row_count", "SELECT count(*) AS n_rows FROM lineitem")
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@exercise(
    "json_field_access",
    "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events",
)
def json_field_access(spark, sf):
    parsed = F.from_json("props", "k int")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


# -- calendar -----------------------------------------------------------------


@exercise(
    "epoch_timestamps",
    """SELECT event_id, date_trunc('millisecond', ts) AS ts_millis, date_trunc('second', ts) AS ts_seconds
       FROM events""",
)
def epoch_timestamps(spark, sf):
    ms = table(spark, sf, "events").select("event_id", _ms().alias("ms"))
    return ms.select(
        "event_id", millis_to_timestamp("ms").alias("ts_millis"), seconds_timestamp("ms").alias("ts_seconds")
    )


def _time_sql(unit: str, weekday: str) -> str:
    return f"""SELECT DISTINCT start_time, CAST(hour(start_time) AS INTEGER) AS hour,
        CAST(day(start_time) AS INTEGER) AS day, CAST(week(start_time) AS INTEGER) AS week,
        CAST(month(start_time) AS INTEGER) AS month, CAST(year(start_time) AS INTEGER) AS year,
        CAST({weekday} AS INTEGER) AS weekday
      FROM (SELECT date_trunc('{unit}', ts) AS start_time FROM events)"""


@exercise("time_dim_monday0", _time_sql("millisecond", "isodow(start_time) - 1"))
def time_dim_monday0(spark, sf):
    times = table(spark, sf, "events").select(millis_to_timestamp(_ms()).alias("start_time")).distinct()
    return times.select("start_time", *calendar("start_time", week_start="monday"))


@exercise("time_dim_sunday0", _time_sql("second", "dayofweek(start_time)"))
def time_dim_sunday0(spark, sf):
    times = table(spark, sf, "events").select(seconds_timestamp(_ms()).alias("start_time")).distinct()
    return times.select("start_time", *calendar("start_time", week_start="sunday"))


@exercise(
    "sas_day_to_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL
              WHEN o_orderkey % 10 = 1 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS arrival_date
       FROM orders""",
)
def sas_day_to_date(spark, sf):
    o = table(spark, sf, "orders")
    days = F.date_diff(F.to_date("o_orderdate"), F.lit("1960-01-01").cast("date")).cast("double")
    kind = F.col("o_orderkey") % 10
    # a fraction is cut; null, NaN and days beyond the calendar give null
    days = F.when(kind == 0, F.when(F.col("o_orderkey") % 20 == 0, F.lit(float("nan")))).when(kind == 1, F.lit(1e7)).otherwise(days + 0.6)
    return o.select("o_orderkey", sas_days_to_date(days).alias("arrival_date"))


# -- text ---------------------------------------------------------------------


def _blanked() -> Column:
    kind = F.col("doc_id") % 5
    return F.when(kind == 0, "").when(kind == 1, " \t ").otherwise(F.col("text"))


@exercise(
    "blank_to_null",
    """SELECT doc_id, md5(CASE WHEN doc_id % 5 > 1 THEN text END) AS text_md5,
              CASE WHEN doc_id % 3 > 0 THEN lang END AS lang, source FROM documents""",
)
def blank_to_null_query(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", _blanked().alias("text"), F.when(F.col("doc_id") % 3 == 0, "  ").otherwise(F.col("lang")).alias("lang"), "source"
    )
    return clean_strings(d).select("doc_id", F.md5("text").alias("text_md5"), "lang", "source")


@exercise(
    "truncate_width",
    """SELECT doc_id, md5(substr(text, 1, 256)) AS text_md5, length(substr(text, 1, 256)) AS n_kept, n_chars
       FROM documents""",
)
def truncate_width(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", truncate_to("text", 256).alias("text"), "n_chars")
    return d.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_kept"), "n_chars")


@exercise(
    "upper_strip_split",
    """SELECT p_partkey, upper(p_name) AS upper_name, split_part(p_name, ' ', 1) AS head,
              CASE WHEN instr(p_name, ' ') > 0 THEN substr(p_name, instr(p_name, ' ') + 1) END AS tail,
              replace(p_brand, '#', '') AS brand, split_part(p_name, ' ', 2) AS stripped
       FROM part""",
)
def upper_strip_split(spark, sf):
    head, tail = split_once("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey",
        upper_name("p_name").alias("upper_name"),
        head.alias("head"),
        tail.alias("tail"),
        remove_chars("p_brand", "#").alias("brand"),
        strip(F.concat(F.lit(" \t "), tail, F.lit("\r\n "))).alias("stripped"),
    )


@exercise(
    "blank_flag_counts",
    "SELECT lang, count(*) AS n_docs, count(CASE WHEN doc_id % 5 > 1 THEN 1 END) AS n_text FROM documents GROUP BY lang",
)
def blank_flag_counts(spark, sf):
    d = table(spark, sf, "documents").select("lang", blank_to_null(_blanked()).alias("text"))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.count("text").alias("n_text"))


# -- keys ---------------------------------------------------------------------


@exercise(
    "md5_key",
    """SELECT event_id, md5(CAST(user_id AS VARCHAR) || strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S'))
              AS songplay_id FROM events""",
)
def md5_key(spark, sf):
    second = F.date_format(F.date_trunc("second", F.col("ts")), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select("event_id", md5_of("user_id", second).alias("songplay_id"))


@exercise(
    "wide_md5_key",
    """SELECT event_id, md5(concat('=' || CAST(user_id AS VARCHAR), chr(31),
              coalesce('=' || CASE WHEN event_id % 2 = 0 THEN event_type END, '-'))) AS play_key FROM events""",
)
def wide_md5_key(spark, sf):
    kind = F.when(F.col("event_id") % 2 == 0, F.col("event_type"))
    return table(spark, sf, "events").select("event_id", wide_key("user_id", kind).alias("play_key"))


@exercise(
    "sequence_key",
    """SELECT count(*) AS n_rows, count(*) AS n_ids, true AS above_mark FROM orders""",
)
def sequence_key(spark, sf):
    numbered = stage(table(spark, sf, "orders").select(sequence_id(1_000).alias("id"), "o_orderkey"), "sequence")
    return numbered.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        (F.min("id") > 1_000).alias("above_mark"),
    )


@exercise(
    "dense_id",
    "SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS songplay_id FROM events",
)
def dense_id_query(spark, sf):
    return dense_id(table(spark, sf, "events").select("event_id", "ts"), ["ts", "event_id"], "songplay_id")


@exercise(
    "dense_id_hot_value",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, count(*) AS n_rows,
              CAST(sum(id) AS BIGINT) AS id_sum
       FROM (SELECT *, row_number() OVER (ORDER BY l_quantity <= 20, l_orderkey, l_partkey, l_suppkey, l_linenumber,
                                                   l_quantity, l_extendedprice) AS id FROM lineitem)
       GROUP BY ALL""",
)
def dense_id_hot_value(spark, sf):
    """The first order column has two values, so each holds a large share of the rows."""
    l = table(spark, sf, "lineitem").select(
        (F.col("l_quantity") <= 20).alias("small"),
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    )
    numbered = dense_id(l, l.columns, "id")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    return numbered.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("id").alias("id_sum"))


# -- casts, contracts, unions -------------------------------------------------

_READINGS = TableContract(
    "readings", {"event_id": "bigint", "k": "int", "amount": "double"}, required=["event_id", "k"]
)


def _readings(spark, sf) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    k = F.when(F.col("event_id") % 7 == 0, F.col("event_type")).when(F.col("event_id") % 11 != 0, k)
    amount = F.when(F.col("event_id") % 13 == 0, "").otherwise(F.col("user_id").cast("string"))
    return e.select("event_id", k.alias("k"), amount.alias("amount"))


_READINGS_SQL = """WITH raw AS (
  SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_type
                        WHEN event_id % 11 <> 0 THEN regexp_extract(props, '[0-9]+') END AS k,
         CASE WHEN event_id % 13 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS amount
  FROM events
)"""


@exercise(
    "cast_good",
    f"""{_READINGS_SQL} SELECT event_id, CAST(k AS INTEGER) AS k, CAST(amount AS DOUBLE) AS amount FROM raw
        WHERE TRY_CAST(k AS INTEGER) IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NOT NULL""",
)
def cast_good(spark, sf):
    return split_rows(_readings(spark, sf), _READINGS)[0]


@exercise(
    "cast_rejects",
    f"""{_READINGS_SQL} SELECT event_id, k, amount, concat_ws('; ',
          CASE WHEN k IS NOT NULL AND TRY_CAST(k AS INTEGER) IS NULL THEN 'k: malformed' END,
          CASE WHEN k IS NULL THEN 'k: null' END,
          CASE WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'amount: malformed' END) AS reject_reason FROM raw
        WHERE TRY_CAST(k AS INTEGER) IS NULL OR TRY_CAST(amount AS DOUBLE) IS NULL""",
)
def cast_rejects(spark, sf):
    return split_rows(_readings(spark, sf), _READINGS)[1]


_ACCOUNTS = TableContract(
    "accounts", {"id": "bigint", "name": "string", "nation": "int", "segment": "string", "balance": "decimal(18,0)"}
)


@exercise(
    "contract_order",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
              CAST(CAST(c_acctbal AS DECIMAL(18,0)) AS BIGINT) AS balance FROM customer""",
)
def contract_order(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.lit("extra").alias("extra"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_custkey").alias("id"),
    )
    return in_order(c, _ACCOUNTS).withColumn("balance", F.col("balance").cast("long"))


@exercise(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
              CAST(CAST(c_acctbal AS DECIMAL(18,0)) AS BIGINT) AS balance FROM customer
       UNION ALL
       SELECT s_suppkey, s_name, s_nationkey, NULL, CAST(CAST(s_acctbal AS DECIMAL(18,0)) AS BIGINT) FROM supplier""",
)
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").withColumnsRenamed(
        {"c_custkey": "id", "c_name": "name", "c_nationkey": "nation", "c_mktsegment": "segment", "c_acctbal": "balance"}
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
    )
    merged = union_frames([empty_frame(spark, _ACCOUNTS), c, s], _ACCOUNTS)
    return merged.withColumn("balance", F.col("balance").cast("long"))
