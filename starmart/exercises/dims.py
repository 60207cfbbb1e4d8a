"""Distinct, first-wins, upsert, keyed-write and append policies; grouped counts and means."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.exercises.registry import exercise, table
from starmart.functions import calendar
from starmart.operators.checks import SqlCheck, TableCheck, duplicate_keys, require_not_null, run_checks, run_sql_checks
from starmart.operators.dims import distinct_rows, first_wins, last_wins, merge_type1, new_rows_only, upsert_type1
from starmart.operators.filters import since_year
from starmart.operators.joins import lookup_join
from starmart.plans.music import time_of_fact


@exercise("dim_distinct", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def dim_distinct(spark, sf):
    return distinct_rows(table(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"])


@exercise(
    "dim_first_wins",
    """SELECT p_name, p_partkey, p_brand, p_type, p_size FROM
       (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def dim_first_wins(spark, sf):
    p = table(spark, sf, "part").select("p_name", "p_partkey", "p_brand", "p_type", "p_size")
    return first_wins(p, ["p_name"], ["p_partkey"])


_USERS_SQL = """SELECT o_custkey, first_status, first_price, last_priority FROM (
  SELECT o_custkey,
         first_value(o_orderstatus) OVER f AS first_status, first_value(o_totalprice) OVER f AS first_price,
         first_value(o_orderpriority) OVER l AS last_priority, row_number() OVER f AS rn
  FROM {source}
  WINDOW f AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey),
         l AS (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC)
) WHERE rn = 1"""
_USER_NAMES = {"o_orderstatus": "first_status", "o_totalprice": "first_price", "o_orderpriority": "last_priority"}


def _user_orders(spark, sf):
    o = table(spark, sf, "orders").withColumnsRenamed(_USER_NAMES)
    return o.select("o_custkey", *_USER_NAMES.values(), "o_orderdate", "o_orderkey")


@exercise("dim_scd1_upsert", _USERS_SQL.format(source="orders"))
def dim_scd1_upsert(spark, sf):
    return upsert_type1(_user_orders(spark, sf), ["o_custkey"], ["last_priority"], ["o_orderdate", "o_orderkey"])


@exercise(
    "dim_scd1_merge",
    f"""WITH old AS ({_USERS_SQL.format(source="(SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')")}),
        new AS ({_USERS_SQL.format(source="(SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')")})
        SELECT coalesce(old.o_custkey, new.o_custkey) AS o_custkey,
               CASE WHEN old.o_custkey IS NULL THEN new.first_status ELSE old.first_status END AS first_status,
               CASE WHEN old.o_custkey IS NULL THEN new.first_price ELSE old.first_price END AS first_price,
               CASE WHEN new.o_custkey IS NULL THEN old.last_priority ELSE new.last_priority END AS last_priority
        FROM old FULL JOIN new ON old.o_custkey = new.o_custkey""",
)
def dim_scd1_merge(spark, sf):
    rows, order = _user_orders(spark, sf), ["o_orderdate", "o_orderkey"]
    late = since_year("o_orderdate", 1998)
    target = upsert_type1(rows.filter(~late), ["o_custkey"], ["last_priority"], order)
    return merge_type1(target, rows.filter(late), ["o_custkey"], ["last_priority"], order)


@exercise(
    "keyed_last_write",
    """SELECT user_id, event_type, event_id, ts, value FROM
       (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1""",
)
def keyed_last_write(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return last_wins(e, ["user_id", "event_type"], ["ts", "event_id"])


@exercise("append_new_only", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def append_new_only(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    target = o.filter(~since_year("o_orderdate", 1998))
    batch = o.filter(since_year("o_orderdate", 1997))  # overlaps the target by a year
    return target.unionByName(new_rows_only(batch, target, ["o_orderkey"]))


# -- grouped ------------------------------------------------------------------

_TEN_KEYS = ["l_returnflag", "l_linestatus", "l_shipyear", "big", "odd_line", "o_orderstatus", "o_orderpriority",
             "first_half", "c_mktsegment", "west"]


@exercise(
    "count_by_10",
    f"""SELECT {', '.join(_TEN_KEYS)}, count(*) AS "count" FROM
        (SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS l_shipyear,
                CASE WHEN l_quantity > 10 THEN l_quantity > 40 END AS big, l_linenumber % 2 = 1 AS odd_line, o_orderstatus,
                o_orderpriority, month(o_orderdate) <= 6 AS first_half, c_mktsegment, c_nationkey < 13 AS west
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)
        GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""",
)
def count_by_10(spark, sf):
    l = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_linestatus",
        F.year("l_shipdate").alias("l_shipyear"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity") > 40).alias("big"),
        (F.col("l_linenumber") % 2 == 1).alias("odd_line"),
    )
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", (F.month("o_orderdate") <= 6).alias("first_half")
    )
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", (F.col("c_nationkey") < 13).alias("west")
    )
    rows = lookup_join(l, o, ["o_orderkey"], "inner", right_unique=True)
    rows = lookup_join(rows, c, ["o_custkey"], "inner", right_unique=True, heavy_from=o)
    return rows.groupBy(*_TEN_KEYS).agg(F.count(F.lit(1)).alias("count"))


@exercise(
    "date_dim_grouped",
    """SELECT CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day
       FROM orders GROUP BY 1, 2, 3, 4 ORDER BY date DESC""",
)
def date_dim_grouped(spark, sf):
    dates = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return dates.select("date", *calendar("date", ["year", "month", "day"])).orderBy(F.desc("date"))


@exercise(
    "time_dim_from_fact",
    """SELECT DISTINCT o_orderdate AS start_time, CAST(hour(o_orderdate) AS INTEGER) AS hour,
              CAST(day(o_orderdate) AS INTEGER) AS day, CAST(week(o_orderdate) AS INTEGER) AS week,
              CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday FROM orders""",
)
def time_dim_from_fact(spark, sf):
    return time_of_fact(table(spark, sf, "orders").select(F.col("o_orderdate").alias("start_time")), "sunday")


@exercise(
    "avg_by_group_since",
    """SELECT n_name AS country, date, avg(floor(o_totalprice)) AS average_price FROM
         (SELECT n_name, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders
          JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
       WHERE year(date) >= 1999 GROUP BY 1, 2 ORDER BY date DESC, country""",
)
def avg_by_group_since(spark, sf):
    o = table(spark, sf, "orders").filter(since_year("o_orderdate", 1999))
    o = o.select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("date"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    rows = lookup_join(o, c, ["o_custkey"], "inner", right_unique=True)
    rows = lookup_join(rows, n, ["n_nationkey"], "inner", right_unique=True, heavy_from=c)
    means = rows.groupBy("country", "date").agg(F.avg(F.floor("o_totalprice")).alias("average_price"))
    return means.orderBy(F.desc("date"), "country")


@exercise(
    "sums_by_group",
    """SELECT s_nationkey, CAST(count(*) AS BIGINT) AS n_suppliers, CAST(sum(s_suppkey) AS BIGINT) AS key_sum,
              CAST(sum(CAST(round(s_acctbal) AS BIGINT)) AS BIGINT) AS balance, CAST(max(s_suppkey) AS BIGINT) AS last_key
       FROM supplier GROUP BY s_nationkey""",
)
def sums_by_group(spark, sf):
    return table(spark, sf, "supplier").groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("n_suppliers"),
        F.sum("s_suppkey").alias("key_sum"),
        F.sum(F.round("s_acctbal").cast("long")).alias("balance"),
        F.max("s_suppkey").alias("last_key"),
    )


# -- checks -------------------------------------------------------------------


@exercise(
    "quality_report",
    """SELECT 'orders' AS table_name, 'rows' AS check_name, count(*) AS check_value, count(*) >= 1 AS passed FROM orders
       UNION ALL SELECT 'orders', 'null o_custkey', count(*) FILTER (o_custkey IS NULL), count(*) FILTER (o_custkey IS NULL) = 0 FROM orders
       UNION ALL SELECT 'orders', 'duplicate o_orderkey', count(*), count(*) = 0
                 FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
       UNION ALL SELECT 'lineitem', 'rows', count(*), count(*) >= 1 FROM lineitem
       UNION ALL SELECT 'lineitem', 'null big', count(*) FILTER (l_quantity <= 10), count(*) FILTER (l_quantity <= 10) = 0 FROM lineitem
       UNION ALL SELECT 'lineitem', 'duplicate l_orderkey, l_linenumber', count(*), count(*) = 0
                 FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
       UNION ALL SELECT 'none', 'rows', count(*), count(*) >= 1 FROM events WHERE event_type = 'no such type'""",
)
def quality_report(spark, sf):
    l = table(spark, sf, "lineitem").withColumn("big", F.when(F.col("l_quantity") > 10, F.lit(True)))
    tables = {
        "orders": table(spark, sf, "orders"),
        "lineitem": l,
        "none": table(spark, sf, "events").filter(F.col("event_type") == "no such type"),
    }
    checks = [
        TableCheck("orders", ["o_custkey"], ["o_orderkey"]),
        TableCheck("lineitem", ["big"], ["l_orderkey", "l_linenumber"]),
        TableCheck("none"),
    ]
    return run_checks(tables, checks)


@exercise(
    "duplicate_key_rows",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def duplicate_key_rows(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@exercise(
    "not_null_rejects",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_custkey END AS o_custkey, 'good' AS side FROM orders
       WHERE o_orderkey % 9 <> 0
       UNION ALL SELECT o_orderkey, NULL, 'reject' FROM orders WHERE o_orderkey % 9 = 0""",
)
def not_null_rejects(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_custkey")).alias("o_custkey")
    )
    good, rejects = require_not_null(o, ["o_orderkey", "o_custkey"])
    return good.withColumn("side", F.lit("good")).unionByName(rejects.withColumn("side", F.lit("reject")))


@exercise(
    "sql_checks",
    """SELECT 'sql' AS table_name, 'no orphan orders' AS check_name, CAST(count(*) AS VARCHAR) AS check_value,
              count(*) = 0 AS passed FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
       UNION ALL SELECT 'sql', 'status count', CAST(count(DISTINCT o_orderstatus) AS VARCHAR), count(DISTINCT o_orderstatus) = 9
       FROM orders""",
)
def sql_checks(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("checked_orders")
    table(spark, sf, "customer").createOrReplaceTempView("checked_customer")
    orphans = """SELECT count(*) FROM checked_orders o LEFT ANTI JOIN checked_customer c ON o.o_custkey = c.c_custkey"""
    return run_sql_checks(
        spark,
        [
            SqlCheck("no orphan orders", orphans, 0),
            SqlCheck("status count", "SELECT count(DISTINCT o_orderstatus) FROM checked_orders", 9),
        ],
    )
