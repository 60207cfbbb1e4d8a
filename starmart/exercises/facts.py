"""Lookup joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.exercises.inputs import artist_number, song_title
from starmart.exercises.registry import exercise, table
from starmart.operators.filters import present
from starmart.operators.joins import balanced_join, lookup_first, lookup_join, two_role_lookup

# Lines look their part up by descriptive keys. Four parts share an artist, so a key has at
# most four parts and the joins stay linear in the data.


def _plays(spark, sf):
    l = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", F.col("l_partkey").alias("p_partkey")
    )
    p = table(spark, sf, "part").select(
        "p_partkey", song_title().alias("song"), artist_number().alias("artist"), F.col("p_retailprice").alias("length")
    )
    return lookup_join(l, p, ["p_partkey"], "inner", right_unique=True)


def _songs(spark, sf, *keys):
    p = table(spark, sf, "part").filter(F.col("p_size") > 10)
    columns = {
        "song": song_title(),
        "artist": artist_number(),
        "length": F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice") + F.lit(0.04)).otherwise(F.col("p_retailprice")),
    }
    return p.select(*[columns[k].alias(k) for k in keys], F.col("p_partkey").alias("song_id"), F.col("p_brand").alias("brand"))


_FACT_SQL = """WITH plays AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, p_partkey, split_part(p_name, ' ', 1) AS song,
         p_partkey // 4 AS artist, p_retailprice AS length
  FROM lineitem JOIN part ON l_partkey = p_partkey
), songs AS (
  SELECT split_part(p_name, ' ', 1) AS song, p_partkey // 4 AS artist,
         CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + CAST(0.04 AS DOUBLE) ELSE p_retailprice END AS length,
         p_partkey AS song_id, p_brand AS brand
  FROM part WHERE p_size > 10
)"""
_OUT = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "p_partkey", "song_id", "brand"]
_OUT_SQL = ", ".join(_OUT)


@exercise(
    "fact_left_join_2key",
    f"{_FACT_SQL} SELECT {_OUT_SQL} FROM plays p LEFT JOIN songs s ON p.song = s.song AND p.artist = s.artist",
)
def fact_left_join_2key(spark, sf):
    return lookup_join(_plays(spark, sf), _songs(spark, sf, "song", "artist"), ["song", "artist"], "left").select(*_OUT)


@exercise(
    "fact_lookup_top1",
    f"""{_FACT_SQL}, one AS (SELECT song, artist, min(song_id) AS song_id FROM songs GROUP BY 1, 2),
        first AS (SELECT one.*, s.brand FROM one JOIN songs s ON s.song_id = one.song_id)
        SELECT {_OUT_SQL} FROM plays p LEFT JOIN first s ON p.song = s.song AND p.artist = s.artist""",
)
def fact_lookup_top1(spark, sf):
    songs = _songs(spark, sf, "song", "artist")
    return lookup_first(_plays(spark, sf), songs, ["song", "artist"], ["song_id", "brand"]).select(*_OUT)


@exercise(
    "fact_lookup_exact",
    f"""{_FACT_SQL} SELECT {_OUT_SQL} FROM plays p
        LEFT JOIN songs s ON p.song = s.song AND p.artist = s.artist AND p.length = s.length""",
)
def fact_lookup_exact(spark, sf):
    songs = _songs(spark, sf, "song", "artist", "length")
    keys = ["song", "artist", "length"]
    return lookup_first(_plays(spark, sf), songs, keys, ["song_id", "brand"]).select(*_OUT)


@exercise(
    "fact_left_join_decimal0",
    f"""{_FACT_SQL} SELECT {_OUT_SQL} FROM plays p LEFT JOIN songs s ON p.song = s.song AND p.artist = s.artist
        AND CAST(p.length AS DECIMAL(18,0)) = CAST(s.length AS DECIMAL(18,0))""",
)
def fact_left_join_decimal0(spark, sf):
    seconds = {"length": F.col("length").cast("decimal(18,0)")}
    plays = _plays(spark, sf).withColumns(seconds)
    songs = _songs(spark, sf, "song", "artist", "length").withColumns(seconds)
    return lookup_join(plays, songs, ["song", "artist", "length"], "left").select(*_OUT)


@exercise(
    "fact_not_null_inner",
    f"""{_FACT_SQL} SELECT {_OUT_SQL} FROM plays p LEFT JOIN songs s ON p.song = s.song AND p.artist = s.artist
        WHERE song_id IS NOT NULL AND brand IS NOT NULL""",
)
def fact_not_null_inner(spark, sf):
    songs = present(_songs(spark, sf, "song", "artist"), ["song_id", "brand"])
    return lookup_join(_plays(spark, sf), songs, ["song", "artist"], "inner").select(*_OUT)


_HOT_SQL = """WITH l AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
         CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 3 = 1 THEN l_partkey END AS k FROM lineitem
), r AS (SELECT p_partkey AS k, p_brand, p_size FROM part WHERE p_size > 10 OR p_partkey = 7)"""


@exercise(
    "balanced_join_hot_key",
    f"""{_HOT_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l.k, p_brand, p_size
        FROM l LEFT JOIN r ON l.k = r.k""",
)
def balanced_join_hot_key(spark, sf):
    """A third of the lines share one key, a third have none: the shuffle form of the lookup join."""
    kind = F.col("l_orderkey") % 3
    l = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.when(kind == 0, F.lit(7).cast("long")).when(kind == 1, F.col("l_partkey")).alias("k"),
    )
    r = table(spark, sf, "part").filter((F.col("p_size") > 10) | (F.col("p_partkey") == 7))
    r = r.select(F.col("p_partkey").alias("k"), "p_brand", "p_size")
    return balanced_join(l, r, ["k"], "left", right_unique=True)


@exercise(
    "balanced_join_timestamp_key",
    """WITH hot AS (SELECT min(ts) AS ts FROM events),
       l AS (SELECT event_id, ts AS k FROM events UNION ALL SELECT -1, ts FROM hot UNION ALL SELECT -2, ts + INTERVAL 1 MICROSECOND FROM hot),
       r AS (SELECT event_id AS r_id, CASE WHEN event_id % 3 = 0 THEN hot.ts ELSE events.ts END AS k FROM events, hot)
       SELECT l.event_id, l.k, r.r_id FROM l LEFT JOIN r ON l.k = r.k""",
)
def balanced_join_timestamp_key(spark, sf):
    """A time that a third of the right rows share; a left row has that time, another the next microsecond."""
    e = table(spark, sf, "events").select("event_id", F.col("ts").alias("k"))
    hot = e.agg(F.min("k").alias("hot"))
    near = hot.select(F.lit(-2).cast("long").alias("event_id"), (F.col("hot") + F.expr("INTERVAL '0.000001' SECOND")).alias("k"))
    l = e.unionByName(hot.select(F.lit(-1).cast("long").alias("event_id"), F.col("hot").alias("k"))).unionByName(near)
    third = F.col("event_id") % 3 == 0
    r = e.join(F.broadcast(hot)).select(F.col("event_id").alias("r_id"), F.when(third, F.col("hot")).otherwise(F.col("k")).alias("k"))  # one row
    return balanced_join(l, r, ["k"], "left")


@exercise(
    "dimension_join",
    """SELECT p_partkey AS song_id, p_name AS title, s_name AS artist FROM part
       JOIN supplier ON s_suppkey = p_partkey % 100 + p_size % 3""",
)
def dimension_join(spark, sf):
    p = table(spark, sf, "part").select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        (F.col("p_partkey") % 100 + F.col("p_size") % 3).alias("artist_id"),
    )
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist"))
    return lookup_join(p, s, ["artist_id"], "inner", right_unique=True).select("song_id", "title", "artist")


_ROLES_SQL = """WITH codes AS (SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 6 <> 0),
 lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, c_nationkey, s_nationkey FROM lineitem
   JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""


def _roles(spark, sf, label):
    l = table(spark, sf, "lineitem").select(
        "l_linenumber", "l_partkey", "l_quantity", F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey")
    )
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    lines = lookup_join(l, o, ["o_orderkey"], "inner", right_unique=True)
    lines = lookup_join(lines, c, ["c_custkey"], "inner", right_unique=True, heavy_from=o)
    lines = lookup_join(lines, s, ["s_suppkey"], "inner", right_unique=True, heavy_from=l)
    codes = table(spark, sf, "nation").filter(F.col("n_nationkey") % 6 != 0).select("n_nationkey", "n_name")
    roles = {"c_nationkey": "residency_country", "s_nationkey": "origin_country"}
    return two_role_lookup(lines, codes, "n_nationkey", roles, label).withColumnRenamed("o_orderkey", "l_orderkey")


@exercise(
    "two_role_lookup",
    f"""{_ROLES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, a.n_name AS residency_country,
          b.n_name AS origin_country
        FROM lines JOIN codes a ON a.n_nationkey = c_nationkey JOIN codes b ON b.n_nationkey = s_nationkey""",
)
def two_role_lookup_query(spark, sf):
    return _roles(spark, sf, "n_name").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "residency_country", "origin_country"
    )


@exercise(
    "two_role_filter",
    f"""{_ROLES_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lines
        WHERE c_nationkey IN (SELECT n_nationkey FROM codes) AND s_nationkey IN (SELECT n_nationkey FROM codes)""",
)
def two_role_filter(spark, sf):
    return _roles(spark, sf, None).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@exercise(
    "lookup_using_not_null",
    """SELECT s.code, c.c_nationkey AS nation, c.c_mktsegment AS segment, count(*) AS n_customers,
              CAST(sum(c.c_custkey) AS BIGINT) AS key_sum
       FROM customer c JOIN (SELECT s_nationkey, CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS segment,
                                    min(s_name) AS code FROM supplier GROUP BY 1, 2) s
         ON s.s_nationkey = c.c_nationkey AND s.segment = c.c_mktsegment
       GROUP BY 1, 2, 3""",
)
def lookup_using_not_null(spark, sf):
    totals = table(spark, sf, "customer").groupBy(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    ).agg(F.count(F.lit(1)).alias("n_customers"), F.sum("c_custkey").alias("key_sum"))
    segment = F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("MACHINERY")
    codes = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("nation"), segment.alias("segment"))
    codes = codes.agg(F.min("s_name").alias("code"))
    return lookup_join(totals, codes, ["nation", "segment"], "inner", right_unique=True).select(
        "code", "nation", "segment", "n_customers", "key_sum"
    )


@exercise(
    "code_map_left",
    """SELECT c_custkey, c_nationkey, n_name, r_name FROM customer
       LEFT JOIN (SELECT * FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) ON n_regionkey = r_regionkey)
         ON c_nationkey = n_nationkey""",
)
def code_map_left(spark, sf):
    r = table(spark, sf, "region").filter(F.col("r_regionkey") < 3).select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    n = table(spark, sf, "nation")
    codes = lookup_join(n, r, ["n_regionkey"], "left", right_unique=True).select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lookup_join(c, codes, ["c_nationkey"], "left", [n], right_unique=True).select("c_custkey", "c_nationkey", "n_name", "r_name")
