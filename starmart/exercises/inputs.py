"""Stand-in inputs derived from the test tables, as Spark frames and as the same SQL.

Events become an activity log (one user, part and session each), parts become song
records, orders become immigration records, customers city demographics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.contracts import EVENT_PATHS, STAGED_EVENTS
from starmart.exercises.registry import table
from starmart.operators.joins import lookup_join


def artist_number() -> Column:
    return F.expr("p_partkey div 4")


def song_title() -> Column:
    return F.substring_index("p_name", " ", 1)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged events plus ``event_id``. Three event types count as plays; every tenth event has no artist."""
    e = table(spark, sf_dir, "events").withColumn("p_partkey", F.get_json_object("props", "$.k").cast("long"))
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    joined = lookup_join(e, p, ["p_partkey"], "inner", right_unique=True)
    joined = lookup_join(joined, c, ["user_id"], "inner", right_unique=True, heavy_from=e)
    song_event = F.col("event_id") % 10 != 0
    return joined.select(
        "event_id",
        F.when(song_event, F.concat(F.lit("Artist "), artist_number())).alias("artist"),
        F.lit("Logged In").alias("auth"),
        F.col("c_name").alias("first_name"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.col("event_id") % 20).cast("int").alias("item_in_session"),
        F.col("c_mktsegment").alias("last_name"),
        F.when(song_event, F.col("p_retailprice")).alias("length"),
        F.when(F.col("value") > 20, "paid").otherwise("free").alias("level"),
        F.lower("c_mktsegment").alias("location"),
        F.lit("PUT").alias("method"),
        F.when(F.col("event_type").isin("view", "click", "purchase"), "NextSong")
        .otherwise(F.col("event_type"))
        .alias("page"),
        (F.col("user_id") * 1000).cast("double").alias("registration"),
        (F.col("user_id") * 31 + F.dayofmonth("ts")).cast("int").alias("session_id"),
        F.when(song_event, song_title()).alias("song"),
        F.lit(200).alias("status"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.concat(F.lit("agent/"), F.col("event_id") % 5).alias("user_agent"),
        "user_id",
    )


LOG_SQL = """log AS (
  SELECT e.event_id,
         CASE WHEN e.event_id % 10 <> 0 THEN 'Artist ' || CAST(p.p_partkey // 4 AS VARCHAR) END AS artist,
         'Logged In' AS auth,
         c.c_name AS first_name,
         CASE WHEN e.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CAST(e.event_id % 20 AS INTEGER) AS item_in_session,
         c.c_mktsegment AS last_name,
         CASE WHEN e.event_id % 10 <> 0 THEN p.p_retailprice END AS length,
         CASE WHEN e.value > 20 THEN 'paid' ELSE 'free' END AS level,
         lower(c.c_mktsegment) AS location,
         'PUT' AS method,
         CASE WHEN e.event_type IN ('view', 'click', 'purchase') THEN 'NextSong' ELSE e.event_type END AS page,
         CAST(e.user_id * 1000 AS DOUBLE) AS registration,
         CAST(e.user_id * 31 + day(e.ts) AS INTEGER) AS session_id,
         CASE WHEN e.event_id % 10 <> 0 THEN split_part(p.p_name, ' ', 1) END AS song,
         200 AS status,
         epoch_us(e.ts) // 1000 AS ts,
         'agent/' || CAST(e.event_id % 5 AS VARCHAR) AS user_agent,
         e.user_id
  FROM events e
  JOIN part p ON p.p_partkey = CAST(regexp_extract(e.props, '[0-9]+') AS BIGINT)
  JOIN customer c ON c.c_custkey = e.user_id
), plays AS (SELECT * FROM log WHERE page = 'NextSong')"""


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log under its JSON key names, user ids as text; ``event_id`` stays as a key no contract knows."""
    staged = log(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("string"))
    return staged.withColumnsRenamed({column: path for path, column in EVENT_PATHS.items()})


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song records of all parts, four parts to an artist. A third have a slightly longer duration, and those of the
    smaller parts another artist name, so that some plays match no song."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("A"), artist_number()).alias("artist_id"),
        (F.col("p_size") * 1.5).cast("double").alias("artist_latitude"),
        F.col("p_type").alias("artist_location"),
        F.when(F.col("p_size") % 5 != 0, (F.col("p_size") * -2.5).cast("double")).alias("artist_longitude"),
        F.concat(F.when(F.col("p_size") > 10, "Artist ").otherwise("Band "), artist_number()).alias("artist_name"),
        F.when(F.col("p_partkey") % 3 == 0, F.col("p_retailprice") + F.lit(0.04))
        .otherwise(F.col("p_retailprice"))
        .alias("duration"),
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("S"), F.col("p_partkey")).alias("song_id"),
        song_title().alias("title"),
        (F.col("p_size") + 1980).cast("int").alias("year"),
    )


SONGS_SQL = """song_records AS (
  SELECT 'A' || CAST(p_partkey // 4 AS VARCHAR) AS artist_id,
         CAST(p_size * 1.5 AS DOUBLE) AS artist_latitude,
         p_type AS artist_location,
         CASE WHEN p_size % 5 <> 0 THEN CAST(p_size * -2.5 AS DOUBLE) END AS artist_longitude,
         CASE WHEN p_size > 10 THEN 'Artist ' ELSE 'Band ' END || CAST(p_partkey // 4 AS VARCHAR) AS artist_name,
         CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + CAST(0.04 AS DOUBLE) ELSE p_retailprice END AS duration,
         1 AS num_songs,
         'S' || CAST(p_partkey AS VARCHAR) AS song_id,
         split_part(p_name, ' ', 1) AS title,
         CAST(p_size + 1980 AS INTEGER) AS year
  FROM part
)"""

MUSIC_SQL = f"WITH {LOG_SQL}, {SONGS_SQL}"


def immigration_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as 13-column immigration records: arrival on the first of the year, purposes 1-3, modes 1-4, countries 100-124."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    joined = lookup_join(o, c, ["o_custkey"], "inner", right_unique=True)
    days = F.date_diff(F.trunc("o_orderdate", "year"), F.lit("1960-01-01").cast("date"))
    key = F.col("o_orderkey")
    return joined.select(
        key.cast("double").alias("cicid"),
        days.cast("double").alias("arrdate"),
        (F.col("c_nationkey") + 100).cast("double").alias("i94cit"),
        ((F.col("c_nationkey") * 7 + 3) % 25 + 100).cast("double").alias("i94res"),
        F.when(F.col("o_orderpriority") < "3", "NYC").otherwise("LOS").alias("i94port"),
        (key % 4 + 1).cast("double").alias("i94mode"),
        F.substring("c_mktsegment", 1, 2).alias("i94addr"),
        F.when(key % 7 != 0, (days + 14).cast("double")).alias("depdate"),
        (F.floor(key / 12) % 2 * 30 + 20).cast("double").alias("i94bir"),
        ((key + F.floor(key / 4)) % 3 + 1).cast("double").alias("i94visa"),
        F.when(key % 5 != 0, F.when(key % 3 == 0, "F").otherwise("M")).alias("gender"),
        F.col("o_orderstatus").alias("airline"),
        F.concat(F.lit("B"), F.col("o_custkey") % 2 + 1).alias("visatype"),
    )


IMMIGRATION_SQL = """immigration_input AS (
  SELECT CAST(o_orderkey AS DOUBLE) AS cicid,
         CAST(date_diff('day', DATE '1960-01-01', CAST(date_trunc('year', o_orderdate) AS DATE)) AS DOUBLE) AS arrdate,
         CAST(c_nationkey + 100 AS DOUBLE) AS i94cit,
         CAST((c_nationkey * 7 + 3) % 25 + 100 AS DOUBLE) AS i94res,
         CASE WHEN o_orderpriority < '3' THEN 'NYC' ELSE 'LOS' END AS i94port,
         CAST(o_orderkey % 4 + 1 AS DOUBLE) AS i94mode,
         substr(c_mktsegment, 1, 2) AS i94addr,
         CASE WHEN o_orderkey % 7 <> 0
              THEN CAST(date_diff('day', DATE '1960-01-01', CAST(date_trunc('year', o_orderdate) AS DATE)) + 14 AS DOUBLE) END AS depdate,
         CAST(o_orderkey // 12 % 2 * 30 + 20 AS DOUBLE) AS i94bir,
         CAST((o_orderkey + o_orderkey // 4) % 3 + 1 AS DOUBLE) AS i94visa,
         CASE WHEN o_orderkey % 5 <> 0 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'F' ELSE 'M' END END AS gender,
         o_orderstatus AS airline,
         'B' || CAST(o_custkey % 2 + 1 AS VARCHAR) AS visatype
  FROM orders JOIN customer ON c_custkey = o_custkey
), records AS (
  SELECT CAST(cicid AS INTEGER) AS cicid, DATE '1960-01-01' + CAST(arrdate AS INTEGER) AS arrival_date,
         DATE '1960-01-01' + CAST(depdate AS INTEGER) AS departure_date,
         CAST(CAST(i94cit AS INTEGER) AS VARCHAR) AS i94cit, CAST(CAST(i94res AS INTEGER) AS VARCHAR) AS i94res,
         i94port, CAST(i94mode AS INTEGER) AS i94mode, i94addr, CAST(i94bir AS INTEGER) AS i94bir,
         CAST(i94visa AS INTEGER) AS i94visa, gender, airline, visatype
  FROM immigration_input WHERE i94visa = 2 AND i94mode = 1
)"""


def catalogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label catalogue text per supplier: a country, a port and a state section.

    Each port section has a line with a second ``=`` (ignored) and a code given twice (the
    later label counts). Every fifth supplier's port has no state.
    """
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey").cast("string")
    port = F.concat(F.lit("P"), key)
    state = F.concat(F.lit("ST"), F.col("s_nationkey"))
    ending = F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit(", "), state)).otherwise(F.lit(""))
    code = (F.col("s_nationkey") + 100).cast("string")
    text = F.concat(
        F.lit("value i94cntyl\n   "), code, F.lit(" =  'COUNTRY "), code, F.lit("'\n;\n\nvalue i94prtl\n\t'"),
        port, F.lit("'\t=\t'OLD NAME, XX'\n\t'BAD"), key, F.lit("'='a=b'\n '"),
        port, F.lit("'='CITY "), key, ending, F.lit("   '\n;\nvalue i94addrl\n\t'"),
        state, F.lit("'='STATE "), F.col("s_nationkey"), F.lit("'\n;\n"),
    )
    return s.select("s_suppkey", text.alias("text"))


def catalogue_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalogue text with a line per supplier nation in each section."""
    s = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("port"))

    def section(name: str, line: Column) -> Column:
        lines = F.array_join(F.sort_array(F.collect_list(line)), "\n")  # as many lines as nations
        return F.concat(F.lit(f"value {name}\n"), lines, F.lit("\n;\n"))

    nation, port = F.col("s_nationkey"), F.col("port")
    country = F.concat(F.lit("   "), nation + 100, F.lit(" =  'COUNTRY "), nation + 100, F.lit("'"))
    city = F.concat(F.lit("\t'P"), port, F.lit("'\t=\t'CITY "), port, F.lit(", ST"), nation, F.lit("  '"))
    state = F.concat(F.lit("\t'ST"), nation, F.lit("'='STATE "), nation, F.lit("'"))
    return s.agg(
        F.concat(section("i94cntyl", country), section("i94prtl", city), section("i94addrl", state)).alias("text")
    )


CITY_CODES_SQL = """city_map AS (
  SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS city_code, 'CITY ' || CAST(s_suppkey AS VARCHAR) AS city_name,
         CASE WHEN s_suppkey % 5 <> 0 THEN 'ST' || CAST(s_nationkey AS VARCHAR) END AS state_code,
         CASE WHEN s_suppkey % 5 <> 0 THEN 'STATE ' || CAST(s_nationkey AS VARCHAR) END AS state_name
  FROM supplier
)"""


def city_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as city demographics under the file's header names; cities 0 to the supplier count and beyond."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    male, female = (key % 700 + 10).cast("string"), (key % 900 + 20).cast("string")
    return c.select(
        F.concat(F.lit("City "), F.expr("c_custkey div 10")).alias("City"),
        F.lit("State").alias("State"),
        F.lit("30.5").alias("Median Age"),
        male.alias("Male Population"),
        female.alias("Female Population"),
        (key % 700 + key % 900 + 30).cast("string").alias("Total Population"),
        F.lit("1").alias("Number of Veterans"),
        F.when(key % 11 != 0, (key % 50).cast("string")).alias("Foreign-born"),
        F.lit("2.5").alias("Average Household Size"),
        F.concat(F.lit("ST"), F.col("c_nationkey")).alias("State Code"),
        F.col("c_mktsegment").alias("Race"),
        F.lit("7").alias("Count"),
    )


CITIES_SQL = """cities AS (
  SELECT 'CITY ' || CAST(c_custkey // 10 AS VARCHAR) AS city_name, 'ST' || CAST(c_nationkey AS VARCHAR) AS state_code,
         upper(c_mktsegment) AS race,
         CAST(c_custkey % 700 + 10 AS INTEGER) AS male_population,
         CAST(c_custkey % 900 + 20 AS INTEGER) AS female_population,
         CAST(c_custkey % 700 + c_custkey % 900 + 30 AS INTEGER) AS total_population,
         CAST(CASE WHEN c_custkey % 11 <> 0 THEN c_custkey % 50 END AS INTEGER) AS foreign_born
  FROM customer
)"""


def temperature_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as temperature readings from 1880 on, 25 countries; every fifth reading is missing."""
    e = table(spark, sf_dir, "events")
    key = F.col("event_id")
    day = F.date_add(F.lit("1880-01-01").cast("date"), (key % 100 * 160).cast("int"))
    return e.select(
        day.cast("string").alias("dt"),
        F.when(key % 5 != 0, F.floor("value").cast("double")).alias("AverageTemperature"),
        F.lit(0.5).alias("AverageTemperatureUncertainty"),
        F.concat(F.lit("City "), F.col("user_id")).alias("City"),
        F.concat(F.lit("Country "), F.col("user_id") % 25).alias("Country"),
        F.lit("57.05N").alias("Latitude"),
        F.lit("10.33E").alias("Longitude"),
    )


TEMPERATURE_SQL = """temperatures AS (
  SELECT DATE '1880-01-01' + CAST(event_id % 100 * 160 AS INTEGER) AS date,
         'COUNTRY ' || CAST(user_id % 25 AS VARCHAR) AS country_name,
         'CITY ' || CAST(user_id AS VARCHAR) AS city_name, floor(value) AS average_temperature
  FROM events WHERE event_id % 5 <> 0
)"""

assert list(EVENT_PATHS.values()) == list(STAGED_EVENTS.columns)
