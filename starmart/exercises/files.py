"""Sources and sinks: tables written to the shared folder by Spark and read back through the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmart.contracts import EVENT_CSV_COLUMNS, EVENT_PATHS, EVENT_RECORDS, STAGED_EVENTS, TableContract, in_order
from starmart.exercises import inputs
from starmart.exercises.registry import exercise, table
from starmart.plans.immigration import city_records, temperature_records, with_visa_names
from starmart.operators.joins import lookup_join
from starmart.plans.session_items import clean_items
from starmart.session import scratch_dir
from starmart.sinks import (
    append,
    append_new,
    insert_first_wins,
    insert_numbered,
    read_current,
    read_folders,
    truncate_insert,
    upsert,
    write_last_wins,
    write_parquet,
    write_quoted_csv,
    write_songs,
)
from starmart.sinks.tables import drop_table, insert_into, register_views, reset
from starmart.sources.files import read_csv_by_position
from starmart.sources import (
    city_codes,
    code_map,
    expand_paths,
    first_per_file,
    line_count,
    read_csv_files,
    read_immigration,
    read_json_auto,
    read_json_glob,
    read_json_paths,
    read_json_tree,
    read_table,
    section_codes,
)

_MUSIC_LOG = f"WITH {inputs.LOG_SQL}"


def _raw_log_folder(spark, sf, label):
    """The log as JSON files below one folder per page, beside text files the scans must ignore."""
    root = scratch_dir(spark, label)
    raw = inputs.raw_log(spark, sf)
    raw.withColumn("dir", F.col("page")).write.partitionBy("dir").json(f"{root}/log")
    raw.select(F.to_json(F.struct("page", "ts")).alias("value")).write.text(f"{root}/log/notes")
    return f"{root}/log"


@exercise(
    "src_json_tree",
    f"{_MUSIC_LOG} SELECT artist, song, page, CAST(user_id AS VARCHAR) AS \"userId\", session_id AS \"sessionId\", ts, length FROM log",
)
def src_json_tree(spark, sf):
    rows = read_json_tree(spark, _raw_log_folder(spark, sf, "tree"), EVENT_RECORDS.schema)
    return rows.select("artist", "song", "page", "userId", "sessionId", "ts", "length")


@exercise(
    "src_json_glob",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 2 = 0""",
)
def src_json_glob(spark, sf):
    root = scratch_dir(spark, "glob")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    o.filter(F.col("o_orderkey") % 2 == 0).write.json(root)
    o.filter(F.col("o_orderkey") % 2 == 1).write.json(f"{root}/deeper")  # a sub-folder is not read
    return read_json_glob(spark, root, o.schema)


@exercise(
    "src_first_per_file",
    """SELECT ym, o_orderdate, o_orderkey, o_custkey FROM
       (SELECT strftime(o_orderdate, '%Y-%m') AS ym, o_orderdate, o_orderkey, o_custkey,
               row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderdate, o_orderkey) AS rn
        FROM orders) WHERE rn = 1""",
)
def src_first_per_file(spark, sf):
    """A month may span several files; the first over its files' first records is the month's first."""
    root = scratch_dir(spark, "first")
    o = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("ym"), "o_orderdate", "o_orderkey", "o_custkey"
    )
    schema = o.schema
    o.withColumn("dir", F.col("ym")).write.partitionBy("dir").json(root)
    firsts = first_per_file(read_json_tree(spark, root, schema), ["o_orderdate", "o_orderkey"])
    pick = F.min(F.struct("o_orderdate", "o_orderkey", "o_custkey")).alias("r")
    return firsts.groupBy("ym").agg(pick).select("ym", "r.*")


@exercise(
    "src_event_csv",
    f"""{_MUSIC_LOG} SELECT artist, first_name AS "firstName", gender, CAST(item_in_session AS VARCHAR) AS "itemInSession",
          last_name AS "lastName", length, level, location, CAST(session_id AS VARCHAR) AS "sessionId", song,
          CAST(user_id AS VARCHAR) AS "userId" FROM log WHERE artist IS NOT NULL""",
)
def src_event_csv(spark, sf):
    """Many headered 17-column event files; the cleaned 11 columns, events without an artist left out."""
    root = scratch_dir(spark, "csv")
    raw = inputs.raw_log(spark, sf).select(*EVENT_CSV_COLUMNS)
    raw.write.option("header", True).partitionBy().csv(root)
    return clean_items(spark, root).withColumn("length", F.col("length").cast("double"))


@exercise(
    "src_csv_semicolon",
    f"WITH {inputs.CITIES_SQL} SELECT city_name, state_code, race, male_population, female_population, total_population, foreign_born FROM cities",
)
def src_csv_semicolon(spark, sf):
    root = scratch_dir(spark, "cities")
    inputs.city_file(spark, sf).write.option("header", True).option("sep", ";").csv(root)
    return city_records(spark, root)


@exercise(
    "src_csv_reordered",
    f"WITH {inputs.CITIES_SQL} SELECT city_name, state_code, race, male_population, female_population, total_population, foreign_born FROM cities",
)
def src_csv_reordered(spark, sf):
    """Two folders whose files hold the city columns in other orders, one with a column of its own."""
    root = scratch_dir(spark, "reordered")
    cities = inputs.city_file(spark, sf)
    first = F.col("State Code") < "ST2"
    backwards = cities.select(*reversed(cities.columns))
    backwards.filter(first).write.option("header", True).option("sep", ";").csv(f"{root}/a")
    cities.filter(~first).withColumn("Mayor", F.lit("x")).write.option("header", True).option("sep", ";").csv(f"{root}/b")
    return city_records(spark, [f"{root}/a", f"{root}/b"])


@exercise(
    "src_csv_line_breaks",
    """SELECT doc_id, md5(text) AS text_md5, 'good' AS outcome FROM documents WHERE doc_id % 7 <> 0
       UNION ALL SELECT NULL, NULL, 'record: not 3 fields' FROM documents WHERE doc_id % 7 = 0""",
)
def src_csv_line_breaks(spark, sf):
    """Texts with quotes and line breaks as fields, read by position; records of two fields are set aside."""
    root = scratch_dir(spark, "breaks")
    d = table(spark, sf, "documents")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    short = F.col("doc_id") % 7 == 0
    line = F.when(short, F.concat_ws(",", "doc_id", "lang")).otherwise(F.concat_ws(",", "doc_id", quoted, "lang"))
    # every file begins with a header line: each tenth of the documents is a file
    part = (F.col("doc_id") % 10).alias("part")
    header = d.select(part).distinct().select("part", F.lit("id,text,lang").alias("line"), F.lit(0).alias("n"))
    rows = d.select(part, line.alias("line"), F.lit(1).alias("n")).unionByName(header)
    rows = rows.repartition(10, "part").sortWithinPartitions("part", "n")
    rows.select("part", "line").write.partitionBy("part").text(f"{root}/in")
    good, rejects = read_csv_by_position(spark, f"{root}/in/*", ["id", "text", "lang"])
    good = good.select(F.col("id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"), F.lit("good").alias("outcome"))
    aside = rejects.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text_md5"), F.col("reject_reason").alias("outcome"))
    return good.unionByName(aside)


@exercise(
    "src_csv_comma",
    f"""WITH {inputs.TEMPERATURE_SQL} SELECT date, country_name, city_name, average_temperature, CAST(0.5 AS DOUBLE) AS average_temperature_uncertainty,
          '57.05N' AS latitude, '10.33E' AS longitude FROM temperatures""",
)
def src_csv_comma(spark, sf):
    root = scratch_dir(spark, "temperatures")
    inputs.temperature_file(spark, sf).write.option("header", True).csv(root)
    return temperature_records(spark, root)


_NESTED = TableContract("nested", {"event": "bigint", "kind": "string", "user": "bigint", "amount": "double", "agent": "string"})


@exercise(
    "src_json_paths",
    """SELECT event_id AS event, CASE WHEN event_id % 3 <> 0 THEN event_type END AS kind, user_id AS user,
              CASE WHEN event_id % 2 = 0 THEN value END AS amount, NULL AS agent FROM events""",
)
def src_json_paths(spark, sf):
    """Nested keys to table columns through a path list; blank text becomes null."""
    root = scratch_dir(spark, "paths")
    e = table(spark, sf, "events")
    kind = F.when(F.col("event_id") % 3 == 0, " ").otherwise(F.col("event_type"))
    amount = F.when(F.col("event_id") % 2 == 0, F.col("value"))
    e.select(
        F.col("event_id").alias("id"),
        F.struct(kind.alias("kind"), F.struct(F.col("user_id").alias("id"), amount.alias("spent")).alias("by")).alias("what"),
    ).write.json(root)
    paths = {"id": "event", "what.kind": "kind", "what.by.id": "user", "what.by.spent": "amount", "what.agent": "agent"}
    return read_json_paths(spark, root, paths, _NESTED)


_AUTO = TableContract(
    "auto",
    {"doc_id": "bigint", "text": "string", "lang": "string", "seen": "timestamp", "missing": "int"},
)


@exercise(
    "src_json_auto",
    """SELECT doc_id, md5(text) AS text_md5, CASE WHEN doc_id % 4 <> 0 THEN lang END AS lang,
              epoch_ms(CAST(doc_id * 1000003 AS BIGINT)) AS seen, CAST(NULL AS INTEGER) AS missing FROM documents""",
)
def src_json_auto(spark, sf):
    """Keys matched by name, one extra and one missing, whole texts, an epoch-milliseconds time."""
    root = scratch_dir(spark, "auto")
    table(spark, sf, "documents").select(
        "n_chars", "text", F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("lang")).alias("lang"),
        "doc_id", (F.col("doc_id") * 1000003).alias("seen"),
    ).write.json(root)
    rows = read_json_auto(spark, root, _AUTO, epoch_columns=["seen"])
    return rows.select("doc_id", F.md5("text").alias("text_md5"), "lang", "seen", "missing")


@exercise(
    "src_json_rejects",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS user,
              CASE WHEN event_id % 4 = 0 THEN 'user: malformed' ELSE 'good' END AS outcome
       FROM events WHERE event_id % 5 <> 0
       UNION ALL SELECT NULL, NULL, 'record: malformed' FROM events WHERE event_id % 5 = 0""",
)
def src_json_rejects(spark, sf):
    """Lines that are not JSON and values that do not cast are set aside; good and rejected rows are the input."""
    root = scratch_dir(spark, "rejects")
    e = table(spark, sf, "events")
    user = F.when(F.col("event_id") % 4 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string"))
    record = F.to_json(F.struct("event_id", user.alias("user")))
    broken = F.col("event_id") % 5 == 0
    lines = e.select(F.when(broken, F.concat(record, F.lit("}"))).otherwise(record).alias("value"), broken.alias("broken"))
    lines.select(F.when(F.col("broken"), F.expr("substr(value, 2)")).otherwise(F.col("value")).alias("value")).write.text(root)
    contract = TableContract("t", {"event_id": "bigint", "user": "bigint"})
    good, rejects = read_json_auto(spark, root, contract, malformed="reject")
    good = good.select("event_id", F.col("user").cast("string").alias("user"), F.lit("good").alias("outcome"))
    rejects = rejects.select(F.col("event_id").cast("bigint"), "user", F.col("reject_reason").alias("outcome"))
    return good.unionByName(rejects)


@exercise(
    "src_templated_path",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE strftime(o_orderdate, '%Y/%m') IN ('1997/02', '1997/11')""",
)
def src_templated_path(spark, sf):
    """Folders by run date, read for two runs."""
    root = scratch_dir(spark, "runs")
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")
    )
    o.write.partitionBy("y", "m").parquet(root)
    runs = [{"year": 1997, "month": 2}, {"year": 1997, "month": 11}]
    return spark.read.parquet(*expand_paths(root + "/y={year}/m={month}", runs))


@exercise(
    "src_immigration_files",
    f"WITH {inputs.IMMIGRATION_SQL} SELECT cicid, CAST(arrival_date - DATE '1960-01-01' AS DOUBLE) AS arrdate, i94cit, i94res, i94port, i94mode, i94addr, CAST(departure_date - DATE '1960-01-01' AS DOUBLE) AS depdate, i94bir, i94visa, gender, airline, visatype FROM records",
)
def src_immigration_files(spark, sf):
    """Records in several folders, read in one scan with the purpose and mode filter pushed to it."""
    root = scratch_dir(spark, "immigration")
    rows = inputs.immigration_input(spark, sf)
    half = F.col("i94bir") > 30
    rows.filter(half).write.parquet(f"{root}/a")
    rows.filter(~half).write.parquet(f"{root}/b")
    return read_immigration(spark, [f"{root}/a", f"{root}/b"])


@exercise(
    "src_label_catalogue",
    """SELECT s_suppkey, 'P' || CAST(s_suppkey AS VARCHAR) AS code,
              'CITY ' || CAST(s_suppkey AS VARCHAR) ||
              CASE WHEN s_suppkey % 5 <> 0 THEN ', ST' || CAST(s_nationkey AS VARCHAR) ELSE '' END AS label FROM supplier""",
)
def src_label_catalogue(spark, sf):
    return section_codes(inputs.catalogues(spark, sf), "i94prtl", keep=["s_suppkey"])


@exercise(
    "country_codes",
    "SELECT DISTINCT CAST(s_nationkey + 100 AS VARCHAR) AS country_code, 'COUNTRY ' || CAST(s_nationkey + 100 AS VARCHAR) AS country_name FROM supplier",
)
def country_codes(spark, sf):
    return code_map(inputs.catalogues(spark, sf), "i94cntyl", "country_code", "country_name")


@exercise("city_code_map", f"WITH {inputs.CITY_CODES_SQL} SELECT * FROM city_map")
def city_code_map(spark, sf):
    texts = inputs.catalogues(spark, sf)
    return city_codes(section_codes(texts, "i94prtl"), section_codes(texts, "i94addrl"))


@exercise(
    "visa_names",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
              CASE l_linenumber WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student' END AS visa_name
       FROM lineitem""",
)
def visa_names(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    return with_visa_names(spark, l, "l_linenumber")


# -- sinks --------------------------------------------------------------------


@exercise("snk_overwrite", "SELECT * FROM customer")
def snk_overwrite(spark, sf):
    path = scratch_dir(spark, "overwrite")
    c = table(spark, sf, "customer")
    write_parquet(c.limit(1), path)
    write_parquet(c, path)
    return read_table(spark, path)


@exercise(
    "lookup_by_bloom_filter",
    """SELECT md5(CAST(event_id AS VARCHAR)) AS key, event_id, user_id, event_type FROM events
       WHERE md5(CAST(event_id AS VARCHAR)) IN (SELECT md5(CAST(event_id AS VARCHAR)) FROM events WHERE event_id % 1000 = 7)""",
)
def lookup_by_bloom_filter(spark, sf):
    """Events under content keys in random order, looked up by some keys: row groups without one of them are skipped."""
    path = scratch_dir(spark, "bloom")
    e = table(spark, sf, "events").select(F.md5(F.col("event_id").cast("string")).alias("key"), "event_id", "user_id", "event_type")
    write_parquet(e, path, bloom=["key"])
    wanted = table(spark, sf, "events").filter("event_id % 1000 = 7").select(F.md5(F.col("event_id").cast("string")).alias("key"))
    return lookup_join(spark.read.schema(e.schema).parquet(path), wanted, ["key"], "inner", right_unique=True).select(*e.columns)


@exercise("snk_songs_by_year", f"WITH {inputs.SONGS_SQL} SELECT song_id, title, artist_id, duration, year FROM song_records")
def snk_songs_by_year(spark, sf):
    path = scratch_dir(spark, "songs")
    write_songs(inputs.songs(spark, sf).select("song_id", "title", "artist_id", "year", "duration"), path)
    return spark.read.parquet(path)


@exercise("snk_songs_year_artist", f"WITH {inputs.SONGS_SQL} SELECT song_id, title, artist_id, duration, year FROM song_records")
def snk_songs_year_artist(spark, sf):
    """One folder per year and artist."""
    path = scratch_dir(spark, "songsartist")
    songs = inputs.songs(spark, sf).select("song_id", "title", "artist_id", "year", "duration")
    write_songs(songs, path, folder_per_artist=True)
    return read_folders(spark, path, songs.schema, ["year", "artist_id"])


@exercise(
    "snk_year_month_rerun",
    """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN 'rerun' ELSE o_orderpriority END AS o_orderpriority,
              CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
)
def snk_year_month_rerun(spark, sf):
    """A rerun of one year replaces that year's partitions and leaves the others."""
    path = scratch_dir(spark, "ym")
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    write_parquet(o, path, ["year", "month"])
    rerun = o.filter(F.col("year") == 1997).withColumn("o_orderpriority", F.lit("rerun"))
    write_parquet(rerun, path, ["year", "month"], replace_only_written=True)
    return spark.read.schema(o.schema).parquet(path)


@exercise("snk_date_partition", "SELECT CAST(ts AS DATE) AS date, event_id, user_id FROM events")
def snk_date_partition(spark, sf):
    path = scratch_dir(spark, "date")
    e = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("date"))
    write_parquet(e, path, ["date"], sort_by=["event_id"])
    return spark.read.schema(e.schema).parquet(path)


@exercise(
    "snk_quoted_csv",
    """SELECT doc_id, md5(text) AS text_md5, CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang, source FROM documents""",
)
def snk_quoted_csv(spark, sf):
    """Texts with quotes and line breaks survive; null and empty text are both written as an empty field."""
    path = scratch_dir(spark, "quoted")
    d = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text",
        F.when(F.col("doc_id") % 3 == 1, F.col("lang")).when(F.col("doc_id") % 3 == 2, F.col("lang")).alias("lang"), "source",
    )
    write_quoted_csv(d, path)
    back = read_csv_files(spark, path, d.schema, multiline=True)
    return back.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.md5("text").alias("text_md5"), F.nullif("lang", F.lit("")).alias("lang"), "source"
    )


@exercise("snk_append", "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier")
def snk_append(spark, sf):
    root = scratch_dir(spark, "append")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name")
    append(s, root)
    append(s, root)
    return read_current(spark, root)


@exercise("snk_append_new_twice", "SELECT o_orderkey, o_custkey FROM orders")
def snk_append_new_twice(spark, sf):
    root = scratch_dir(spark, "appendnew")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    append_new(o.filter(F.col("o_orderkey") % 3 != 0), root, ["o_orderkey"])
    append_new(o, root, ["o_orderkey"])
    append_new(o, root, ["o_orderkey"])
    return read_current(spark, root)


@exercise(
    "snk_append_new_months",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
)
def snk_append_new_months(spark, sf):
    """A table by month; each load compares its batch with the months it touches only."""
    root = scratch_dir(spark, "appendmonths")
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    key = ["o_orderkey", "year", "month"]
    append_new(o.filter("o_orderkey % 3 <> 0"), root, key, partition_by=["year", "month"])
    append_new(o.filter("year = 1997"), root, key)
    append_new(o, root, key)
    return read_current(spark, root)


@exercise("snk_truncate_insert", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def snk_truncate_insert(spark, sf):
    """The second load reads the table it replaces."""
    root = scratch_dir(spark, "truncate")
    truncate_insert(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), root)
    truncate_insert(read_current(spark, root).filter(F.col("c_acctbal") > 0), root)
    return read_current(spark, root)


@exercise(
    "snk_insert_numbered",
    "SELECT 2 * count(*) AS n_rows, 2 * count(*) AS n_ids, count(*) AS n_orders, true AS second_above_first FROM orders",
)
def snk_insert_numbered(spark, sf):
    root = scratch_dir(spark, "numbered")
    o = table(spark, sf, "orders").select("o_orderkey")
    insert_numbered(o.withColumn("load", F.lit(1)), root, "id")
    insert_numbered(o.withColumn("load", F.lit(2)), root, "id")
    return read_current(spark, root).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("id").alias("n_ids"),
        F.count_distinct("o_orderkey").alias("n_orders"),
        (F.min(F.when(F.col("load") == 2, F.col("id"))) > F.max(F.when(F.col("load") == 1, F.col("id")))).alias("second_above_first"),
    )


@exercise(
    "snk_insert_first_wins",
    """SELECT p_name, p_partkey, p_brand FROM (SELECT *, row_number() OVER
         (PARTITION BY p_name ORDER BY p_partkey % 2, p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def snk_insert_first_wins(spark, sf):
    root = scratch_dir(spark, "firstwins")
    p = table(spark, sf, "part").select("p_name", "p_partkey", "p_brand")
    for half in (0, 1):
        insert_first_wins(p.filter(F.col("p_partkey") % 2 == half), root, ["p_name"], ["p_partkey"])
    return read_current(spark, root)


@exercise(
    "snk_upsert",
    """SELECT o_custkey, first_status, last_priority FROM (
         SELECT o_custkey, first_value(o_orderstatus) OVER f AS first_status, first_value(o_orderpriority) OVER l AS last_priority,
                row_number() OVER f AS rn FROM orders
         WINDOW f AS (PARTITION BY o_custkey ORDER BY o_orderkey % 2, o_orderdate, o_orderkey),
                l AS (PARTITION BY o_custkey ORDER BY o_orderkey % 2 DESC, o_orderdate DESC, o_orderkey DESC)) WHERE rn = 1""",
)
def snk_upsert(spark, sf):
    root = scratch_dir(spark, "upsert")
    o = table(spark, sf, "orders").select(
        "o_custkey", F.col("o_orderstatus").alias("first_status"), F.col("o_orderpriority").alias("last_priority"),
        "o_orderdate", "o_orderkey",
    )
    for half in (0, 1):
        batch = o.filter(F.col("o_orderkey") % 2 == half)
        upsert(batch, root, ["o_custkey"], ["last_priority"], ["o_orderdate", "o_orderkey"], buckets=8)
    return read_current(spark, root)


@exercise(
    "snk_last_wins",
    """SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER
         (PARTITION BY user_id, event_type ORDER BY event_id % 2 DESC, ts DESC) AS rn FROM events) WHERE rn = 1""",
)
def snk_last_wins(spark, sf):
    root = scratch_dir(spark, "lastwins")
    e = table(spark, sf, "events")
    for half in (0, 1):
        batch = e.filter(F.col("event_id") % 2 == half)
        write_last_wins(batch, root, ["user_id", "event_type"], ["ts"], ["user_id", "event_type", "value"], buckets=8)
    return read_current(spark, root)


# -- tables -------------------------------------------------------------------


@exercise(
    "ddl_reset_and_insert",
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
)
def ddl_reset_and_insert(spark, sf):
    """A catalog table dropped, created from its contract, filled in contract order and dropped again."""
    root = scratch_dir(spark, "ddl")
    contract = TableContract(
        "starmart_orders",
        {"year": "int", "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string"},
        partition_by=["year"],
    )
    reset(spark, [contract], root)
    insert_into(table(spark, sf, "orders").withColumn("year", F.year("o_orderdate")), contract)
    rows = in_order(spark.table(contract.name), contract)
    path = f"{root}/{contract.name}"
    drop_table(spark, contract.name)  # the files of the external location stay
    return spark.read.schema(rows.schema).parquet(path)


@exercise(
    "ddl_views",
    "SELECT o_orderstatus, count(*) AS n_orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1",
)
def ddl_views(spark, sf):
    register_views({"v_orders": table(spark, sf, "orders"), "v_customer": table(spark, sf, "customer")})
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n_orders FROM v_orders JOIN v_customer ON o_custkey = c_custkey GROUP BY 1"
    )


@exercise("src_line_count", "SELECT count(*) AS n_lines FROM orders")
def src_line_count(spark, sf):
    root = scratch_dir(spark, "lines")
    table(spark, sf, "orders").select("o_orderkey", "o_totalprice").write.json(root)
    return line_count(spark, root)


_PATHS_SQL = ", ".join(STAGED_EVENTS.columns)


@exercise("src_staged_events", f"{_MUSIC_LOG} SELECT {_PATHS_SQL} FROM log")
def src_staged_events(spark, sf):
    """The log's JSON files loaded through the event path list into the staging contract."""
    root = scratch_dir(spark, "staged")
    inputs.raw_log(spark, sf).write.json(root)
    return read_json_paths(spark, root, EVENT_PATHS, STAGED_EVENTS)


@exercise("src_parquet_csv_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_parquet_csv_columns(spark, sf):
    """A CSV read under a full schema, in column order."""
    root = scratch_dir(spark, "typed")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    c.write.option("header", True).csv(root)
    return read_csv_files(spark, root, c.schema)
