"""

Prints one JSON line. Every query writes all its rows to the no-op sink; a figure is the
median of three runs after one warm-up. Before the first query some others run, so that it does not pay for compiling
what all use. ``shuffled`` are joins with broadcasts off, as large tables would have them.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.exercises import QUERIES, inputs
from starmart.exercises.registry import table
from starmart.operators.checks import TableCheck, run_checks
from starmart.operators.filters import plays_of
from starmart.operators.numbering import dense_id
from starmart.plans import music
from starmart.session import local_session, scratch_dir, stage

HEADLINE = [
    "play_filter", "epoch_timestamps", "time_dim_monday0", "dim_distinct", "dim_first_wins", "dim_scd1_upsert",
    "dim_scd1_merge", "keyed_last_write", "append_new_only", "count_by_10", "avg_by_group_since", "quality_report",
    "fact_left_join_2key", "fact_lookup_top1", "fact_lookup_exact", "fact_left_join_decimal0", "fact_not_null_inner",
    "balanced_join_hot_key", "two_role_lookup", "two_role_filter", "lookup_using_not_null", "dense_id", "md5_key",
    "cast_good", "cast_rejects", "blank_to_null", "src_label_catalogue", "items_by_session", "users_by_song",
    "relational_users", "relational_songplays", "warehouse_songplays", "lake_songplays", "scheduled_songplays",
    "immigration_fact", "us_cities_dim", "temperature_dim", "snk_upsert", "snk_append_new_twice", "src_json_rejects",
    "run_scheduled_twice", "run_lake_load", "balanced_join_timestamp_key", "run_scheduled_backfill", "snk_append_new_months",
    "immigration_fact_incremental", "lookup_by_bloom_filter",
]
#: The first 37 have been timed since the first round.
SINCE_FIRST = 37
WARM_UP = ["dim_distinct", "fact_lookup_top1", "relational_songplays", "dense_id", "snk_upsert", "quality_report"]
SHUFFLED = [
    "fact_left_join_2key", "fact_lookup_top1", "fact_left_join_decimal0", "lookup_using_not_null", "relational_songplays",
    "lake_songplays", "scheduled_songplays",
]
RUNS = 3


def write(df):
    df.write.format("noop").mode("overwrite").save()


# -- pairs: the naive form and ours --------------------------------------------


def naive_epoch(spark, sf):
    to_time = F.udf(lambda ms: datetime.fromtimestamp(ms / 1000.0, timezone.utc), T.TimestampType())
    ms = table(spark, sf, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    write(ms.withColumn("timestamp", to_time("ms")))


def our_epoch(spark, sf):
    ms = table(spark, sf, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    write(ms.withColumn("timestamp", F.timestamp_millis("ms")))


def naive_dense(spark, sf):
    l = table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    write(l.selectExpr("row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_partkey, l_suppkey) AS id", "*"))


def our_dense(spark, sf):
    l = table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice")
    write(dense_id(l, ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey"], "id"))


def naive_lookup(spark, sf):
    write(QUERIES["fact_left_join_2key"](spark, sf))


def our_lookup(spark, sf):
    write(QUERIES["fact_lookup_top1"](spark, sf))


MART = {
    "songs": lambda plays, songs: music.songs_distinct(songs),
    "artists": lambda plays, songs: music.artists_distinct(songs),
    "users": lambda plays, songs: music.users_distinct(plays),
    "time": lambda plays, songs: music.time_with_epoch(plays),
    "songplays": lambda plays, songs: music.songplays_rounded(plays, songs),
}


def naive_tables(spark, sf):
    """Each table of a mart from the raw JSON, schema inferred, as separate scans."""
    log_path, songs_path, _, _ = _raw(spark, sf)
    log, songs = spark.read.json(log_path), spark.read.json(songs_path)
    for build in MART.values():
        write(build(plays_of(log), songs))


def our_tables(spark, sf):
    """The raw JSON parsed once under a schema; the plays, with the columns the mart needs, staged as Parquet."""
    log_path, songs_path, log_schema, songs_schema = _raw(spark, sf)
    needed = [*music.USER_COLUMNS, "ts", "song", "artist", "length", "session_id", "item_in_session", "location", "user_agent"]
    plays = stage(plays_of(spark.read.schema(log_schema).json(log_path)).select(*needed), "plays")
    songs = stage(spark.read.schema(songs_schema).json(songs_path), "songs")
    for build in MART.values():
        write(build(plays, songs))


_RAW: dict[str, tuple] = {}


def _raw(spark, sf):
    if sf not in _RAW:
        root = scratch_dir(spark, "benchraw")
        log, songs = inputs.log(spark, sf), inputs.songs(spark, sf)
        log.write.json(f"{root}/log")
        songs.write.json(f"{root}/songs")
        _RAW[sf] = (f"{root}/log", f"{root}/songs", log.schema, songs.schema)
    return _RAW[sf]


CHECKED = {"orders": ["o_custkey", "o_orderdate"], "customer": ["c_name"], "part": ["p_name"], "lineitem": ["l_partkey"]}


def naive_checks(spark, sf):
    for t, cols in CHECKED.items():
        df = table(spark, sf, t)
        df.count()
        for c in cols:
            df.filter(F.col(c).isNull()).count()


def our_checks(spark, sf):
    tables = {t: table(spark, sf, t) for t in CHECKED}
    run_checks(tables, [TableCheck(t, cols) for t, cols in CHECKED.items()]).collect()


PAIRS = {
    "epoch_to_timestamp": (naive_epoch, our_epoch),
    "dense_id": (naive_dense, our_dense),
    "song_lookup": (naive_lookup, our_lookup),
    "multi_table_run": (naive_tables, our_tables),
    "quality_checks": (naive_checks, our_checks),
}


def timed(fn) -> float:
    fn()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        fn()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    spark = local_session(cpus, partitions=cpus)
    for name in WARM_UP * 2:
        write(QUERIES[name](spark, sf))
    queries = {n: timed(lambda n=n: write(QUERIES[n](spark, sf))) for n in HEADLINE if not only or n in only}
    pairs = {
        n: {"naive": timed(lambda f=a: f(spark, sf)), "ours": timed(lambda f=b: f(spark, sf))}
        for n, (a, b) in PAIRS.items()
        if not only or n in only
    }
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in thresholds:
        spark.conf.set(key, "-1")
    shuffled = {n: timed(lambda n=n: write(QUERIES[n](spark, sf))) for n in SHUFFLED if not only or n in only}
    for key in thresholds:
        spark.conf.unset(key)
    print(
        json.dumps(
            {
                "metric": "total seconds over the headline queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "since_first_round": round(sum(queries[n] for n in HEADLINE[:SINCE_FIRST] if n in queries), 3),
                "shuffled": shuffled,
                "pairs": pairs,
                "sf": os.path.basename(sf.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
