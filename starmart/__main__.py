"""Command line: ``spark-submit`` or ``python -m starmart <run> ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starmart.plans import runs
from starmart.session import configure


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="starmart", description="Build a star-schema mart.")
    commands = top.add_subparsers(dest="run", required=True)
    for name in ("relational", "warehouse", "lake", "scheduled"):
        c = commands.add_parser(name)
        c.add_argument("--events", nargs="+", required=True, help="JSON paths; scheduled runs may use {year} and the like")
        c.add_argument("--songs", nargs="+", required=True)
        c.add_argument("--out", required=True)
        c.add_argument("--action", default="NextSong")
        if name in ("relational", "lake"):
            c.add_argument("--order", nargs="+", default=["ts", "session_id", "item_in_session"])
        if name == "scheduled":
            c.add_argument("--run", dest="run_values", nargs="*", default=[], metavar="NAME=NUMBER", help="values for the path templates")
    c = commands.add_parser("query-tables")
    c.add_argument("--events", nargs="+", required=True, help="CSV paths")
    c.add_argument("--out", required=True)
    c.add_argument("--order", nargs="*", default=[])
    c = commands.add_parser("immigration")
    c.add_argument("--records", nargs="+", required=True)
    c.add_argument("--temperatures", required=True)
    c.add_argument("--cities", required=True)
    c.add_argument("--labels", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"starmart {a.run}").getOrCreate())
    if a.run == "relational":
        runs.run_relational(spark, a.events, a.songs, a.out, a.order, a.action)
    elif a.run == "warehouse":
        runs.run_warehouse(spark, a.events, a.songs, a.out, a.action)
    elif a.run == "lake":
        runs.run_lake(spark, a.events, a.songs, a.out, a.order, a.action)
    elif a.run == "scheduled":
        context = {k: int(v) for k, v in (pair.split("=", 1) for pair in a.run_values)}
        runs.run_scheduled(spark, a.events, a.songs, a.out, context, action=a.action).show(truncate=False)
    elif a.run == "query-tables":
        runs.run_query_tables(spark, a.events, a.out, a.order)
    else:
        runs.run_immigration(spark, a.records, a.temperatures, a.cities, a.labels, a.out, a.format).show(truncate=False)


if __name__ == "__main__":
    main()
