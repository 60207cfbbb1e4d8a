"""Writers and load policies."""

from starmart.sinks.loads import (
    append,
    append_new,
    current_version,
    insert_first_wins,
    insert_numbered,
    read_current,
    truncate_insert,
    upsert,
    write_last_wins,
)
from starmart.sinks.files import write_clustered, write_parquet, write_quoted_csv, write_songs
from starmart.sinks.folders import read_folders

__all__ = [
    "append",
    "append_new",
    "current_version",
    "insert_first_wins",
    "insert_numbered",
    "read_current",
    "read_folders",
    "truncate_insert",
    "upsert",
    "write_clustered",
    "write_last_wins",
    "write_parquet",
    "write_quoted_csv",
    "write_songs",
]
