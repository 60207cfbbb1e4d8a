"""The scheduled load as an incremental one: each run takes only the event files that are new.

Structured Streaming keeps the list of files already taken in its checkpoint. A run
processes what is there and stops (``availableNow``), which fits an hourly schedule. A
batch that is repeated after a failure adds nothing, since its plays replace those with their keys.

Lines are read as text and cast under the contract like those of the batch load, so a line that is not JSON or a value
that does not parse is set aside with its reason, never lost or loaded as null. Events that were delivered before are
dropped by state kept for a time after their arrival; a replay later than that meets its own plays in the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starmart.contracts import EVENT_PATHS, STAGED_EVENTS, clean, split_rows
from starmart.operators.filters import plays_of
from starmart.plans.music import songplays_rounded, users_latest
from starmart.session import stage
from starmart.sinks.loads import replace_by_key, replace_run, upsert
from starmart.sources.files import CORRUPT, text_schema

_SEEN, _ARRIVED = "_line", "_arrived"


def text_stream(spark: SparkSession, folder: str, pattern: str = "*.json") -> DataFrame:
    """New event files below a folder, as a stream of text columns under their staged names; a line that is not
    JSON is kept as it is."""
    schema = text_schema(list(EVENT_PATHS)).add(CORRUPT, "string")
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("columnNameOfCorruptRecord", CORRUPT)
    raw = reader.option("recursiveFileLookup", True).json(folder)
    named = raw.select(*[F.col(path).alias(column) for path, column in EVENT_PATHS.items()], CORRUPT)
    return clean(named, STAGED_EVENTS)


def without_replays(lines: DataFrame, horizon: str) -> DataFrame:
    """The stream without lines equal to one that arrived within the horizon before.

    The watermark is on the time of arrival, which only goes forward: no event is ever too late, however old it is.
    The state holds 128 bits for each line of the horizon.
    """
    columns = lines.columns
    marked = lines.withColumn(_SEEN, F.md5(F.to_json(F.struct(*columns)))).withColumn(_ARRIVED, F.current_timestamp())
    return marked.withWatermark(_ARRIVED, horizon).dropDuplicatesWithinWatermark([_SEEN]).select(*columns)


def load_new_events(
    spark: SparkSession,
    folder: str,
    songs: DataFrame,
    root: str,
    checkpoint: str,
    action: str = "NextSong",
    horizon: str = "7 days",
    buckets: int | None = None,
    pattern: str = "*.json",
) -> StreamingQuery:
    """Load the plays of all new event files into ``songplays`` and ``users`` under ``root``, then stop.

    Lines and values that do not parse go to ``rejects/stream`` with their ``reject_reason``, each batch's once.
    ``checkpoint`` belongs in storage that outlives the run. Events equal to one that arrived within ``horizon`` are
    dropped. ``buckets`` lays new tables out by their keys, so that a batch rewrites only what it meets.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        good, rejects = split_rows(stage(batch, "lines"), STAGED_EVENTS, record=CORRUPT)  # parsed once
        replace_run(rejects, f"{root}/rejects/stream", f"batch={batch_id}")
        plays = stage(plays_of(good, action), "plays")
        replace_by_key(songplays_rounded(plays, songs, key="wide"), f"{root}/songplays", ["songplay_id"], buckets)
        known = plays.select("user_id", "first_name", "last_name", "gender", "level", "ts", "item_in_session")
        users = users_latest(known, ["ts", "item_in_session"]).withColumn("_batch", F.lit(batch_id))
        upsert(users, f"{root}/users", ["user_id"], ["level"], ["_batch"], buckets)

    lines = without_replays(text_stream(spark, folder, pattern), horizon)
    writer = lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
