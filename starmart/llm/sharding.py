"""Placing documents on shards by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a prime-sized table: ``(offset + j * skip) mod size``,
with offset and skip hashed from its name. Shards take turns, each claiming the first slot of its order that is
still free, until the table is full. A document's key hashes to a slot, and the slot names the shard. Shards get
equal shares of the slots within one, and a shard that leaves or joins moves few slots of the others.

The table is as large as its parameter says whatever the input, so it is broadcast; a document is placed by one
lookup and no document is shuffled.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:03d}" for i in range(32))
#: A prime, over a hundred times the shards.
TABLE_SIZE = 4099
MAX_TABLE_SIZE = 1_000_003


def fill_table(shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """The slot table: for each slot the position of its shard in ``shards``.

    ``size`` must be a prime (every skip then visits every slot), at least the number of shards and at most a
    million, which bounds what is broadcast. Shard names must differ. No shards: ValueError.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be named, each once")
    if not len(shards) <= size <= MAX_TABLE_SIZE or size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size must be a prime from the number of shards to {MAX_TABLE_SIZE}")
    digests = [md5(s.encode()).hexdigest() for s in shards]
    at = [int(d[:12], 16) % size for d in digests]
    skip = [int(d[12:24], 16) % (size - 1) + 1 for d in digests]
    table, free, turn = [-1] * size, size, 0
    while free:
        slot = at[turn]
        while table[slot] >= 0:
            slot = (slot + skip[turn]) % size
        table[slot] = turn
        at[turn], free, turn = (slot + skip[turn]) % size, free - 1, (turn + 1) % len(shards)
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key: the leading 48 bits of the md5 of its text, modulo the table size."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 12), 16, 10).cast("long") % size).cast("int")


def table_frame(spark: SparkSession, shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> DataFrame:
    """The table as rows ``(slot, shard_no, shard)``, made from one literal so that no task runs Python."""
    cells = F.split(F.lit(",".join(map(str, fill_table(shards, size)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    row = spark.range(1).select(F.posexplode(cells).alias("slot", "cell"))
    return row.select("slot", F.col("cell").cast("int").alias("shard_no")).withColumn(
        "shard", F.element_at(names, F.col("shard_no") + 1)
    )


def place(docs: DataFrame, shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE, key: str = "doc_id") -> DataFrame:
    """Add ``slot int, shard_no int, shard string``; every row stays, no row moves.

    Rows with equal keys go to one shard. A null key is spread by the row's text (or the empty text, if that is
    null or missing): rows without a key may be many. Columns of the input named like the added ones are
    replaced. An empty input gives an empty result.
    """
    spare = F.coalesce(F.col("text"), F.lit("")) if "text" in docs.columns else F.lit("")
    named = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("t"), spare))
    table = table_frame(docs.sparkSession, shards, size)
    kept = docs.drop("slot", "shard_no", "shard").withColumn("slot", slot_of(named, size))
    return kept.join(F.broadcast(table), "slot").select(*kept.columns, "shard_no", "shard")
