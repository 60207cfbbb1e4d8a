"""What the corpus operators share: table access, batch sizes, tokenizing constants and small SQL helpers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import input_bytes

#: What the optimizer says of a frame whose size it does not know, or more.
_UNKNOWN_BYTES = 1 << 60
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
DOC_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows of an Arrow batch: whole texts travel in it, so fewer than Spark's default.
BATCH_ROWS = 1_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, with Arrow batches small enough for whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the ids that no model learns from (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def partitions(df: DataFrame, bytes_each: int = 16 << 20) -> int:
    """A number of shuffle partitions by the size of the files a frame reads, the session's own at least."""
    size = input_bytes(df)
    known = size if size < _UNKNOWN_BYTES else 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // bytes_each))


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer over an array: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
