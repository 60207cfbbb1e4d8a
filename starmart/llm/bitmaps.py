"""Sets of 64-bit hashes as bitmaps of a bounded size: false positives, no false negatives."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import mix64

#: A bitmap has 16 bits an entry, but 32 MB at most: a fuller one lets more pass.
BITS_EACH, MOST_BITS = 16, 1 << 28


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    m = mix64(h.view(np.uint64))
    return m & np.uint64(bits - 1), (m >> np.uint64(32)) & np.uint64(bits - 1)


class Bitmap:
    """Two bits a hash; the number of bits is a power of two."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for at in _places(h, len(self.words) * 64):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def bitmap(hashes: DataFrame) -> Bitmap:
    """The bitmap of a frame's column ``h`` (long): built by the executors, ``MOST_BITS`` at most reach the driver."""
    bits = min(MOST_BITS, 1 << max(10, (BITS_EACH * max(hashes.count(), 1) - 1).bit_length()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_places(batch.column(0).to_numpy(), bits))
            cell, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            order = np.argsort(cell, kind="stable")
            cell, first = np.unique(cell[order], return_index=True)
            if len(cell):
                ored = np.bitwise_or.reduceat(bit[order], first)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(ored.view(np.int64))], names=["cell", "bits"])

    cells = hashes.select("h").mapInArrow(run, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[cells["cell"].to_numpy(np.int64)] = cells["bits"].to_numpy(np.int64).view(np.uint64)
    return Bitmap(words)
