"""Mixing sources to target weights by iterative proportional fitting.

Every document belongs to a cell: its source, its language and its topic. The tokens of the cells are raked until the
shares of all three marginals are the wanted ones; a cell's raked tokens over its own tokens is the weight of its
documents. Documents are then sampled with probabilities in proportion to their weights, scaled so that the expected
tokens are the wanted part of all, and decided by a hash of the document, so that a rerun keeps the same ones.

Tokens are counted where the texts are, and summed by cell before anything is shuffled. Up to ``MAX_CELLS`` cells are
raked as one array, more as a table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from starmart.session import stage

TOPICS = 8
#: Words from this length on, in bytes, speak for a topic.
TOPIC_WORD = 6
SWEEPS, TOLERANCE = 50, 1e-9
#: Cells that are raked as one array on the driver (some 100 bytes each).
MAX_CELLS = 200_000
#: The wanted part of all tokens.
KEEP = 0.7
#: Targets between the shares as they are (1) and equal shares (0).
TEMPER = 0.7
MARGINALS = ("source", "lang", "topic")
NONE = "(none)"


def profile(raw: bytes) -> tuple[int, int]:
    """Tokens (words between blanks) and topic of a text: the hash class most of its longer words fall into, the
    first of several; class 0 without longer words."""
    words = raw.split()
    votes = np.bincount([zlib.crc32(w) % TOPICS for w in words if len(w) >= TOPIC_WORD] or [0], minlength=TOPICS)
    return len(words), int(votes.argmax())


def profiled(docs: DataFrame) -> DataFrame:
    """The input and ``n_tokens long, topic int`` (columns of these names are replaced)."""
    docs = docs.drop("n_tokens", "topic")
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profile(x or b"") for x in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int32())],
                names=[*batch.schema.names, "n_tokens", "topic"],
            )

    return docs.mapInArrow(run, StructType(list(docs.schema.fields)).add("n_tokens", LongType()).add("topic", IntegerType()))


def tempered(cells: pd.DataFrame, by: str, power: float = TEMPER) -> dict:
    """Target shares of a marginal: its token shares to a power, so that large values give way to small ones."""
    share = cells.groupby(by)["tokens"].sum()
    share = (share / max(share.sum(), 1)) ** power * (share > 0)
    return (share / max(share.sum(), 1e-300)).to_dict()


def rake(cells: pd.DataFrame, targets: dict[str, dict], sweeps: int = SWEEPS, tolerance: float = TOLERANCE) -> np.ndarray:
    """Raked tokens of the cells (columns of ``MARGINALS`` and ``tokens``).

    Each sweep scales the cells to every marginal in turn, until no factor differs from 1 by more than
    ``tolerance``. A target of a value without tokens cannot be met and is left out, the others share its part; a
    value without a target counts as target 0. The sum of all tokens stays.
    """
    total = float(cells["tokens"].sum())
    raked = cells["tokens"].to_numpy(float).copy()
    codes, wanted = [], []
    for by, target in targets.items():
        code, values = pd.factorize(cells[by])
        have = np.bincount(code, raked, len(values)) > 0
        want = np.array([target.get(v, 0.0) for v in values]) * have
        codes.append(code)
        wanted.append(want / max(want.sum(), 1e-300) * total)
    for _ in range(sweeps):
        off = 0.0
        for code, want in zip(codes, wanted):
            have = np.bincount(code, raked, len(want))
            factor = np.divide(want, have, out=np.ones(len(want)), where=have > 0)
            raked *= factor[code]
            off = max(off, float(np.abs(factor[have > 0] - 1).max(initial=0)))
        if off <= tolerance:
            break
    return raked


def calibrated(tokens: np.ndarray, raked: np.ndarray, keep: float = KEEP) -> np.ndarray:
    """Probabilities in proportion to ``raked / tokens``, at most 1, whose expected tokens are ``keep`` of all.

    Cells that would pass 1 are certain, and the others make up for them; if all cells with weight are certain, that
    is all there is.
    """
    weight = np.divide(raked, tokens, out=np.zeros(len(tokens)), where=tokens > 0)
    goal, sure = keep * tokens.sum(), np.zeros(len(tokens), bool)
    p = np.zeros(len(tokens))
    for _ in range(len(tokens) + 1):
        open_ = ~sure & (weight > 0)
        mass = (weight * tokens)[open_].sum()
        scale = (goal - tokens[sure].sum()) / mass if mass > 0 else 0.0
        p = np.where(sure, 1.0, np.clip(weight * max(scale, 0.0), 0, None))
        over = open_ & (p > 1)
        if not over.any():
            break
        sure |= over
    return np.minimum(p, 1.0)


def _values(docs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NONE)) if c in docs.columns else F.lit(NONE)
    return docs.withColumns({f"_{m}": text(m) for m in MARGINALS})


def _rake_table(
    cells: DataFrame, power: float, keep: float, targets: dict[str, dict] | None = None, sweeps: int = SWEEPS, tolerance: float = TOLERANCE
) -> DataFrame:
    """``rake`` and ``calibrated`` for more cells than the driver should hold: the same steps, sweeps and stopping
    rule as joins of the cells with their marginal sums, written to the shared folder after each sweep."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    wanted = {}
    for m in targets or MARGINALS:
        sums = cells.groupBy(f"_{m}").agg(F.sum("tokens").alias("t")).filter("t > 0")
        if targets:
            given = spark.createDataFrame([(str(v), float(x)) for v, x in targets[m].items()], f"_{m} string, share double")
            sums = sums.join(given, f"_{m}", "left").select(f"_{m}", F.coalesce("share", F.lit(0.0)).alias("w"))
        else:
            sums = sums.select(f"_{m}", F.pow(F.col("t") / total, F.lit(power)).alias("w"))
        norm = max(float(sums.agg(F.sum("w")).first()[0] or 0), 1e-300)
        wanted[f"_{m}"] = stage(sums.select(f"_{m}", (F.col("w") / norm * total).alias("want")), "targets")
    now = cells.withColumn("raked", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        now = now.withColumn("off", F.lit(0.0))
        for m, want in wanted.items():
            have = now.groupBy(m).agg(F.sum("raked").alias("have"))
            factor = have.filter("have > 0").join(want, m).select(m, (F.col("want") / F.col("have")).alias("factor"))
            now = now.join(factor, m, "left").withColumns({
                "raked": F.col("raked") * F.coalesce("factor", F.lit(1.0)), "off": F.greatest("off", F.abs(F.col("factor") - 1)),
            }).drop("factor")
        now = stage(now, "raked")
        if float(now.agg(F.max("off")).first()[0] or 0) <= tolerance:
            break
    now = now.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") / F.col("tokens")).otherwise(0.0))
    mass = float(now.agg(F.sum("raked")).first()[0] or 0)
    scale, certain = (keep * total / mass if mass > 0 else 0.0), 0
    while True:  # the certain cells only grow
        over = F.col("weight") * F.lit(scale) > 1
        s = now.agg(F.sum(F.when(over, F.col("tokens"))).alias("sure"), F.sum(F.when(~over, F.col("raked"))).alias("open")).first()
        sure, open_ = s["sure"] or 0, float(s["open"] or 0)
        if sure <= certain:
            break
        certain, scale = sure, (keep * total - sure) / open_ if open_ > 0 else scale
    return now.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * F.lit(scale)))


def weights(profiled_docs: DataFrame, keep: float = KEEP, power: float = TEMPER, targets: dict[str, dict] | None = None, max_cells: int = MAX_CELLS) -> tuple[DataFrame, bool]:
    """One row per cell (``_source, _lang, _topic, weight, probability``), and whether its size is under the bound."""
    spark = profiled_docs.sparkSession
    names = [f"_{m}" for m in MARGINALS]
    cells = stage(_values(profiled_docs).groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "cells")
    if cells.count() > max_cells:
        return _rake_table(cells, power, keep, targets).select(*names, "weight", "probability"), False
    local = cells.toPandas().rename(columns={f"_{m}": m for m in MARGINALS}).sort_values(list(MARGINALS)).reset_index(drop=True)
    if local.empty:
        return spark.createDataFrame([], "_source string, _lang string, _topic string, weight double, probability double"), True
    goals = targets or {m: tempered(local, m, power) for m in MARGINALS}
    raked, tokens = rake(local, goals), local["tokens"].to_numpy(float)
    p = calibrated(tokens, raked, keep)
    weight = np.divide(raked, tokens, out=np.zeros(len(tokens)), where=tokens > 0)
    rows = [(*map(str, r), float(w), float(q)) for r, w, q in zip(local[list(MARGINALS)].itertuples(index=False), weight, p)]
    return spark.createDataFrame(rows, "_source string, _lang string, _topic string, weight double, probability double"), True


def mix(docs: DataFrame, keep: float = KEEP, power: float = TEMPER, targets: dict[str, dict] | None = None, max_cells: int = MAX_CELLS) -> DataFrame:
    """The input and ``n_tokens long, topic int, weight double, probability double, kept boolean`` for every row.

    Targets are given as shares by marginal, or else are the corpus's own shares tempered by ``power``. A null
    source or language is a value of its own. Texts without words have no tokens: in a cell with others they share
    its probability, in one without tokens their weight and probability are 0. The draw hashes ``doc_id`` and text,
    so equal rows are kept or dropped together. Columns of the added names are replaced, all others kept. No rows in, no
    rows out.
    """
    # input columns with the names of the cells' columns step aside
    aside = {c: f"{c}{'_' * max(map(len, docs.columns))}" for c in docs.columns if c.lower() in {f"_{m}" for m in MARGINALS}}
    base = profiled(docs.drop("weight", "probability", "kept").withColumnsRenamed(aside))
    cells, small = weights(base, keep, power, targets, max_cells)
    names = [f"_{m}" for m in MARGINALS]
    out = _values(base).join(F.broadcast(cells) if small else cells, names)
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("mix")), F.lit(1 << 40)) / float(1 << 40)
    out = out.withColumn("kept", draw < F.col("probability")).drop(*names)
    return out.withColumnsRenamed({there: here for here, there in aside.items()})
