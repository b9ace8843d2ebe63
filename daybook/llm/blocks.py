"""Pair work inside groups of any size, in bounded pieces.

A group of ``n`` rows is dealt into ``ceil(n / block_rows)`` blocks by a hash of the id, and
every pair of blocks is a piece of its own: whatever the group's size, no task holds more
than about ``2 * block_rows`` of its rows at a time, and no pair of rows is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spread(rows: DataFrame, key: list[str], size: str, id_col: str, block_rows: int) -> DataFrame:
    """``rows`` with the size of their group in ``size``, once for each piece they belong
    to, dealt out by piece and sorted. Adds ``_i, _j`` (the piece) and ``_b`` (the row's own
    block: within a piece with ``_i = _j`` all pairs count, else those across blocks)."""
    n = F.ceil(F.col(size) / F.lit(block_rows)).cast("int")
    r = rows.withColumn("_n", n).withColumn("_b", F.pmod(F.xxhash64(F.col(id_col)), F.col("_n")).cast("int"))
    r = r.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    r = r.withColumn("_i", F.least("_b", "_k")).withColumn("_j", F.greatest("_b", "_k")).drop("_k", "_n")
    piece = [*key, "_i", "_j"]
    return r.repartition(*piece).sortWithinPartitions(*piece)


def pieces(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The consecutive runs of rows with equal ``key`` in sorted record batches, each whole."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([*held, batch]).combine_chunks()
        change = np.zeros(t.num_rows - 1, dtype=bool)
        for k in [*key, "_i", "_j"]:
            v = t.column(k).to_numpy()
            change |= v[1:] != v[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield t.slice(a, b - a)
        held = t.slice(cuts[-1]).to_batches()
    if held:
        yield pa.Table.from_batches(held)
