"""Top N items within every group, by lower bounds of the partitions.

One pass trims every partition to its own N best distinct items of each group.  The N-th of
them is a lower bound for the group, since N items of the whole group are at least as good.
The best bound of each group is joined to the trimmed rows, rows below it are dropped, and the
few survivors are ranked.  A group with millions of items thus sends at most N rows from each
partition.

Order: score descending, then item ascending by its UTF-8 bytes.  An item that comes several times in a
group counts once, with its highest score.  Rows with a null group, item or score, or a NaN
score, are left out; the empty string is an item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.scratch import save

HELD_ROWS = 500_000


def _best(t: pa.Table, n: int) -> tuple[pa.Table, np.ndarray]:
    """The n best distinct items of each group and their ranks from 0."""
    t = t.take(pc.sort_indices(t, [("grp", "ascending"), ("item", "ascending"), ("score", "descending")])).combine_chunks()
    if not t.num_rows:
        return t, np.zeros(0, np.int64)

    def changes(name: str) -> np.ndarray:
        c = t[name]
        return np.concatenate(([True], pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)))

    t = t.filter(pa.array(changes("grp") | changes("item")))
    t = t.take(pc.sort_indices(t, [("grp", "ascending"), ("score", "descending"), ("item", "ascending")])).combine_chunks()
    start = np.flatnonzero(changes("grp"))
    rank = np.arange(t.num_rows) - np.repeat(start, np.diff(np.append(start, t.num_rows)))
    return t.filter(pa.array(rank < n)), rank[rank < n]


def _trim(n: int):
    """Task: its best rows, holding about HELD_ROWS at most. Where groups are smaller than n, or many, trimming frees little: what is held is then sent with its own bounds, which are valid, if lower."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows > HELD_ROWS:
                kept, rank = _best(pa.Table.from_batches(held), n)
                held, rows = kept.to_batches(), kept.num_rows
                if rows > HELD_ROWS // 2:
                    yield from _bounded(kept, rank, n)
                    held, rows = [], 0
        if held:
            yield from _bounded(*_best(pa.Table.from_batches(held), n), n)

    return run


def _bounded(kept: pa.Table, rank: np.ndarray, n: int) -> list[pa.RecordBatch]:
    return kept.append_column("bounds", pa.array(rank == n - 1)).to_batches()


def top_n(df: DataFrame, group: str, item: str, score: str, n: int) -> DataFrame:
    """(grp, item, score, rank): the n best items of every group, ranks from 1."""
    if n < 1:
        raise ValueError("n must be positive")
    rows = df.select(F.col(group).alias("grp"), F.col(item).alias("item"), F.col(score).alias("score")).where("grp IS NOT NULL AND item IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)")
    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    trimmed = save(rows.mapInArrow(_trim(n), f"{kinds}, bounds boolean"), "trimmed")
    bounds = trimmed.where("bounds").groupBy("grp").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("item").alias("i"))).alias("bound"))
    reach = F.struct((-F.col("score")).alias("s"), F.col("item").alias("i")) <= F.col("bound")
    survivors = trimmed.join(bounds, "grp", "left").where(F.col("bound").isNull() | reach).groupBy("grp", "item").agg(F.max("score").alias("score"))
    order = Window.partitionBy("grp").orderBy(F.col("score").desc(), F.col("item").asc())
    return survivors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
