"""Most frequent items in bounded memory: a majority-vote sketch, and exact counts of what it names.

The sketch has ``ROWS`` rows of ``width`` cells for each key (a language, say).  A cell holds
the total of its items, a candidate and the candidate's surplus of votes.  Cells of several
tasks merge by vote cancellation: totals and the surpluses of each candidate add up, and the
strongest candidate keeps what it has more than all others together.  An item's count is at
most (total + surplus) / 2 where it is the candidate, (total - surplus) / 2 elsewhere, and at
least its surplus.

A second pass counts exactly the candidates whose upper bound reaches the threshold, and any
item none of whose cells rules it out, so the result is whole whatever the hashes do.

Null items aren't counted; a null key is a key of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.strings import hashes
from lexmill.scratch import save

ROWS = 4
MOST_KEYS = 1000
U64 = np.uint64


def _cells(h: np.ndarray, width: int) -> np.ndarray:
    """[row, item]: the cell of each item; four 16-bit fields of the hash."""
    return np.stack([((h >> U64(16 * r)) & U64(0xFFFF)).astype(np.int64) * width >> 16 for r in range(ROWS)])


@dataclass
class Sketch:
    width: int

    def __post_init__(self):
        self.total = np.zeros((ROWS, self.width), np.int64)
        self.surplus = np.zeros((ROWS, self.width), np.int64)
        self.candidate = np.zeros((ROWS, self.width), U64)
        self.names: dict[int, str] = {}

    def add(self, names: pa.Array, count: np.ndarray) -> None:
        """Votes of distinct items; each row takes them, with what it holds, in one cancellation."""
        h = hashes(names)
        cells = _cells(h, self.width)
        for r in range(ROWS):
            self.total[r] += np.bincount(cells[r], weights=count, minlength=self.width).astype(np.int64)
            held = np.flatnonzero(self.surplus[r])
            cell = np.concatenate((cells[r], held))
            who = np.concatenate((h, self.candidate[r][held]))
            votes = np.concatenate((count, self.surplus[r][held]))
            order = np.lexsort((who, cell))
            cell, who, votes = cell[order], who[order], votes[order]
            first = np.flatnonzero(np.concatenate(([True], (cell[1:] != cell[:-1]) | (who[1:] != who[:-1]))))
            votes, cell, who = np.add.reduceat(votes, first), cell[first], who[first]
            order = np.lexsort((who, votes, cell))
            cell, who, votes = cell[order], who[order], votes[order]
            best = np.flatnonzero(np.concatenate((cell[1:] != cell[:-1], [True])))
            every = np.bincount(cell, weights=votes, minlength=self.width).astype(np.int64)
            at = cell[best]
            self.candidate[r][at] = who[best]
            self.surplus[r][at] = np.maximum(2 * votes[best] - every[at], 0)
        live = set(self.candidate.ravel().tolist())
        self.names = {k: v for k, v in self.names.items() if k in live}
        for i in np.flatnonzero(np.isin(h, self.candidate.ravel())):
            self.names[int(h[i])] = names[i].as_py()


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, pa.Array, np.ndarray]]:
    """(key, distinct items, counts) of each batch; column 0 is the key, 1 the items of a row as a list."""
    for b in batches:
        keys = b.column(0).dictionary_encode()
        codes = keys.indices.fill_null(len(keys.dictionary)).to_numpy()
        for k in np.unique(codes):
            rows = b.column(1).filter(pa.array(codes == k))
            counts = rows.flatten().drop_null().value_counts()
            if len(counts):
                yield (keys.dictionary[int(k)].as_py() if k < len(keys.dictionary) else None), counts.field("values"), counts.field("counts").to_numpy()


def _build(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketches: dict[str | None, Sketch] = {}
        for key, names, count in _votes(batches):
            sketches.setdefault(key, Sketch(width)).add(names, count)
        for key, s in sketches.items():
            r, c = np.nonzero(s.total)
            names = [s.names.get(int(x)) if n else None for x, n in zip(s.candidate[r, c], s.surplus[r, c])]
            yield pa.record_batch(
                [pa.array([key] * len(r), pa.string()), pa.array(r.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(names, pa.string()), pa.array(s.total[r, c]), pa.array(s.surplus[r, c])],
                names=["k", "r", "c", "item", "total", "surplus"],
            )

    return run


def merge(cells: DataFrame) -> DataFrame:
    """One row per key, row and cell: the tasks' cells merged by vote cancellation."""
    each = cells.groupBy("k", "r", "c", "item").agg(F.sum("total").alias("total"), F.sum("surplus").alias("votes"))
    every = each.groupBy("k", "r", "c").agg(F.sum("total").alias("total"), F.sum("votes").alias("all"), F.max(F.struct("votes", "item")).alias("best"))
    return every.select("k", "r", "c", F.col("best.item").alias("item"), "total", F.greatest(2 * F.col("best.votes") - F.col("all"), F.lit(0)).alias("surplus"))


def _exact(width: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str | None, str], int] = {}
        for key, names, count in _votes(batches):
            known, open_cells = wanted.value.get(key, (np.zeros(0, U64), np.zeros((ROWS, width), bool)))
            h = hashes(names)
            cells = _cells(h, width)
            hit = np.isin(h, known) | np.all([open_cells[r][cells[r]] for r in range(ROWS)], axis=0)
            for i in np.flatnonzero(hit):
                k = (key, names[int(i)].as_py())
                found[k] = found.get(k, 0) + int(count[i])
            if len(found) > 200_000:
                yield _found(found)
                found = {}
        yield _found(found)

    return run


def _found(found: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array([k for k, _ in found], pa.string()), pa.array([x for _, x in found], pa.string()), pa.array(list(found.values()), pa.int64())], names=["k", "item", "n"])


def frequent_items(df: DataFrame, key: str, items: str, share: float, least: int = 1, width: int | None = None, most_keys: int = MOST_KEYS) -> DataFrame:
    """(k, item, n, lower, upper, total): items with at least ``least`` occurrences and ``share`` of the key's.

    ``items`` is an array of strings.  ``df`` is read twice: give a table, not a costly plan.
    ``width``: cells of a row of the sketch, by default four for each item that may have the share, up to 2**16; with
    fewer, more items are left to the exact pass.  The driver reads the cells that may hold such an item, at most 2 / share
    of each row and key, for up to ``most_keys`` keys.  A key column with more values has its items counted exactly, without bounds.
    """
    spark = df.sparkSession
    if width is None:
        width = min(max(int(np.ceil(4 / share)) - 1, 1 << 8).bit_length(), 16)
        width = 1 << width
    rows = df.select(F.col(key).cast("string").alias("k"), F.col(items).alias("items")).where("items IS NOT NULL")
    if rows.select("k").distinct().limit(most_keys + 1).count() > most_keys:
        return _counted(rows, share, least)
    merged = save(merge(rows.mapInArrow(_build(width), "k string, r int, c int, item string, total bigint, surplus bigint")), "cells")
    totals = merged.where("r = 0").groupBy(F.col("k").alias("tk")).agg(F.sum("total").alias("all")).toPandas()
    totals = [(k if isinstance(k, str) else None, int(n), max(least, int(np.ceil(share * n - 1e-9)))) for k, n in zip(totals["tk"], totals["all"])]
    totals_df = spark.createDataFrame(totals, "tk string, total_of_key bigint, need bigint")
    cells = merged.join(F.broadcast(totals_df), F.expr("k <=> tk")).where("total + surplus >= 2 * need").toPandas()
    wanted, bounds = {}, []
    needs = {k: need for k, _, need in totals}
    for k, g in cells.groupby("k", dropna=False):
        k = k if isinstance(k, str) else None
        total, surplus = np.zeros((ROWS, width), np.int64), np.zeros((ROWS, width), np.int64)
        at = g["r"].to_numpy(), g["c"].to_numpy()
        total[at], surplus[at] = g["total"], g["surplus"]
        names = pa.array(sorted(set(g["item"].dropna())), pa.string())
        h = hashes(names)
        cell, holder = _cells(h, width), np.zeros((ROWS, width), U64)
        own = g["item"].notna().to_numpy()
        holder[at[0][own], at[1][own]] = hashes(pa.array(g["item"][own], pa.string()))
        mine = np.stack([holder[r][cell[r]] == h for r in range(ROWS)])
        v, c = (np.stack([x[r][cell[r]] for r in range(ROWS)]) for x in (total, surplus))
        upper, lower = np.where(mine, v + c, v - c).min(axis=0) // 2, np.where(mine, c, 0).max(axis=0)
        keep = upper >= needs[k]
        wanted[k] = (h[keep], (total - surplus) // 2 >= needs[k])
        bounds += [(k, n.as_py(), int(lo), int(up)) for n, lo, up, ok in zip(names, lower, upper, keep) if ok]
    exact = rows.mapInArrow(_exact(width, spark.sparkContext.broadcast(wanted)), "k string, item string, n bigint").groupBy("k", "item").agg(F.sum("n").alias("n"))
    bounds = spark.createDataFrame(bounds, "bk string, bi string, lower bigint, upper bigint")
    return (
        exact.join(F.broadcast(totals_df), F.expr("k <=> tk"))
        .where("n >= need")
        .join(F.broadcast(bounds), F.expr("k <=> bk AND item = bi"), "left")
        .select("k", "item", "n", "lower", "upper", F.col("total_of_key").alias("total"))
    )


def _counted(rows: DataFrame, share: float, least: int) -> DataFrame:
    """``frequent_items`` by exact counts of all items, for any number of keys; each task combines its own before anything is sent."""
    counts = save(rows.select("k", F.explode("items").alias("item")).where("item IS NOT NULL").groupBy("k", "item").agg(F.count("*").alias("n")), "counts")
    totals = counts.groupBy(F.col("k").alias("tk")).agg(F.sum("n").alias("total"))
    none = F.lit(None).cast("bigint")
    out = counts.join(totals, F.expr("k <=> tk")).where((F.col("n") >= least) & (F.col("n") >= F.col("total") * share - 1e-9))
    return out.select("k", "item", "n", none.alias("lower"), none.alias("upper"), "total")
