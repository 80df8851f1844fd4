"""Occurrences and records of every distinct term, by recursive radix partitioning.

Partial counts, combined within each task, get a 64-bit hash and are parted by its first bits: each part is a
partition, and there are as many as the input's size asks for.  The task of a part holds up to ``limit`` bytes.  If
more comes, it combines what it holds, and if that doesn't help, it spills: terms go to files in the shared folder by
the next bits of the hash.  Each file is then read as a part of its own, so an oversized one is split
again by further bits, until all are within the limit.  DuckDB aggregates each part, out of core
where it needs to.  A hot term is no hot part: it comes once per combined block, and combining leaves one row of it.

Null terms are left out; a null key is a key of its own; null counts add nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill import scratch
from lexmill.llm.strings import hashes

U64 = np.uint64
COMBINE_ROWS, COMBINE_BYTES = 1_000_000, 64 << 20
INPUT_A_PART = 24  # bits: a part for every 16 MB of input
MOST_BITS = 15  # of the first parting; parts that are larger for it are split by their tasks
MORE_BITS = 4
LIMIT = 64 << 20
MEMORY = "256MB"
NAMES = ["h", "k", "term", "n", "records"]


def _combined(batches: list[pa.RecordBatch]) -> pa.Table:
    """Rows (h, k, term, n, records) with one row per key and term; ``h`` needn't be there."""
    t = pa.Table.from_batches(batches).group_by(["k", "term"]).aggregate([("n", "sum"), ("records", "sum")]).combine_chunks()
    k, term = (t[c].combine_chunks() if t.num_rows else pa.array([], pa.string()) for c in ("k", "term"))
    h = hashes(term) ^ hashes(k, seed=1) ^ np.where(np.asarray(k.is_null()), U64(1 << 63), U64(0))
    return pa.table([pa.array(h.view(np.int64)), k, term, t["n_sum"], t["records_sum"]], names=NAMES)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: column 0 key, 1 term, 2 occurrences, 3 records."""
    held, rows, size = [], 0, 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        size += b.nbytes
        if rows >= COMBINE_ROWS or size >= COMBINE_BYTES:
            yield from _combined(held).to_batches()
            held, rows, size = [], 0, 0
    if rows:
        yield from _combined(held).to_batches()


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder's URI, and the folder's path in it."""
    return (fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")) if uri.startswith(("/", "file:")) else fs.FileSystem.from_uri(uri)


@dataclass
class Part:
    """The rows whose hashes begin with the same ``bits`` bits: held up to ``limit`` bytes, beyond that on disk by their next bits."""

    system: fs.FileSystem
    path: str
    bits: int
    limit: int
    held: list = field(default_factory=list)
    size: int = 0
    files: dict = field(default_factory=dict)
    splits: int = 0

    def add(self, b: pa.RecordBatch) -> None:
        self.held.append(b)
        self.size += b.nbytes
        if self.size > self.limit:
            t = _combined(self.held)
            self.held, self.size = t.to_batches(), t.nbytes
            if (self.files or self.size > self.limit // 2) and self.bits + MORE_BITS <= 64:
                self.spill()

    def spill(self) -> None:
        if not self.files:
            self.splits += 1
        for t in self.held:
            child = (t.column(0).to_numpy().view(U64) << U64(self.bits)) >> U64(64 - MORE_BITS)
            for c in np.unique(child):
                if c not in self.files:
                    self.system.create_dir(self.path, recursive=True)
                    out = self.system.open_output_stream(f"{self.path}/{int(c):x}.arrow")
                    self.files[c] = out, pa.ipc.new_stream(out, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                self.files[c][1].write_batch(t.filter(pa.array(child == c)))
        self.held, self.size = [], 0

    def leaves(self) -> Iterator[Iterable[pa.RecordBatch]]:
        """The rows as parts within the limit, whose terms are disjoint."""
        if not self.files:
            if self.held:
                yield self.held
            return
        self.spill()
        for out, writer in self.files.values():
            writer.close()
            out.close()
        for c in self.files:
            at = f"{self.path}/{int(c):x}"
            child = Part(self.system, at, self.bits + MORE_BITS, self.limit)
            with self.system.open_input_stream(f"{at}.arrow") as source:
                for b in pa.ipc.open_stream(source):
                    child.add(b)
            self.system.delete_file(f"{at}.arrow")
            yield from child.leaves()
            self.splits += child.splits


def _aggregate(folder: str, bits: int, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        system, path = file_system(folder)
        path = f"{path}/{uuid.uuid4().hex}"
        part = Part(system, path, bits, limit)
        con = duckdb.connect(config={"memory_limit": MEMORY, "threads": 1, "preserve_insertion_order": False})
        # DuckDB spills by paths only; a part is within the limit, so that memory is enough where the shared folder isn't one
        con.execute(f"SET temp_directory = '{path + '/duckdb' if isinstance(system, fs.LocalFileSystem) else ''}'")
        try:
            for b in batches:
                part.add(b)
            for rows in part.leaves():
                counts = con.from_arrow(pa.Table.from_batches(rows))
                yield from counts.query("part", "SELECT k, term, sum(n)::BIGINT AS n, sum(records)::BIGINT AS records FROM part GROUP BY k, term").to_arrow_reader(50_000)
        finally:
            con.close()
            if system.get_file_info(path).type == fs.FileType.Directory:
                system.delete_dir(path)

    return run


def term_counts(rows: DataFrame, key: str, term: str, n: str, records: str, limit: int = LIMIT, bits: int | None = None) -> DataFrame:
    """(k, term, n, records): sums of ``n`` and ``records`` for every distinct key and term.

    ``limit``: bytes that the task of a part holds before it splits the part on disk.
    ``bits``: of the first parting; by default for one part to 16 MB of input, and at least the session's shuffle partitions.
    """
    spark = rows.sparkSession
    number = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0))
    named = rows.select(F.col(key).cast("string").alias("k"), F.col(term).alias("term"), number(n).alias("n"), number(records).alias("records")).where("term IS NOT NULL")
    if bits is None:
        size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        known = size if size < 1 << 60 else 0  # a plan that isn't over files has no estimate
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        bits = min((max(least, known >> INPUT_A_PART) - 1).bit_length(), MOST_BITS)
    parts = named.mapInArrow(_combine, "h bigint, k string, term string, n bigint, records bigint")
    first = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    parts = parts.repartitionById(1 << bits, first)
    return parts.mapInArrow(_aggregate(scratch.folder(spark, "radix"), bits, limit), "k string, term string, n bigint, records bigint")


def mark(counts: DataFrame, totals: DataFrame, rare: int, common: int, share: float) -> DataFrame:
    """``counts`` with ``mark``: 'rare' in at most ``rare`` records, 'common' in at least ``common`` and ``share`` of the key's records, else null. ``totals``: (tk, total), one row per key."""
    many = (F.col("records") >= common) & (F.col("records") >= F.col("total") * share - 1e-9)
    return counts.join(totals, F.expr("k <=> tk"), "left").drop("tk").withColumn("mark", F.when(F.col("records") <= rare, "rare").when(many, "common"))
