"""Evaluation passages in a corpus: spaced seeds, a join on their hashes, and verified overlaps.

A mask marks the token positions of a window that are hashed; the others are ignored, so a
substituted word in an ignored position doesn't lose the hit.  Every window of every test item
is hashed under every mask.  The corpus is scanned once: a window whose hash may be a test
item's (by a Bloom filter of at most 2**30 bits; more items are looked for in several scans) makes its document a
candidate, which is written with its hits and word hashes.  Documents and items that share a hash are
joined, once each, and verified on the words themselves along every diagonal with a hit: the longest
run of equal words, and the longest overlap in which substituted words lie at least ``GAP`` equal words apart.

No mask is longer than the shortest run to be found, so an exact run of that length hits under every mask.

Nulls: rows with a null id or text are left out.  A document or item delivered twice counts
once per id.  Items with fewer words than the shortest mask are hashed as a whole, and found where
a document holds all their words in order.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import vec
from lexmill.scratch import save

U64 = np.uint64
MASKS = ("110110100111", "111001011011")
GAP = 3
PROBES = 4
BITS_A_SEED, LEAST_BITS, MOST_BITS = 64, 20, 30
SEEDS_A_SCAN = 1 << 25
BROADCAST_BYTES = 32 << 20
AT_ONCE = 1 << 21  # words compared in one step


def _windows(w: vec.Words, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the windows that lie within one text."""
    n = len(w.hash) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = np.full(n, number + 1, U64)
    for j, used in enumerate(mask):
        if used == "1":
            h *= U64(0x9E3779B97F4A7C15)
            h += w.hash[j : n + j]
    at = np.flatnonzero(w.doc[:n] == w.doc[len(mask) - 1 :])
    return at, vec.mix(h[at])


def _short_windows(w: vec.Words, masks: tuple[str, ...], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the windows of an item that is shorter than the masks; all positions are used."""
    return _windows(w, "1" * length, len(masks) + length)


def _seeds(masks: tuple[str, ...]):
    """Task over (id, text): the items' words and the hashes of their windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in vec.blocks(texts):
                w = vec.words(texts[lo:hi])
                hits = [(w.doc[at], at - w.first[w.doc[at]], h) for m, mask in enumerate(masks) for at, h in [_windows(w, mask, m)]]
                for length in range(1, min(map(len, masks))):
                    at, h = _short_windows(w, masks, length)
                    own = w.counts()[w.doc[at]] == length
                    hits.append((w.doc[at[own]], np.zeros(own.sum(), np.int64), h[own]))
                yield _rows(ids.slice(lo, hi - lo), w, np.arange(hi - lo), hits)

    return run


def _rows(ids: pa.Array, w: vec.Words, docs: np.ndarray, hits: list[tuple]) -> pa.RecordBatch:
    """id, words, and the windows' positions and hashes, of the texts ``docs``."""
    doc, pos, h = (np.concatenate(x) for x in zip(*hits))
    order = np.argsort(doc, kind="stable")
    doc, pos, h = doc[order], pos[order], h[order]
    lo, hi = np.searchsorted(doc, docs), np.searchsorted(doc, docs, side="right")
    return pa.record_batch(
        [
            ids.take(pa.array(docs)),
            pa.array([w.hash[w.first[d] : w.first[d + 1]].tobytes() for d in docs], pa.binary()),
            pa.array([pos[a:b] for a, b in zip(lo, hi)], pa.list_(pa.int64())),
            pa.array([h[a:b].view(np.int64) for a, b in zip(lo, hi)], pa.list_(pa.int64())),
        ],
        names=["id", "words", "pos", "seed"],
    )


_SCHEMA = "id bigint, words binary, pos array<bigint>, seed array<bigint>"


def _probe(h: np.ndarray, j: int, bits: int) -> np.ndarray:
    """The j-th place of each seed; the first, which all windows of the corpus are looked up at, is of its own bits."""
    return (h if j == 0 else vec.mix(h + U64(j * 0xD1342543DE82EF95 % (1 << 64)))) >> U64(64 - bits)


def bloom(seeds: np.ndarray) -> np.ndarray:
    """A bit for each of PROBES places of every seed; BITS_A_SEED bits per seed, a power of two."""
    bits = min(max((BITS_A_SEED * max(len(seeds), 1) - 1).bit_length(), LEAST_BITS), MOST_BITS)
    out = np.zeros(1 << (bits - 3), np.uint8)
    for j in range(PROBES):
        at = _probe(seeds, j, bits)
        np.bitwise_or.at(out, (at >> U64(3)).astype(np.int64), (U64(1) << (at & U64(7))).astype(np.uint8))
    return out


def may_be(h: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Where ``h`` may be a seed."""
    at, bits = np.arange(len(h)), len(filled).bit_length() + 2
    for j in range(PROBES):
        x = _probe(h[at], j, bits)
        at = at[(filled[(x >> U64(3)).astype(np.int64)] >> (x & U64(7)).astype(np.uint8)) & 1 == 1]
    return at


def _scan(masks: tuple[str, ...], short: list[int], filled):
    """Task over (id, text): the texts with windows that may be test windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for lo, hi in vec.blocks(texts):
                w = vec.words(texts[lo:hi])
                hits = []
                for at, h in [*(_windows(w, mask, m) for m, mask in enumerate(masks)), *(_short_windows(w, masks, length) for length in short)]:
                    may = may_be(h, filled.value)
                    hits.append((w.doc[at[may]], at[may] - w.first[w.doc[at[may]]], h[may]))
                docs = np.unique(np.concatenate([x[0] for x in hits]))
                if len(docs):
                    yield _rows(ids.slice(lo, hi - lo), w, docs, hits)

    return run


def overlaps(same: np.ndarray, gap: int = GAP) -> tuple[int, int]:
    """Of aligned words, one alignment a row: the longest run of equal words, and the most equal words in a stretch whose different words lie at least ``gap`` equal words apart."""
    rows, n = same.shape
    different = np.ones((rows, n + 2), bool)  # both ends of a row count as different
    different[:, 1:-1] = ~same
    at = np.flatnonzero(different)
    between = np.diff(at) - 1
    end = (at % (n + 2) == 0) | (at % (n + 2) == n + 1)
    between[end[:-1] & end[1:] & (at[:-1] % (n + 2) == n + 1)] = 0  # from one row to the next
    inner = np.flatnonzero(~end)
    most = int(between.max(initial=0))
    if not len(inner):
        return most, most
    linked = (np.diff(inner) == 1) & (between[inner[:-1]] >= gap)
    first = inner[np.concatenate(([True], ~linked))]
    last = inner[np.concatenate((~linked, [True]))]
    return most, max(most, int((at[last + 1] - at[first - 1] - 1 - (last - first + 1)).max()))


def diagonals(pos: np.ndarray, seed: np.ndarray, item_pos: np.ndarray, item_seed: np.ndarray) -> np.ndarray:
    """Differences of the positions at which document and item have the same seed. Seeds that both repeat many times are correlated, not paired."""
    common = np.intersect1d(seed, item_seed)
    found = [np.zeros(0, np.int64)]
    order, item_order = np.argsort(seed, kind="stable"), np.argsort(item_seed, kind="stable")
    seed, pos, item_seed, item_pos = seed[order], pos[order], item_seed[item_order], item_pos[item_order]
    cuts = [np.searchsorted(s, common, side) for s in (seed, item_seed) for side in ("left", "right")]
    for a, b, c, d in zip(*(x.tolist() for x in cuts)):
        x, y = pos[a:b], item_pos[c:d]
        size = int(x.max() - x.min() + y.max() - y.min() + 1)
        if len(x) * len(y) <= 64 * size:
            found.append(np.unique(x[:, None] - y[None, :]))
            continue
        n = 1 << size.bit_length()
        marks = [np.bincount(z, minlength=n)[:n].astype(float) for z in (x - x.min(), y.max() - y)]
        product = np.fft.irfft(np.fft.rfft(marks[0]) * np.fft.rfft(marks[1]), n)
        found.append(np.flatnonzero(product[:size] > 0.5) + x.min() - y.max())
    return np.unique(np.concatenate(found))


def compare(x: np.ndarray, y: np.ndarray, shifts: np.ndarray) -> tuple[int, int]:
    """The best of ``overlaps`` along the diagonals: word i of ``y`` beside word i + shift of ``x``."""
    exact = around = 0
    step = max(1, AT_ONCE // max(len(y), 1))
    for lo in range(0, len(shifts), step):
        at = shifts[lo : lo + step, None] + np.arange(len(y))
        same = (x[np.clip(at, 0, len(x) - 1)] == y) & (at >= 0) & (at < len(x))
        e, a = overlaps(same)
        exact, around = max(exact, e), max(around, a)
    return exact, around


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: id, item, and words, pos, seed of the document and of the item."""
    for b in batches:
        exact, around = [], []
        for i in range(b.num_rows):
            x, y = (np.frombuffer(b.column(c)[i].as_py(), U64) for c in (2, 5))
            pos, seed, item_pos, item_seed = (b.column(c)[i].values.to_numpy() for c in (3, 4, 6, 7))
            e, a = compare(x, y, diagonals(pos, seed, item_pos, item_seed))
            exact.append(e)
            around.append(a)
        yield pa.record_batch([b.column(0), b.column(1), pa.array(exact, pa.int64()), pa.array(around, pa.int64())], names=["id", "item", "exact_run", "overlap"])


def leaks(docs: DataFrame, id_col: str, text_col: str, items: DataFrame, item_id: str, item_text: str, masks: tuple[str, ...] = MASKS, seeds_a_scan: int = SEEDS_A_SCAN) -> DataFrame:
    """(id, item, exact_run, overlap): documents with passages of items, and the longest of them in words.

    ``seeds_a_scan``: windows of items that are looked for in one scan of the documents; their hashes, 8 bytes each, go
    through the driver.  Items with more windows than that are parted, and the documents scanned for each part.
    """
    pick = lambda df, i, t: df.select(F.col(i).cast("bigint").alias("id"), F.col(t).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    tests = save(pick(items, item_id, item_text).dropDuplicates(["id"]).mapInArrow(_seeds(masks), _SCHEMA), "items")
    windows, size = tests.agg(F.sum(F.size("seed")), F.sum(F.octet_length("words") + 16 * F.size("seed"))).first()
    scans = max(1, -(-(windows or 0) // seeds_a_scan))
    rows = pick(docs, id_col, text_col)
    out = [_found(rows, tests.where(F.pmod(F.xxhash64("id"), F.lit(scans)) == i) if scans > 1 else tests, masks, (size or 0) <= BROADCAST_BYTES) for i in range(scans)]
    return functools.reduce(DataFrame.union, out)


def _found(rows: DataFrame, tests: DataFrame, masks: tuple[str, ...], few: bool) -> DataFrame:
    """``leaks`` of saved items; ``few``: they are small enough to be broadcast."""
    context = rows.sparkSession.sparkContext
    near = F.broadcast if few else lambda df: df
    seeds = tests.select(F.col("id").alias("item"), F.explode(F.array_distinct("seed")).alias("seed"))
    filled = bloom(seeds.select("seed").distinct().toPandas()["seed"].to_numpy(np.int64).view(U64))
    lengths = tests.select((F.octet_length("words") / 8).cast("int").alias("n")).where(F.col("n").between(1, min(map(len, masks)) - 1)).distinct()
    short = [r["n"] for r in lengths.collect()]  # fewer than the masks are long
    found = save(rows.mapInArrow(_scan(masks, short, context.broadcast(filled)), _SCHEMA), "hits")
    hits = found.select("id", F.explode(F.array_distinct("seed")).alias("seed"))
    pairs = hits.join(near(seeds), "seed").select("id", "item").distinct()
    side = lambda df, key, x: df.select(F.col("id").alias(key), *(F.col(c).alias(f"{c}_{x}") for c in ("words", "pos", "seed")))
    both = pairs.join(side(found, "id", "x"), "id").join(near(side(tests, "item", "y")), "item")
    columns = [f"{c}_{x}" for x in "xy" for c in ("words", "pos", "seed")]
    verified = both.select("id", "item", *columns).mapInArrow(_verify, "id bigint, item bigint, exact_run bigint, overlap bigint")
    return verified.groupBy("id", "item").agg(F.max("exact_run").alias("exact_run"), F.max("overlap").alias("overlap"))
