"""Near-duplicate texts: tiled exact comparison of bit sketches, behind a lossless candidate filter.

Two texts are near duplicates if the distinct runs of ``k`` words found in both are at
least ``threshold`` of those found in either.

1. *Classes.*  Texts with the same set of runs form one class; only classes are compared, so
   a group of exact copies costs as much as one text, however large it is.
2. *Prefixes.*  Of each class only the ``n - ceil(threshold * n) + 1`` runs that come first in
   one global order are keys.  Two classes over the threshold share a key (the prefix filter of
   set-similarity joins), so none is lost.  The order puts runs that are frequent in the
   corpus last; it comes from a sketch of fixed size, and any order is right, the sketch only
   makes the groups of a key small.  Comparing all tiles with all would grow with the square.  Of two such classes the smaller has a shared
   key among its first ``n - ceil(2 * threshold / (1 + threshold) * n) + 1`` runs, so a group in which no class has the key that early is dropped,
   and a group is parted where sizes are too far apart.
   Of a key, only it and the class id are sent; keys with the same classes are then one group, so that sketches,
   which are longer, are sent about once or twice for each class, not once for each key.
3. *Tiles.*  The classes of a group, in order of size, are cut into tiles.  A class has ``BITS`` parity bits
   (each run flips one), and the exclusive-or of two sketches has at most as many bits as the
   sets' symmetric difference, which the threshold bounds by a radius.  Tile pairs whose
   population counts, of sketches or of whole sets, differ by more than the radius are skipped; of the others
   all bits are compared.  Every group goes this way, whatever its size.
   The classes of a key that is hot are spread over buckets, and no task holds them together: as those of any group over ``HOT`` they
   are parted into larger tiles by size; the pairs of these tiles, less those skipped
   by their population counts, are rows of a join and compared by all tasks.
4. *Verification.*  Surviving pairs are verified on the full sets of 48-bit run hashes, family by family, so that a set
   is sent about once for all its pairs.

Texts with fewer than ``k`` words have no runs: those with the same words in the same order (without
words, the same text) form one class, which has no keys and is near no other.

Nulls: rows with a null id or null text are left out, as are texts with fewer than ``min_words``
words.  A row delivered twice counts once.  Class ids are 64-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import vec
from lexmill.scratch import save

U64 = np.uint64
CELLS = 1 << 20  # of each of the two rows of the frequency sketch
LOCAL_HEAVY = 8  # a task reports cells with at least this count, and 4 times the mean
BITS = 256
WORDS = BITS // 64
HOT = 4096  # groups of more classes than this are cut into large tiles that all tasks compare
TILE = 16
TOGETHER = 8_000_000  # elements of the sets that a task verifies together
LARGE_TILE = 1024
CELLS_AT_ONCE = 1 << 17  # pairs of classes compared in one step
FLUSH = 1_000_000  # keys
RECORD = 13  # bytes: 4 of the key, as its bucket is known, with the first bit for an early place; the class id; the size
OCTAVE = 8  # steps of a size to its double
EARLY = 1 << 31
INPUT_A_BUCKET = 23  # bits: a bucket for every 8 MB of input
BUCKET_BYTES = 128 << 20  # held by a task at most
MOST_PARTS = 50_000  # tasks; with more buckets than this, a task takes several, one after the other
MASK48 = U64((1 << 48) - 1)


def _ceil(threshold: float, n: np.ndarray) -> np.ndarray:
    return np.ceil(threshold * n - 1e-9).astype(np.int64)


def _sets(texts: list[str], k: int, min_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By block: offset, text of each run, run, and per text the number of runs and the class id; no runs below k words, class 0 below min_words."""
    for lo, hi in vec.blocks(texts):
        w = vec.words(texts[lo:hi])
        doc, run = vec.shingles(w, k)
        long = w.counts() >= max(min_words, k)
        keep = long[doc]
        doc, run = doc[keep], run[keep]
        n = np.bincount(doc, minlength=hi - lo)
        total = np.concatenate(([U64(0)], np.cumsum(vec.mix(run), dtype=U64)))
        last = np.cumsum(n)
        cid = vec.mix((total[last] - total[last - n]) ^ (n.astype(U64) << U64(40)))
        few = np.flatnonzero((w.counts() >= min_words) & (w.counts() < k))
        cid[few] = _short_classes(texts[lo:hi], w, few)
        yield lo, doc, run, n, cid.view(np.int64)


def _short_classes(texts: list[str], w: vec.Words, few: np.ndarray) -> np.ndarray:
    """Classes of texts without runs, by their words in order, or by the text itself if it has none."""
    count = w.counts()[few]
    out = count.astype(U64)
    for j in range(int(count.max(initial=0))):
        more = count > j
        out[more] = vec.mix(out[more]) + w.hash[w.first[few[more]] + j]
    for i in np.flatnonzero(count == 0):
        out[i] = int.from_bytes(hashlib.blake2b(texts[few[i]].encode("utf-8", "surrogatepass"), digest_size=8).digest())
    out = vec.mix(out ^ U64(0x5851F42D4C957F2D))
    return np.where(out == 0, U64(1), out)


def _cells(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (run & U64(CELLS - 1)).astype(np.int64), ((run >> U64(20)) & U64(CELLS - 1)).astype(np.int64)


_SKETCH = [f"s{i}" for i in range(WORDS)]
_SURVEY = f"kind tinyint, a bigint, b bigint, {', '.join(f'{c} bigint' for c in _SKETCH)}"


def _survey(k: int, min_words: int):
    """Task: (0, class, id) for each text; (1, cell, count) for each heavy cell; (2, class, size, sketch) for each class with runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = np.zeros(2 * CELLS, np.int64), _Seen()
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            for lo, doc, runs, n, cid in _sets(texts, k, min_words):
                a, c = _cells(runs)
                counts += np.bincount(np.concatenate((a, c + CELLS)), minlength=2 * CELLS)
                at = np.flatnonzero(cid)
                yield _table(0, cid[at], ids[lo + at])
                at = np.flatnonzero(seen.fresh(cid, n))
                yield _table(2, cid[at], n[at], _sketches(doc, runs, len(n))[at])
        usual = counts.mean()  # what other runs have in a cell, by chance
        heavy = np.flatnonzero(counts >= max(LOCAL_HEAVY, 4 * usual))
        yield _table(1, heavy, counts[heavy] - int(usual))

    return run


class _Seen:
    """Classes that a task has met; a copy that comes again later, once there are too many, only costs its rows again."""

    def __init__(self):
        self.ids: set[int] = set()

    def fresh(self, cid: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Which texts with runs are the first of their class."""
        out = np.zeros(len(n), bool)
        for i in np.flatnonzero(n):
            if (c := int(cid[i])) not in self.ids:
                self.ids.add(c)
                out[i] = True
        if len(self.ids) > 1_000_000:
            self.ids.clear()
        return out


def _table(kind: int, a: np.ndarray, b: np.ndarray, sk: np.ndarray | None = None) -> pa.RecordBatch:
    bits = [pa.nulls(len(a), pa.int64())] * WORDS if sk is None else [pa.array(sk[:, i].view(np.int64)) for i in range(WORDS)]
    return pa.record_batch([pa.array(np.full(len(a), kind, np.int8)), pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), *bits], names=["kind", "a", "b", *_SKETCH])


def _levels(heavy: DataFrame) -> np.ndarray:
    """Per cell the bit length of its count; the table has a fixed size of 2 * CELLS bytes."""
    levels = np.zeros(2 * CELLS, np.uint8)
    got = heavy.groupBy("a").agg(F.sum("b").alias("n")).toPandas()
    levels[got["a"].to_numpy(np.int64)] = [int(x).bit_length() for x in got["n"]]
    return levels


def _sketches(doc: np.ndarray, run: np.ndarray, n_docs: int) -> np.ndarray:
    """Parity bits: [text, BITS / 64]."""
    bit = (vec.mix(run) >> U64(64 - BITS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(doc * BITS + bit, minlength=n_docs * BITS).astype(np.uint8) & 1
    return np.ascontiguousarray(np.packbits(odd.reshape(n_docs, BITS), axis=1, bitorder="little")).view(U64)


def _emit(k: int, min_words: int, threshold: float, levels, buckets: int, parts: int, most: int):
    """Task: the records (key, class id) of each bucket; hot keys apart, spread so that about ``most`` classes of one are in a bucket."""

    def flush(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        cid, key, rank, early = (np.concatenate([p[j] for p in held]) for j in range(4))
        step = np.concatenate([p[4] for p in held])
        excess = rank.astype(np.int64) - most.bit_length()
        hot = excess > 0
        salt = np.where(hot, vec.mix(cid.view(U64)) % (U64(1) << np.clip(excess + 1, 0, 40).astype(U64)), U64(0))
        bucket = (vec.mix(key + salt * U64(0x9E3779B97F4A7C15)) % U64(buckets)).astype(np.int64) * 2 + hot
        order = np.argsort(bucket, kind="stable")
        bucket, key, cid = bucket[order], (key & U64(EARLY - 1)) | np.where(early, U64(EARLY), U64(0)), cid[order]
        key = key[order]
        record = np.empty((len(key), RECORD), np.uint8)
        record[:, :4] = key.astype(np.uint32).view(np.uint8).reshape(-1, 4)
        record[:, 4:12] = cid.view(np.uint8).reshape(-1, 8)
        record[:, 12] = step[order]
        start = np.flatnonzero(np.diff(bucket, prepend=-1))
        offsets = pa.py_buffer(np.append(start, len(key)).astype(np.int32) * np.int32(RECORD))
        blobs = pa.Array.from_buffers(pa.binary(), len(start), [None, offsets, pa.py_buffer(record)])
        b = bucket[start]
        yield pa.record_batch([pa.array((b // 2 % parts).astype(np.int32)), pa.array(b // 2), pa.array(b % 2 == 1), blobs], names=["part", "bucket", "hot", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = levels.value
        held, count, seen = [], 0, _Seen()
        for b in batches:
            for _, doc, runs, n, cid in _sets(b.column(0).to_pylist(), k, min_words):
                a, c = _cells(runs)
                rank = np.minimum(level[a], level[c + CELLS]).astype(U64)
                order = np.sort((doc.astype(U64) << U64(54)) | (rank << U64(48)) | runs)
                doc = (order >> U64(54)).astype(np.int64)
                first = np.concatenate(([0], np.cumsum(n)))
                place = np.arange(len(order)) - first[doc]
                use = (place < (n - _ceil(threshold, n) + 1)[doc]) & seen.fresh(cid, n)[doc]
                early = place < (n - _ceil(2 * threshold / (1 + threshold), n) + 1)[doc]
                held.append((cid[doc[use]], order[use] & MASK48, ((order[use] >> U64(48)) & U64(63)).astype(np.uint8), early[use], _steps(n)[doc[use]]))
                count += len(held[-1][0])
                if count >= FLUSH:
                    yield from flush(held)
                    held, count = [], 0
        if count:
            yield from flush(held)

    return run


def _steps(n: np.ndarray) -> np.ndarray:
    return (OCTAVE * np.log2(np.maximum(n, 1))).astype(np.uint8)


_GROUPS = "gid bigint, large boolean, members array<bigint>"


def _group(threshold: float, most: int, bucket_bytes: int):
    """Task over (part, bucket, hot, blob), buckets in order: the groups of classes with the same key, each set of classes once.

    Groups over ``most``, hot keys and buckets that come in several pieces give parts of groups (``large``), which belong together by ``gid``.
    """

    apart = OCTAVE * -math.log2(threshold) + 1  # steps of sizes that can't be over the threshold

    def groups(number: int, blobs: list[bytes], hot: bool, whole: bool) -> Iterator[pa.RecordBatch]:
        record = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, RECORD)
        key, cid = np.ascontiguousarray(record[:, :4]).view(np.uint32).ravel(), np.ascontiguousarray(record[:, 4:12]).view(np.int64).ravel()
        early, key = key >= EARLY, key & np.uint32(EARLY - 1)
        order = np.lexsort((cid, record[:, 12], key))
        key, cid, early, step = key[order], cid[order], early[order], record[order, 12].astype(np.int64)
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])))
        key, cid, early, step = key[fresh], cid[fresh], early[fresh], step[fresh]
        start = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (np.diff(step) > apart))))
        size = np.diff(np.append(start, len(key)))
        of_key = vec.mix(key[start].astype(U64) + U64(0 if hot else (number + 1) << 32))
        of_set = vec.mix(np.add.reduceat(vec.mix(cid.view(U64)), start) ^ size.astype(U64))
        large = (size > most) | hot | (not whole)
        small = np.flatnonzero(~large & (size > 1) & np.logical_or.reduceat(early, start))
        small = small[np.unique(of_set[small], return_index=True)[1]]
        for at, gid, is_large in ((small, of_set, False), (np.flatnonzero(large), of_key, True)):
            for lo in range(0, len(at), 50_000):
                g = at[lo : lo + 50_000]
                ends = np.concatenate(([0], np.cumsum(size[g])))
                idx = np.repeat(start[g] - ends[:-1], size[g]) + np.arange(ends[-1])
                members = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(cid[idx]))
                yield pa.record_batch([pa.array(gid[g].view(np.int64)), pa.array(np.full(len(g), is_large)), members], names=["gid", "large", "members"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hot_now, piece, held, size = None, False, 0, [], 0
        for b in batches:
            for number, hot, blob in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                same = (number, hot) == (now, hot_now)
                if held and (not same or size > bucket_bytes):
                    yield from groups(now, held, hot_now, whole=not same and not piece)
                    piece = piece + 1 if same else 0
                    held, size = [], 0
                now, hot_now = number, hot
                held.append(blob)
                size += len(blob)
        if held:
            yield from groups(now, held, hot_now, whole=not piece)

    return run


def _allowed(threshold: float) -> float:
    """The radius, for each element of two sets together: of two sets over the threshold, the largest symmetric difference."""
    return (1 - threshold) / (1 + threshold)


@dataclass
class Skipped:
    """Pairs of different tiles seen, and those of them skipped by their population counts."""

    pairs: int = 0
    skipped: int = 0


def _far(n_a: tuple, n_b: tuple, pop_a: tuple, pop_b: tuple, threshold: float) -> np.ndarray:
    """Which pairs of tiles are apart by more than the radius, by the (least, largest) population counts of their whole sets and of their sketches."""
    radius = _allowed(threshold) * (n_a[1] + n_b[1]) + 1e-9
    gap = [np.maximum(x[0] - y[1], y[0] - x[1]) for x, y in ((n_a, n_b), (pop_a, pop_b))]
    return np.maximum(*gap) > radius


def compare_tiles(group: np.ndarray, members: np.ndarray, n: np.ndarray, sk: np.ndarray, threshold: float, stats: Skipped | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs within the radius among ``members`` of the same ``group``.

    Groups are put in order of their members' sizes and cut into tiles of ``TILE`` (smaller groups are one smaller tile);
    tile pairs that survive the population counts are compared in batches.
    """
    pop = np.bitwise_count(sk).sum(axis=1, dtype=np.int64)
    order = np.lexsort((pop[members], n[members], group))
    group, members = group[order], members[order]
    start = np.flatnonzero(np.diff(group, prepend=group[:1] ^ U64(1)))
    size = np.diff(np.append(start, len(group)))
    low = 1
    while low < TILE:
        of = (size > low) & ((size <= 2 * low) | (2 * low >= TILE))
        low *= 2
        if not of.any():
            continue
        tiles = -(-size[of] // low)  # of each group
        first = np.concatenate(([0], np.cumsum(tiles)[:-1]))
        place = np.arange(tiles.sum()) - np.repeat(first, tiles)
        at = np.repeat(start[of], tiles)[:, None] + place[:, None] * low + np.arange(low)
        inside = at < np.repeat(start[of] + size[of], tiles)[:, None]
        at = members[np.where(inside, at, 0)]
        lowest = lambda x: np.where(inside, x[at], 1 << 60).min(axis=1)  # noqa: B023, E731
        highest = lambda x: np.where(inside, x[at], -1).max(axis=1)  # noqa: B023, E731
        reach = [(lowest(x), highest(x)) for x in (n, pop)]
        left, right = [np.arange(len(at))], [np.arange(len(at))]  # every tile with itself, and the pairs within its group
        for f, t in zip(first[tiles > 1], tiles[tiles > 1]):
            i, j = np.triu_indices(t, 1)
            far = _far(*(tuple(x[f + y] for x in r) for r in reach for y in (i, j)), threshold)
            if stats:
                stats.pairs += len(far)
                stats.skipped += int(far.sum())
            left.append(f + i[~far])
            right.append(f + j[~far])
        left, right = np.concatenate(left), np.concatenate(right)
        yield from _compared(at, inside, left, right, n, sk, threshold)


def _compared(at: np.ndarray, inside: np.ndarray, left: np.ndarray, right: np.ndarray, n: np.ndarray, sk: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The near members of the tile pairs (left, right); ``at`` holds each tile's members, ``inside`` which of its places are taken."""
    width = at.shape[1]
    step = max(1, CELLS_AT_ONCE // (width * width))
    for lo in range(0, len(left), step):
        i, j = left[lo : lo + step], right[lo : lo + step]
        rows, cols = at[i], at[j]
        near = _near(rows, cols, n, sk, threshold) & inside[i][:, :, None] & inside[j][:, None, :]
        near &= (i != j)[:, None, None] | np.triu(np.ones((width, width), bool), 1)
        t, p, q = np.nonzero(near)
        if len(t):
            yield rows[t, p], cols[t, q]


def _cut(members: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One group's members in order of size as tiles, and which places are taken."""
    members = members[np.argsort(n[members], kind="stable")]
    at = np.resize(np.arange(len(members)), -(-len(members) // TILE) * TILE).reshape(-1, TILE)
    return members[at], np.arange(at.size).reshape(at.shape) < len(members)


def compare_sides(a: np.ndarray, b: np.ndarray, n: np.ndarray, sk: np.ndarray, threshold: float, stats: Skipped | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs within the radius of one member of ``a`` and one of ``b``."""
    (at_a, in_a), (at_b, in_b) = _cut(a, n), _cut(b, n)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(at_a)), np.arange(len(at_a), len(at_a) + len(at_b)), indexing="ij"))
    at, inside = np.concatenate((at_a, at_b)), np.concatenate((in_a, in_b))
    pop = np.bitwise_count(sk).sum(axis=1, dtype=np.int64)
    far = _far(*((x[at].min(axis=1)[y], x[at].max(axis=1)[y]) for x in (n, pop) for y in (i, j)), threshold)
    if stats:
        stats.pairs += len(far)
        stats.skipped += int(far.sum())
    yield from _compared(at, inside, i[~far], j[~far], n, sk, threshold)


def _near(rows: np.ndarray, cols: np.ndarray, n: np.ndarray, sk: np.ndarray, threshold: float) -> np.ndarray:
    """[tile pair, row, column]: whether exclusive-or and sizes are within the radius."""
    na, nb = n[rows][:, :, None], n[cols][:, None, :]
    differ = np.zeros((*rows.shape, cols.shape[1]), np.int16)
    for word in range(WORDS):
        differ += np.bitwise_count(sk[rows, word][:, :, None] ^ sk[cols, word][:, None, :])
    return np.maximum(differ, np.abs(na - nb)) <= _allowed(threshold) * (na + nb) + 1e-9


_CANDIDATES = "a bigint, b bigint, na bigint, nb bigint"


def _pairs_in(near: Iterator[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of class ids, the smaller first, each about once, and the sizes of both sets."""

    def once(found: list[np.ndarray]) -> pa.RecordBatch:
        x = np.unique(np.concatenate(found), axis=0)
        return pa.record_batch([pa.array(np.ascontiguousarray(x[:, i])) for i in range(4)], names=["a", "b", "na", "nb"])

    found, held = [np.zeros((0, 4), np.int64)], 0
    for p, q in near:
        p, q = np.where(ids[p] < ids[q], p, q), np.where(ids[p] < ids[q], q, p)
        p, q = p[ids[p] != ids[q]], q[ids[p] != ids[q]]
        found.append(np.column_stack((ids[p], ids[q], n[p], n[q])))
        held += len(p)
        if held > 1_000_000:
            yield once(found)
            found, held = found[:1], 0
    yield once(found)


def _tiled(threshold: float):
    """Task over (gid, cid, n, sketch) in order of gid: pairs of classes of a group within the radius."""

    def compare(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gid, ids, n, *sk = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3 + WORDS))
        near = compare_tiles(gid.view(U64), np.arange(len(ids)), n, np.column_stack(sk).view(U64), threshold)
        return _pairs_in(near, ids, n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            last = b.column(0).to_numpy()
            if rows > 100_000 and last[0] != last[-1]:  # all but the last group is there
                cut = int(np.searchsorted(last, last[-1]))
                held[-1] = b.slice(0, cut)
                yield from compare(held)
                held, rows = [b.slice(cut)], b.num_rows - cut
        if rows:
            yield from compare(held)

    return run


def _across(threshold: float):
    """Task over (same tile, tile, tile), lists of (cid, n, sketch): pairs of classes within the radius in two large tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x, y = (b.column(c)[i].values for c in (1, 2))
                ids, n, *sk = (np.concatenate((x.field(f).to_numpy(zero_copy_only=False), y.field(f).to_numpy(zero_copy_only=False))) for f in range(2 + WORDS))
                sk, m = np.column_stack(sk).view(U64), len(x)
                same = b.column(0)[i].as_py()
                near = compare_tiles(np.zeros(m, U64), np.arange(m), n, sk, threshold) if same else compare_sides(np.arange(m), np.arange(m, len(ids)), n, sk, threshold)
                yield from _pairs_in(near, ids, n)

    return run


def _large_groups(rows: DataFrame, threshold: float, tile: int) -> DataFrame:
    """Pairs of classes of the same large group: tiles by size and hash, the tiles' counts joined first, then what tile pairs remain is."""
    band = F.floor(F.log("n") * (4 / -math.log(threshold)))  # a size range that is small beside the radius
    rows = save(rows.distinct().withColumn("band", band), "large")
    counts = rows.groupBy("gid", "band").agg(F.count("*").alias("members"))
    salt = F.pmod(F.xxhash64("cid"), F.ceil(F.col("members") / tile))
    pop = sum((F.bit_count(c) for c in _SKETCH), F.lit(0))
    reach = [f(c).alias(f"{c}_{x}") for c in ("n", "pop") for f, x in ((F.min, "lo"), (F.max, "hi"))]
    tiles = rows.join(counts, ["gid", "band"]).withColumns({"salt": salt, "pop": pop}).groupBy("gid", "band", "salt")
    tiles = tiles.agg(F.collect_list(F.struct("cid", "n", *_SKETCH)).alias("rows"), *reach).withColumn("tile", F.struct("band", "salt"))
    tiles = save(tiles.drop("band", "salt"), "large_tiles")
    side = lambda x: [F.col(c).alias(f"{c}_{x}") for c in ("tile", "n_lo", "n_hi", "pop_lo", "pop_hi")]
    both = tiles.select("gid", *side("x")).join(tiles.select("gid", *side("y")), "gid").where("tile_x <= tile_y")
    radius = F.lit(_allowed(threshold)) * (F.col("n_hi_x") + F.col("n_hi_y")) + 1e-9
    for c in ("n", "pop"):
        both = both.where((F.col(f"{c}_lo_y") - F.col(f"{c}_hi_x") <= radius) & (F.col(f"{c}_lo_x") - F.col(f"{c}_hi_y") <= radius))
    for x in "xy":
        both = both.join(tiles.select("gid", F.col("tile").alias(f"tile_{x}"), F.col("rows").alias(f"rows_{x}")), ["gid", f"tile_{x}"])
    return both.select(F.expr("tile_x = tile_y"), "rows_x", "rows_y").mapInArrow(_across(threshold), _CANDIDATES)


def _candidates(groups: DataFrame, sketches: DataFrame, threshold: float, tile: int) -> DataFrame:
    """Pairs of classes (a, b) within the radius, and the sizes of both; ``groups`` and ``sketches`` saved."""
    small = groups.where("NOT large").groupBy("gid").agg(F.first("members").alias("members"))
    small = small.select("gid", F.explode("members").alias("cid")).join(sketches, "cid").select("gid", "cid", "n", *_SKETCH)
    pairs = small.repartition("gid").sortWithinPartitions("gid").mapInArrow(_tiled(threshold), _CANDIDATES)
    large = groups.where("large").select("gid", F.explode("members").alias("cid"))
    if not large.isEmpty():
        pairs = pairs.union(_large_groups(large.join(sketches, "cid"), threshold, tile))
    return pairs.distinct()


def _families(found: DataFrame) -> DataFrame:
    """``found`` with ``f``, the family that a pair is verified in: classes that are near one another mostly share the same nearest smallest id.

    A set is then sent about once, not once a pair.  A family of more than TOGETHER elements is verified pair by pair.
    """
    ends = found.select(F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("b").alias("o")), F.struct(F.col("b").alias("c"), F.col("a").alias("o")))).alias("e"))
    least = save(ends.groupBy("e.c").agg(F.least(F.min("e.o"), F.first("e.c")).alias("least"), F.count("*").alias("_n")), "least")
    for x in "ab":
        found = join_counted(found, least.select(F.col("c").alias(x), F.col("least").alias(f"least_{x}"), "_n"), x)
    found = save(found.select("a", "b", "na", "nb", F.least("least_a", "least_b").alias("f")), "families")
    classes = found.select("f", F.explode(F.array(F.struct(F.col("a").alias("c"), F.col("na").alias("n")), F.struct(F.col("b").alias("c"), F.col("nb").alias("n")))).alias("e"))
    total = classes.distinct().groupBy("f").agg(F.sum("e.n").alias("total"))
    size = save(total.join(found.groupBy("f").agg(F.count("*").alias("_n")), "f"), "sizes")
    return join_counted(found, size, "f").select("a", "b", F.when(F.col("total") <= TOGETHER, F.col("f")).otherwise(F.xxhash64("a", "b")).alias("f"))


LEAST_BITS, MOST_BITS = 20, 27  # of the bitmap of classes whose sets are needed; sixteen bits a class between them


def _bloom(ids: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the class ids; sets of classes that aren't in it needn't be sent. Tasks' bitmaps are united by 64-bit words: at most 2**21 of them come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(1 << (bits - 6), U64)
        for b in batches:
            for c in range(b.num_columns):
                at = vec.mix(b.column(c).to_numpy().view(U64)) >> U64(64 - bits)
                np.bitwise_or.at(words, (at >> U64(6)).astype(np.int64), U64(1) << (at & U64(63)))
        nz = np.flatnonzero(words)
        yield pa.record_batch([pa.array(nz.astype(np.int32)), pa.array(words[nz].view(np.int64))], names=["at", "word"])

    got = ids.mapInArrow(run, "at int, word bigint").groupBy("at").agg(F.bit_or("word").alias("word")).toPandas()
    words = np.zeros(1 << (bits - 6), U64)
    words[got["at"].to_numpy(np.int64)] = got["word"].to_numpy(np.int64).view(U64)
    return words


def _inside(cid: np.ndarray, words: np.ndarray) -> np.ndarray:
    at = vec.mix(cid.view(U64)) >> U64(64 - (len(words) << 6).bit_length() + 1)
    return (words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1)


def _arrays(k: int, min_words: int, bloom):
    """Task: the set of each class in the bitmap, as 48-bit hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = bloom.value, _Seen()
        for b in batches:
            texts = b.column(0).to_pylist()
            for _, _, runs, n, cid in _sets(texts, k, min_words):
                inside = _inside(cid, words).astype(np.int64)
                last, ids, blobs = np.cumsum(n), [], []
                for i in np.flatnonzero(seen.fresh(cid, n * inside)):
                    own = runs[last[i] - n[i] : last[i]]
                    ids.append(int(cid[i]))
                    blobs.append(own.astype(np.uint32).tobytes() + (own >> U64(32)).astype(np.uint16).tobytes())
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], names=["cid", "runs"])

    return run


def _unpack(blob: bytes) -> np.ndarray:
    n = len(blob) // 6
    return np.frombuffer(blob, np.uint32, n).astype(U64) | (np.frombuffer(blob, np.uint16, n, 4 * n).astype(U64) << U64(32))


def _verify(threshold: float):
    """Task over (f, a, b, runs) in order of f: first the sets of the classes ``a`` (b is null), then the pairs to verify."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}
        for batch in batches:
            out = []
            for f, a, b, runs in zip(*(c.to_pylist() for c in batch.columns)):
                if f != now:
                    now, sets = f, {}
                if b is None:
                    sets[a] = _unpack(runs)
                    continue
                x, y = sets[a], sets[b]
                both = np.sort(np.concatenate((x, y)))
                both = int((both[1:] == both[:-1]).sum())
                j = both / (len(x) + len(y) - both)
                if j >= threshold - 1e-12:
                    out.append((a, b, j))
            a, b, j = zip(*out) if out else ((), (), ())
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(j, pa.float64())], names=["a", "b", "similarity"])

    return run


def class_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, k: int = 5, min_words: int = 0, buckets: int | None = None, most: int = HOT, bucket_bytes: int = BUCKET_BYTES, tile: int = LARGE_TILE) -> tuple[DataFrame, DataFrame]:
    """(members: cid, id) and (pairs of classes: a, b, similarity) of all near duplicates.

    ``buckets``: parts of the key space, each held by one task at a time; by default the session's
    shuffle partitions, or one for every 8 MB of input if that is more.  A bucket of over ``bucket_bytes`` and a group of more than
    ``most`` classes are compared in tiles of about ``tile`` classes by all tasks; these three change no result.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    if buckets is None:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        known = size if size < 1 << 60 else 0  # a plan that isn't over files has no estimate
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), known >> INPUT_A_BUCKET)
    parts = min(buckets, MOST_PARTS)
    survey = save(rows.mapInArrow(_survey(k, min_words), _SURVEY), "survey")
    levels = spark.sparkContext.broadcast(_levels(survey.where("kind = 1").select("a", "b")))
    members = survey.where("kind = 0").select(F.col("a").alias("cid"), F.col("b").alias("id")).distinct()
    sketches = survey.where("kind = 2").select(F.col("a").alias("cid"), F.col("b").alias("n"), *_SKETCH).dropDuplicates(["cid"])

    texts = rows.select("text")
    keys = texts.mapInArrow(_emit(k, min_words, threshold, levels, buckets, parts, most), "part int, bucket bigint, hot boolean, blob binary")
    keys = keys.repartitionById(parts, F.col("part")).sortWithinPartitions("bucket", "hot")
    groups = save(keys.mapInArrow(_group(threshold, most, bucket_bytes), _GROUPS), "groups")
    found = save(_candidates(groups, sketches, threshold, tile), "candidates")
    bits = min(max((32 * max(found.count(), 1)).bit_length(), LEAST_BITS), MOST_BITS)
    bloom = spark.sparkContext.broadcast(_bloom(found.select("a", "b"), bits))
    sets = texts.mapInArrow(_arrays(k, min_words, bloom), "cid bigint, runs binary").groupBy("cid").agg(F.first("runs").alias("runs"))
    found = save(_families(found), "found")
    need = found.select("f", F.explode(F.array("a", "b")).alias("cid")).distinct()
    need = need.join(sets, "cid").select("f", F.col("cid").alias("a"), F.lit(None).cast("bigint").alias("b"), "runs")
    ask = found.select("f", "a", "b", F.lit(None).cast("binary").alias("runs"))
    pairs = need.union(ask).repartition("f").sortWithinPartitions("f", F.col("b").asc_nulls_first()).mapInArrow(_verify(threshold), "a bigint, b bigint, similarity double")
    return members, pairs


def near_duplicate_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, k: int = 5, min_words: int = 0) -> DataFrame:
    """(id_a, id_b) with id_a < id_b: every pair of rows over the threshold.

    Copies come in all pairs, so the result grows with the square of a group of copies; where
    that isn't bounded, use ``near_duplicate_groups``, which has one row per row of ``df``.
    """
    members, pairs = class_pairs(df, id_col, text_col, threshold, k, min_words)
    a, b = (members.select(F.col("cid").alias(c), F.col("id").alias(f"id_{c}")) for c in "ab")
    across = pairs.select("a", "b").join(a, "a").join(b, "b").select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b")).where("id_a < id_b")
    within = a.join(b, [F.col("a") == F.col("b"), F.col("id_a") < F.col("id_b")]).select("id_a", "id_b")
    return across.union(within).distinct()


HOT_SHARE, HOT_ROWS = 10_000, 100_000


def join_counted(big: DataFrame, one: DataFrame, key: str, least: int = HOT_ROWS) -> DataFrame:
    """``big`` joined to ``one``, which has at most one row per key and, as ``_n``, the number of rows of ``big`` with it; both saved.

    Keys with more than 1 / HOT_SHARE of all rows, of which there are fewer than HOT_SHARE, are joined by broadcast
    and lie in no one task; the rest is joined as usual.
    """
    total = one.agg(F.sum("_n")).first()[0] or 0
    hot = one.where(F.col("_n") > max(least, total / HOT_SHARE))
    one_key = F.broadcast(hot.select(key))
    if hot.isEmpty():
        return big.join(one.drop("_n"), key)
    rest = big.join(one_key, key, "left_anti").join(one.join(one_key, key, "left_anti").drop("_n"), key)
    return rest.unionByName(big.join(F.broadcast(hot.drop("_n")), key))


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 40) -> DataFrame:
    """(node, root): the smallest node of each node's component.

    Alternating large-star and small-star steps: linear messages per round, a logarithmic number
    of rounds in practice; each round is a table in the shared folder.  A node with many neighbours is
    joined apart from the others.  Raises if not done in ``rounds``.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = save(e, "edges")
    total = None
    for _ in range(rounds):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = save(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n")).select("u", F.least("u", "m").alias("m"), "_n"), "low")
        large = save(join_counted(both, low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = save(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_n")), "low")
        small = join_counted(large, low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
        e = save(small.select("s.u", "s.v").where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == total:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())
        total = now
    raise RuntimeError(f"components not found in {rounds} rounds")


def near_duplicate_groups(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, k: int = 5, min_words: int = 0) -> DataFrame:
    """One row per row of ``df`` with enough words: id, class id, the class's links to other classes, and the group (smallest class id of the component)."""
    members, pairs = class_pairs(df, id_col, text_col, threshold, k, min_words)
    members, pairs = save(members, "members"), save(pairs, "pairs")
    links = pairs.select(F.explode(F.array("a", "b")).alias("cid")).groupBy("cid").agg(F.count("*").alias("links"))
    root = components(pairs).withColumnRenamed("node", "cid")
    classes = members.groupBy("cid").agg(F.count("*").alias("_n")).join(links, "cid", "left").join(root, "cid", "left")
    classes = save(classes.select("cid", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("group_id"), "_n"), "classes")
    return join_counted(members, classes, "cid").select("id", F.col("cid").alias("class_id"), "links", "group_id")
