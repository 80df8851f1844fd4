"""Splitting long texts: content-defined landmarks, moved to natural boundaries.

A rolling hash over ``WINDOW`` characters makes a landmark wherever its first bits are zero, so
landmarks move with the content: an edit alters only the pieces near it.  A piece ends at the
first landmark at least ``minimum`` characters on, moved to the nearest natural boundary within
[minimum, maximum]: a paragraph's end if one is near, else a sentence's, a line's, a word's.  Without
a landmark the last natural boundary before the maximum serves; without any boundary the cut
is made at the landmark or the maximum.  The next piece begins up to ``overlap`` characters
before that end, at a word's beginning where there is one.

Null texts give no piece, empty ones a single empty piece.  Characters are code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import vec

U64 = np.uint64
WINDOW = 32
LANDMARK_BITS = 10
NEAR = 400
OUT_CHARS = 4_000_000  # sent at once
STOPS = np.array([ord(c) for c in ".!?。！？…"], np.uint32)


def landmarks(cp: np.ndarray) -> np.ndarray:
    """Positions after windows whose hash begins with LANDMARK_BITS zero bits."""
    if len(cp) < WINDOW:
        return np.zeros(0, np.int64)
    pw, inv = vec.powers(len(cp) + 1)
    total = np.zeros(len(cp) + 1, U64)
    np.cumsum(vec.char_table()[cp] * pw[: len(cp)], out=total[1:])
    h = vec.mix((total[WINDOW:] - total[:-WINDOW]) * inv[: len(cp) - WINDOW + 1])
    return np.flatnonzero(h >> U64(64 - LANDMARK_BITS) == 0) + WINDOW


def boundaries(cp: np.ndarray) -> tuple[np.ndarray, ...]:
    """Positions at which a text may be cut, best first: after paragraphs, sentences, lines, words."""
    space = (cp == 32) | ((cp >= 9) & (cp <= 13)) | (cp == 0x3000) | (cp == 0xA0)
    line = np.flatnonzero(cp == 10) + 1
    paragraph = line[np.isin(line - 2, np.flatnonzero(cp == 10))]
    stop = np.isin(cp, STOPS)
    wide = cp >= 0x3000
    after = np.zeros(len(cp), bool)
    after[:-1] = stop[:-1] & (space[1:] | wide[:-1]) & ~stop[1:]
    return paragraph, np.flatnonzero(after) + 1, line, np.flatnonzero(space[:-1] & ~space[1:]) + 1 if len(cp) else np.zeros(0, np.int64)


def _between(x: np.ndarray, lo: int, hi: int) -> np.ndarray:
    return x[np.searchsorted(x, lo) : np.searchsorted(x, hi, side="right")]


def cuts(text: str, maximum: int, minimum: int, overlap: int) -> list[tuple[int, int]]:
    """(begin, end) of each piece in code points."""
    n = len(text)
    if n <= maximum:
        return [(0, n)]
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    marks, levels = landmarks(cp), boundaries(cp)
    out, begin, core = [], 0, 0
    while n - begin > maximum:
        lo, hi = max(core + 1, begin + minimum), begin + maximum
        mark = _between(marks, lo, hi)
        target, end = (int(mark[0]), None) if len(mark) else (hi, None)
        for near in (NEAR, maximum):
            for level in levels:
                at = _between(level, max(lo, target - near), min(hi, target + near))
                if len(at):
                    end = int(at[np.argmin(np.abs(at - target))])
                    break
            if end is not None:
                break
        end = end or target
        out.append((begin, end))
        core, begin = end, end
        if overlap:
            at = _between(levels[3], end - overlap, end - 1)
            begin = int(at[0]) if len(at) else end - overlap
    out.append((begin, n))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["id", "piece", "n_pieces", "begin", "text"])


def _split(maximum: int, minimum: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            rows, size = [], 0
            for i, text in zip(ids, b.column(1).to_pylist()):
                spans = cuts(text, maximum, minimum, overlap)
                rows += [(i, k, len(spans), s, text[s:e]) for k, (s, e) in enumerate(spans)]
                size += len(text)
                if size > OUT_CHARS:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return run


def split_long(df: DataFrame, id_col: str, text_col: str, maximum: int = 6000, minimum: int = 3000, overlap: int = 200) -> DataFrame:
    """(id, piece, n_pieces, begin, text): every text as pieces in order, numbered from 0; ``begin`` is the piece's offset in code points.

    Texts within the limit are one piece and don't leave the JVM.  Rows with the same id and text count once.
    """
    if not 0 <= overlap < minimum <= maximum - overlap:
        raise ValueError("need 0 <= overlap < minimum <= maximum - overlap")
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    short = rows.where(F.length("text") <= maximum).select("id", F.lit(0).cast("bigint").alias("piece"), F.lit(1).cast("bigint").alias("n_pieces"), F.lit(0).cast("bigint").alias("begin"), "text")
    return short.distinct().union(long_pieces(df, id_col, text_col, maximum, minimum, overlap))


def long_pieces(df: DataFrame, id_col: str, text_col: str, maximum: int = 6000, minimum: int = 3000, overlap: int = 200) -> DataFrame:
    """Of ``split_long``, the pieces of texts over the limit."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(F.length(text_col) > maximum)
    return rows.distinct().mapInArrow(_split(maximum, minimum, overlap), "id bigint, piece bigint, n_pieces bigint, begin bigint, text string")
