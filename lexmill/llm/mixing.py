"""Mixing sources to target shares by systematic sampling.

Each source s gets the same expected number of copies for each of its texts, e = T * share / tokens available,
where T is the size of the whole.  In every source the texts are put in order of size
(then by a hash), expected copies are summed along that order, one random offset is added, and a text is
emitted once for every integer that its stretch crosses: floor(e) or ceil(e) times, and e times on average over the
offsets.  The order by size keeps the tokens reached within one of the source's largest texts of the target; where a source has
a few huge texts, its share can miss the target by that much, which ``shares`` reports.

The sum along the order is distributed: counts by size, by hash bucket within a size, and ranks
within a bucket, so that no task holds a whole source.

Sources are compared without case and outer spaces.  Null, empty or token-less texts,
null sources and sources without a target are not used.  Of the rest, texts that come under several ids
count as one text, that of the smallest id, whatever its source.  Sources without documents can't be reached; the others' shares are scaled up to 1.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.scratch import save

TOKENIZER = "byte_bpe_50k.tiktoken"  # of the public vocabularies
#: The split of a text into pieces before merges, fixed with the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BUCKETS = 1024


def vocabulary(path: str = TOKENIZER) -> bytes:
    """The vocabulary file; a name without a folder is one of the installed public vocabularies. Read on the driver, and sent to the tasks: under a megabyte."""
    if "/" not in path:
        try:
            import public_tokenizers

            path = str(public_tokenizers.path(path))
        except ImportError:
            path = f"/opt/tokenizers/{path}"
    with open(path, "rb") as f:
        return f.read()


@functools.cache
def tokenizer(ranks: bytes):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines())
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})


def _count(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(ranks.value).encode_ordinary
        for b in batches:
            n = pa.array([len(encode(t)) for t in b.column(4).to_pylist()], pa.int64())
            yield pa.record_batch([*b.columns[:4], n], names=["id", "source", "h1", "h2", "tokens"])

    return run


def source_name(c: Column) -> Column:
    return F.lower(F.trim(c))


def wanted(targets: DataFrame) -> DataFrame:
    """The targets that can be used, by source."""
    rows = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeat")
    return rows.where("source IS NOT NULL AND target_share > 0 AND max_repeat > 0").distinct()


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, tokenizer_path: str = TOKENIZER, targets: DataFrame | None = None) -> DataFrame:
    """(id, source, h1, tokens) of each distinct text; only of sources in ``targets``, if these are given."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), source_name(F.col(source_col)).alias("source"), F.xxhash64(text_col).alias("h1"), F.xxhash64(F.lit("2"), F.col(text_col), F.length(text_col)).alias("h2"), F.col(text_col).alias("text"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL AND text <> '' AND source IS NOT NULL")
    if targets is not None:
        names = wanted(targets).select(F.col("source").alias("target")).distinct()
        rows = rows.join(F.broadcast(names), F.col("source") == F.col("target"), "left_semi")
    counted = save(rows.mapInArrow(_count(docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer_path))), "id bigint, source string, h1 bigint, h2 bigint, tokens bigint"), "sized")
    first = counted.groupBy("h1", "h2").agg(F.min(F.struct("id", "source", "tokens")).alias("first"))
    return first.select("first.id", "first.source", "h1", "first.tokens").where("tokens > 0")


def plan(texts: DataFrame, targets: DataFrame, total: int | None = None) -> list[dict]:
    """One entry per target source: available texts and tokens, and expected copies of each text."""
    want = [(r["source"], float(r["target_share"]), int(r["max_repeat"])) for r in wanted(targets).collect()]
    have = {r["source"]: (r["n"], r["t"]) for r in texts.where(F.col("source").isin([s for s, _, _ in want])).groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).collect()}
    present = sum(share for s, share, _ in want if s in have)
    reach = [have[s][1] * most / (share / present) for s, share, most in want if s in have]
    size = min(reach, default=0) if total is None else total
    out = []
    for s, share, most in want:
        n, tokens = have.get(s, (0, 0))
        e = min(size * share / present / tokens, float(most)) if tokens else 0.0
        out.append({"source": s, "target_share": share, "max_repeat": most, "texts": n, "tokens": tokens, "copies": e})
    return out


def mix(texts: DataFrame, entries: list[dict], seed: int = 42) -> DataFrame:
    """(id, source, tokens, copies) of the texts used; ``texts`` as from ``sized``, saved."""
    spark = texts.sparkSession
    rates = spark.createDataFrame([(e["source"], e["copies"]) for e in entries], "source string, rate double")
    rows = texts.join(F.broadcast(rates), "source").where("rate > 0").withColumn("bucket", F.pmod("h1", F.lit(BUCKETS)).cast("int"))
    small = rows.groupBy("source", "tokens", "bucket").agg(F.count("*").alias("n"))
    sizes = small.groupBy("source", "tokens").agg(F.sum("n").alias("n"))
    before = lambda *part: Window.partitionBy(*part[:-1]).orderBy(part[-1]).rowsBetween(Window.unboundedPreceding, -1)
    by_size = sizes.select("source", "tokens", F.coalesce(F.sum("n").over(before("source", "tokens")), F.lit(0)).alias("under"))
    by_bucket = small.select("source", "tokens", "bucket", F.coalesce(F.sum("n").over(before("source", "tokens", "bucket")), F.lit(0)).alias("ahead"))
    rank = F.row_number().over(Window.partitionBy("source", "tokens", "bucket").orderBy("h1", "id"))
    placed = rows.withColumn("rank", rank).join(by_bucket, ["source", "tokens", "bucket"]).join(by_size, ["source", "tokens"])
    at, rate = F.col("under") + F.col("ahead") + F.col("rank"), F.col("rate")
    offset = F.pmod(F.xxhash64(F.lit(seed), "source"), F.lit(1 << 40)) / float(1 << 40)
    crossed = F.floor(offset + at * rate) - F.floor(offset + (at - 1) * rate)
    return placed.select("id", "source", "tokens", crossed.cast("bigint").alias("copies")).where("copies > 0")


def shares(mixed: DataFrame, entries: list[dict]) -> DataFrame:
    """Per target source: target and actual share, tokens and texts available and used."""
    spark = mixed.sparkSession
    plan_rows = spark.createDataFrame([(e["source"], e["target_share"], e["max_repeat"], e["texts"], e["tokens"], e["copies"]) for e in entries], "source string, target_share double, max_repeat bigint, texts bigint, tokens bigint, rate double")
    used = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used_tokens"), F.count("*").alias("used_texts"), F.max("copies").alias("most_copies"))
    out = F.broadcast(plan_rows).join(used, "source", "left").fillna(0, ["used_tokens", "used_texts", "most_copies"])
    whole = F.sum("used_tokens").over(Window.partitionBy())
    return out.withColumn("actual_share", F.coalesce(F.col("used_tokens") / whole, F.lit(0.0)))
