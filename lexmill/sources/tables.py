"""Parquet tables of a data folder, and revisions one per row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def revisions(pages: DataFrame) -> DataFrame:
    """One row per delivered revision: page columns and rev_id, ts, text. Pages with null or empty ``revision`` give none."""
    others = [c for c in pages.columns if c not in ("revision", "rev_id", "ts", "text")]
    return pages.select(*others, F.explode("revision").alias("r")).select(*others, "r.rev_id", "r.ts", "r.text")


def pages_of_documents(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, page_id, topic_id, lang, source, rev_ts, text) as delivered pages: each brings one revision of its page. Those without a page have none."""
    revision = F.array(F.struct(F.col("doc_id").alias("rev_id"), F.col("rev_ts").alias("ts"), "text")).alias("revision")
    return docs.where("page_id IS NOT NULL").select("page_id", "topic_id", "lang", "source", F.col("rev_ts").alias("arrived_at"), revision)


def pages_of_turns(turns: DataFrame, page: str, seq: str, text: str, lang: str | None = None) -> DataFrame:
    """Ordered pieces of longer things (turns of a conversation, say) as delivered pages: ``seq`` is the revision's id and gives its time."""
    of = F.col(lang) if lang else F.lit(None).cast("string")
    revision = F.array(F.struct(F.col(seq).cast("bigint").alias("rev_id"), F.timestamp_seconds(seq).alias("ts"), F.col(text).alias("text"))).alias("revision")
    none = F.lit(None)
    return turns.where(F.col(page).isNotNull()).select(F.col(page).alias("page_id"), none.cast("bigint").alias("topic_id"), of.alias("lang"), none.cast("string").alias("source"), none.cast("timestamp").alias("arrived_at"), revision)
