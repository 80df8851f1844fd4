"""Bad words per page by exact match with a lexicon: case counts, and entries of several words never match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill import config

#: A lexicon of up to this many entries is broadcast; a larger one is joined by shuffle.
BROADCAST_ENTRIES = 200_000


def pairs(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Page terms (with tot) that are lexicon entries of the page's language."""
    lex = lexicon.select("lang", F.col("word").alias("term")).where("lang IS NOT NULL AND term IS NOT NULL").distinct()
    if lex.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES:
        lex = F.broadcast(lex)
    return terms.join(lex, ["lang", "term"], "left_semi")


def report(terms: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(lang, page_id, topic_id, abs, rel, occurrences): ``abs`` is the number of distinct bad words and ``rel`` that over the page's tokens. Pages without one have no row."""
    hits = pairs(terms, lexicon)
    out = hits.groupBy("lang", "page_id", "topic_id").agg(F.count("*").alias("abs"), F.sum("abs").alias("occurrences"), F.max("tot").alias("tot"))
    return out.select("lang", "page_id", "topic_id", "abs", (F.col("abs") / F.col("tot")).alias("rel"), "occurrences")


def for_language(terms: DataFrame, lexicon: DataFrame, lang: str) -> DataFrame:
    """The report of one language's pages, empty if that language has no lexicon."""
    own = config.lexicon_language(config.check_language(lang))
    lex = lexicon.where(F.col("lang") == own if own else F.lit(False)).withColumn("lang", F.lit(lang))
    return report(terms.where(F.col("lang") == lang), lex)
