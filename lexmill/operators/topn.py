"""Cuts to the top N. Ties: the smaller key by its UTF-8 bytes; the key is the term before de-stemming.

Ranks with a limit are trimmed within each task before the exchange, so a hot group sends at most
N rows from every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import columns as C


def _ranked(df: DataFrame, groups: list[str], value: str, key: str, n: int) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.col(value).desc_nulls_last(), F.col(key).asc())
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _length(lang: str | Column = "lang") -> Column:
    return C.good_length(F.col("term"), F.coalesce(F.col(lang) if isinstance(lang, str) else lang, F.lit("")))


def page_top(words: DataFrame, n: int, key: str = "term") -> DataFrame:
    """The n words of each page with the highest tfidf; the length filter comes after the cut, and only where something was cut."""
    top = _ranked(words, ["lang", "page_id"], "tfidf", key, n + 1)
    cut = F.max("rank").over(Window.partitionBy("lang", "page_id")) > n
    return top.withColumn("_cut", cut).where((F.col("rank") <= n) & (~F.col("_cut") | _length())).drop("_cut")


def global_top(words: DataFrame, n: int, key: str = "term") -> DataFrame:
    """The n words of each language with the most occurrences; the length filter comes first."""
    return _ranked(words.where(_length()), ["lang"], "a", key, n)


def topic_top(words: DataFrame, n: int, key: str = "term") -> DataFrame:
    """The n words of each topic in most pages, then the length filter: the empty pseudo-word can use up a place."""
    return _ranked(words, ["lang", "topic_id"], "n_pages", key, n).where(_length())
