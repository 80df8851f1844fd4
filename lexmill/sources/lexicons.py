"""Lexicons: one verbatim entry per line, in files named by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import config


def read(spark: SparkSession, folder: str, lang: str) -> DataFrame:
    """(lang, word) of a language's file, <folder>/<English name>; empty if the language has no lexicon. A missing file is an error."""
    own = config.lexicon_language(lang)
    if own is None:
        return spark.createDataFrame([], "lang string, word string")
    lines = spark.read.text(f"{folder}/{config.LANGUAGE_NAMES[own]}")
    return lines.select(F.lit(lang).alias("lang"), F.col("value").alias("word"))
