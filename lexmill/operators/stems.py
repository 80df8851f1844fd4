"""Stems and the way back to readable words.

Stemmers run over distinct terms, not tokens, and are joined back.  ``suffix_stem`` is a plain
expression; those of single languages are in ``functions.stemmers``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill import config
from lexmill.functions.stemmers import STEMMERS


def suffix_stem(word: Column) -> Column:
    """Plural endings only: -ies to -y, -es to -e, -s away, but not after the letters that rule it out; short words stay."""
    ies = word.endswith("ies") & ~word.rlike("[ae]ies$")
    es = word.endswith("es") & ~word.rlike("[aeo]es$")
    s = word.endswith("s") & ~word.rlike("[us]s$")
    cut = lambda k: F.left(word, F.length(word) - k)
    return F.when(F.length(word) <= 3, word).when(ies, F.concat(cut(3), F.lit("y"))).when(es, cut(1)).when(s, cut(1)).otherwise(word)


SUFFIX_STEM_SQL = """CASE WHEN length({w}) <= 3 THEN {w} WHEN regexp_matches({w}, 'ies$') AND NOT regexp_matches({w}, '[ae]ies$') THEN left({w}, length({w}) - 3) || 'y'
WHEN regexp_matches({w}, 'es$') AND NOT regexp_matches({w}, '[aeo]es$') THEN left({w}, length({w}) - 1) WHEN regexp_matches({w}, 's$') AND NOT regexp_matches({w}, '[us]s$') THEN left({w}, length({w}) - 1) ELSE {w} END"""

def stem_terms(terms: DataFrame, stem: Callable[[Column], Column] | Callable[[str], str] = suffix_stem, term: str = "term") -> DataFrame:
    """``terms`` with ``stem``. A Python function is applied by Arrow batches to distinct terms."""
    if stem is suffix_stem:
        return terms.withColumn("stem", suffix_stem(F.col(term)))
    import pandas as pd

    def run(batches):
        for pdf in batches:
            yield pdf.assign(stem=pdf[term].map(stem))

    each = terms.select(term).distinct().mapInPandas(run, f"`{term}` string, stem string")
    return terms.join(each, term)


def stem_by_language(terms: DataFrame, suffixes: bool = False) -> DataFrame:
    """``terms``, saved, with ``stem``: each language's terms by the stemmer that ``config.stemmer`` gives it.

    Terms of languages that have none stay as they are, as those of lemmatised languages do; with
    ``suffixes`` they go through the suffix stemmer.  The stemmers see each distinct term once.
    """
    own = [lang for lang in STEMMERS if config.stemmer(lang)]
    special = F.coalesce(F.col("lang").isin(own), F.lit(False))
    rest = terms.where(~special).withColumn("stem", suffix_stem(F.col("term")) if suffixes else F.col("term"))

    def run(batches):
        for pdf in batches:
            yield pdf.assign(stem=[STEMMERS[lang](w) for lang, w in zip(pdf["lang"], pdf["term"])])

    each = terms.where(special).select("lang", "term").distinct().mapInPandas(run, "lang string, term string, stem string")
    return rest.unionByName(terms.where(special).join(each, ["lang", "term"]))


def page_reverse(terms: DataFrame) -> DataFrame:
    """Per page and stem the shortest surface form in code points; of equals, the first in the page.

    ``terms`` are page terms with ``stem`` and ``first`` (see ``counts.first_terms``), or tokens with ts, rev_id, pos, term, stem.
    """
    place = F.col("first") if "first" in terms.columns else F.struct(F.coalesce("ts", F.lit("0001-01-01").cast("timestamp")), "rev_id", "pos")
    return terms.groupBy("lang", "page_id", "stem").agg(F.min_by("term", F.struct(F.length("term"), place)).alias("surface"))


def stemmed_page_terms(terms: DataFrame) -> DataFrame:
    """Page terms by stem, from page terms with ``stem``."""
    return terms.groupBy("lang", "page_id", "topic_id", F.col("stem").alias("term")).agg(F.sum("abs").alias("abs"))


def global_reverse(pages: DataFrame) -> DataFrame:
    """Per stem the shortest page winner in bytes; of equals, that of the first page file in string order."""
    name = F.concat(F.lit("StemRev_"), F.col("page_id").cast("string"), F.lit(".json"))
    return pages.groupBy("lang", "stem").agg(F.min_by("surface", F.struct(F.octet_length("surface"), name)).alias("surface"))


def destem(words: DataFrame, reverse: DataFrame) -> DataFrame:
    """``words`` with ``surface``: the readable form of the term, or the term itself; the term stays, as the key of ties."""
    r = reverse.select("lang", F.col("stem").alias("term"), "surface")
    return words.join(r, ["lang", "term"], "left").withColumn("surface", F.coalesce("surface", "term"))


def destem_lossy(words: DataFrame, reverse: DataFrame) -> DataFrame:
    """As ``destem``, but losing what renaming in place loses: a word stays only if its surface is no key, or sorts before its own key."""
    keys = words.select("lang", F.col("term").alias("surface"), F.lit(True).alias("_is_key")).distinct()
    out = destem(words, reverse).join(keys, ["lang", "surface"], "left")
    has = reverse.select("lang", F.col("stem").alias("term"), F.lit(True).alias("_renamed"))
    out = out.join(has, ["lang", "term"], "left")
    return out.where(F.col("_renamed").isNull() | F.col("_is_key").isNull() | (F.col("surface") < F.col("term"))).drop("_is_key", "_renamed")
