"""Counts per page, corpus and topic, and TF-IDF; one corpus per language.

Page terms, (lang, page_id, topic_id, term, abs), are the table from which everything else starts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import columns as C
from lexmill.scratch import save

#: Document frequencies of up to this many words, the most frequent ones, are broadcast: some megabytes.
HOT_WORDS = 100_000


def page_terms(tokens: DataFrame) -> DataFrame:
    """How often each term occurs in each page. Pages without a token have no row."""
    return tokens.groupBy("lang", "page_id", "topic_id", "term").agg(F.count("*").alias("abs"))


def first_terms(tokens: DataFrame) -> DataFrame:
    """Page terms with ``first``, the place of a term's first token in its page; ``tokens`` has ts, rev_id and pos. For stems: no table of tokens is needed."""
    place = F.struct(F.coalesce("ts", F.lit("0001-01-01").cast("timestamp")).alias("ts"), "rev_id", "pos")
    return tokens.groupBy("lang", "page_id", "topic_id", "term").agg(F.count("*").alias("abs"), F.min(place).alias("first"))


def normalised_terms(pages: DataFrame) -> DataFrame:
    """Page terms of pages with token arrays, each page once; null tokens don't count. Pages without an id are told apart by content."""
    pages = pages.select("lang", "page_id", "topic_id", F.flatten(F.filter(F.col("revision.text"), lambda x: x.isNotNull())).alias("tokens"))
    once = pages.withColumn("_alone", F.when(F.col("page_id").isNull(), F.xxhash64("tokens"))).dropDuplicates(["page_id", "_alone"])
    return page_terms(once.select("lang", "page_id", "topic_id", F.explode("tokens").alias("term")).where("term IS NOT NULL"))


def page_totals(terms: DataFrame) -> DataFrame:
    return terms.groupBy("lang", "page_id").agg(F.sum("abs").alias("tot"))


def with_total(terms: DataFrame) -> DataFrame:
    """``tot`` beside every term. Before page terms are saved, a page's lie together and this needs no further exchange; save them with it."""
    return terms if "tot" in terms.columns else terms.withColumn("tot", F.sum("abs").over(Window.partitionBy("lang", "page_id")))


def global_words(terms: DataFrame) -> DataFrame:
    """(lang, term, a, i): occurrences, and pages with the term."""
    return terms.groupBy("lang", "term").agg(F.sum("abs").alias("a"), F.count("*").alias("i"))


def corpus_totals(terms: DataFrame) -> DataFrame:
    """(lang, total_word, total_page): pages without a token aren't counted. Two steps, so that no set of page ids is held."""
    return page_totals(terms).groupBy("lang").agg(F.sum("tot").alias("total_word"), F.count("*").alias("total_page"))


def tfidf(terms: DataFrame, words: DataFrame | None = None, totals: DataFrame | None = None) -> DataFrame:
    """Terms with tot, df, tf, idf and tfidf; ``terms`` and ``words`` saved.

    Totals are one row per language and broadcast.  So are the frequencies of the HOT_WORDS most frequent words, which
    most rows are of; only rows of rarer words are sent to be joined, and no word has many of those.
    """
    words = save(global_words(terms), "words") if words is None else words
    totals = corpus_totals(terms) if totals is None else totals
    df = words.select("lang", "term", F.col("i").alias("df"))
    n = F.broadcast(totals.select("lang", "total_page"))
    terms = with_total(terms)
    least = words.select("i").orderBy(F.col("i").desc()).limit(HOT_WORDS + 1).agg(F.count("*").alias("n"), F.min("i").alias("i")).first()
    if least["n"] <= HOT_WORDS:
        known = terms.join(F.broadcast(df), ["lang", "term"])
    else:  # fewer than HOT_WORDS words are in more pages than this
        both = terms.join(F.broadcast(df.where(F.col("df") > least["i"])), ["lang", "term"], "left")
        rare = both.where("df IS NULL").drop("df").join(df.where(F.col("df") <= least["i"]), ["lang", "term"])
        known = both.where("df IS NOT NULL").unionByName(rare)
    out = known.join(n, "lang")
    return out.select(
        "lang", "page_id", "topic_id", "term", "abs", "tot", "df",
        C.tf(F.col("abs"), F.col("tot")).alias("tf"), C.idf(F.col("total_page"), F.col("df")).alias("idf"),
        C.tfidf(F.col("abs"), F.col("tot"), F.col("total_page"), F.col("df")).alias("tfidf"),
    )


def topic_words(terms: DataFrame, pseudo_word: bool = False) -> DataFrame:
    """(lang, topic_id, term, n_pages): pages of the topic with the term. ``pseudo_word`` adds the empty word, once for each topic."""
    out = terms.groupBy("lang", "topic_id", "term").agg(F.count("*").alias("n_pages"))
    if pseudo_word:
        out = out.unionByName(out.select("lang", "topic_id").distinct().withColumns({"term": F.lit(""), "n_pages": F.lit(1).cast("bigint")}))
    return out


def word_maps(terms: DataFrame, value: str = "abs") -> DataFrame:
    """One row per page with ``words``, a map in key order: for sinks."""
    pairs = F.array_sort(F.collect_list(F.struct("term", value)))
    return with_total(terms).groupBy("lang", "page_id", "topic_id", "tot").agg(F.map_from_entries(pairs).alias("words"))
