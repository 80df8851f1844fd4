"""The whole run: delivered pages in, top words, topics, totals and bad words out."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill import config
from lexmill.operators import badwords, counts, pages, stems, text, topn
from lexmill.scratch import finished, save
from lexmill.sources import results
from lexmill.sources.tables import revisions

log = logging.getLogger("lexmill")

LANGS = ("en", "de", "fr", "es", "pl", "zh")


def reduced(delivered: DataFrame, n: int, budget: int = config.CHAR_BUDGET) -> DataFrame:
    """The latest n revisions of each page within the character budget: (lang, page_id, topic_id, rev_id, ts, text). A null language becomes the empty one."""
    revs = revisions(delivered).select(F.coalesce("lang", F.lit("")).alias("lang"), "page_id", "topic_id", "rev_id", "ts", "text")
    return pages.char_budget(pages.latest_revisions(revs, n), budget)


def tokens(delivered: DataFrame, n: int = 10, langs: tuple[str, ...] = LANGS, provider: str = "blank", bad_records: str = "fail") -> DataFrame:
    return text.normalise(reduced(delivered, n), text.stopword_table(delivered.sparkSession, list(langs)), provider, bad_records=bad_records)


def terms(delivered: DataFrame, n: int = 10) -> DataFrame:
    return counts.page_terms(tokens(delivered, n))


@dataclass
class Engine:
    """One run over a table of delivered pages; every language in it is a corpus of its own.

    ``stem``: '' for none, 'languages' for the stemmers of languages that have one, 'suffixes' to put the suffix stemmer on all others as well.
    ``work``: a folder for the tables between the steps.  A run that finds finished tables there goes on from them, so a
    failed run can be started again; give each run over other data its own.  Without it they are private and go at the end.
    ``lemmas``: a dictionary for ``text.lemmatise``.  ``bad_records``: 'fail' or 'drop', for texts that the provider can't take.
    """

    limits: config.Limits = config.Limits()
    provider: str = "blank"
    stem: str = ""
    work: str | None = None
    lemmas: DataFrame | None = None
    bad_records: str = "fail"

    def step(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table between the steps, computed unless an earlier run has finished it."""
        began = time.monotonic()
        if self.work is None:
            out = save(make(), name)
        elif (done := finished(path := f"{self.work}/{name}")) is not None:
            log.info("step %s: found in %s", name, path)
            return done
        else:
            make().write.mode("overwrite").option("compression", "zstd").parquet(path)
            out = finished(path)
        log.info("step %s: %.1f s", name, time.monotonic() - began)
        return out

    def run(self, delivered: DataFrame, lexicon: DataFrame, folder: str, lang: str | None = None) -> results.Results:
        """Write all results into ``folder`` and open them. Page terms are written once, with their page's total, and read by every later step."""
        if self.stem not in ("", "languages", "suffixes"):
            raise ValueError(f"no way of stemming {self.stem!r}")
        spark = delivered.sparkSession
        if lang is not None:
            delivered = delivered.where(F.col("lang") == config.check_language(lang))
        langs = tuple(LANGS) if lang is None else (lang,)
        toks = tokens(delivered, self.limits.revisions, langs, self.provider, self.bad_records)
        if self.lemmas is not None:
            toks = text.lemmatise(toks, self.lemmas)
        if self.stem:
            surface = self.step("surface", lambda: counts.first_terms(toks))
            stemmed = self.step("stemmed", lambda: stems.stem_by_language(surface, self.stem == "suffixes"))
            back = self.step("stems", lambda: stems.global_reverse(stems.page_reverse(stemmed)))
            page_terms = self.step("terms", lambda: counts.with_total(stems.stemmed_page_terms(stemmed)))
        else:
            page_terms = self.step("terms", lambda: counts.with_total(counts.page_terms(toks)))
        words, totals = self.step("words", lambda: counts.global_words(page_terms)), self.step("totals", lambda: counts.corpus_totals(page_terms))
        scored = counts.tfidf(page_terms, words, totals)
        page = ["lang", "page_id", "topic_id", "tot"]
        if self.stem:
            scored, words = self.step("scored", lambda: stems.destem(scored, back)), stems.destem(words, back)
            readable = self.step("readable", lambda: scored.groupBy(*page, F.col("surface").alias("term")).agg(F.sum("abs").alias("abs")))
            top = topn.page_top(scored, self.limits.page_words).groupBy(*page, "surface").agg(F.max("tfidf").alias("tfidf"))
        else:  # a term is its own surface, and once in a page
            readable, words = page_terms, words.withColumn("surface", F.col("term"))
            top = topn.page_top(scored, self.limits.page_words).withColumnRenamed("term", "surface")
        as_map = lambda v: F.map_from_entries(F.array_sort(F.collect_list(F.struct("surface", v)))).alias("words")
        results.write(top.groupBy(*page).agg(as_map("tfidf")), folder, "pages")
        topics = self.step("topics", lambda: counts.topic_words(readable, pseudo_word=True))
        whole = topics.where("term <> ''").groupBy("lang", "topic_id").agg(F.sum("n_pages").alias("tot"))
        cut = topn.topic_top(topics, self.limits.topic_words).withColumn("surface", F.col("term")).groupBy("lang", "topic_id").agg(as_map("n_pages"))
        results.write(_join_topic(cut, whole), folder, "topics")
        results.write(topn.global_top(words, self.limits.global_words).drop("term").withColumnRenamed("surface", "term"), folder, "words")
        results.write(totals, folder, "totals")
        hits = badwords.pairs(readable, lexicon).groupBy("lang", "page_id", "topic_id", "tot")
        out = hits.agg(F.count("*").alias("abs"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", F.lit(1).cast("bigint"))))).alias("badw"))
        results.write(out.withColumn("rel", F.col("abs") / F.col("tot")), folder, "badwords")
        log.info("results in %s", folder)
        return results.Results(spark, folder, lang)


def _join_topic(cut: DataFrame, whole: DataFrame) -> DataFrame:
    """Topics joined by language and topic, a null topic with itself."""
    w = whole.select(F.col("lang").alias("_l"), F.col("topic_id").alias("_t"), "tot")
    return cut.join(w, (F.col("lang") == F.col("_l")) & F.col("topic_id").eqNullSafe(F.col("_t"))).drop("_l", "_t")
