"""Results as the four single files that readers of the older format expect, and back.

Pages, topics and bad words are in the line protocol; words are one JSON object.  Each is one gzip file at level 9: tasks
compress ordered parts, and the parts are put together as they are, as gzip members.
The format has no place for languages, totals of topics or of the corpus, or null ids: one language
goes into a folder, totals are read as null, topics without an id are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import config
from lexmill.sources import results
from lexmill.sources.results import Results

# Names of files and fields.
FILES = {"pages": "GlobalPagesTFIDF_topN.json.gz", "topics": "GlobalTopicsWords_topN.json.gz", "words": "GlobalWords_topN.json.gz", "badwords": "BadWordsReport.json.gz"}
PAGE = "struct<TopicID:bigint,Tot:bigint,Words:map<string,double>>"
BADWORDS = "struct<TopicID:bigint,Abs:bigint,Rel:double,BadW:map<string,bigint>>"
TOTAL = "@TOTAL Words"


def export(found: Results, folder: str, lang: str) -> None:
    """Write one language's results. Bad words only if the language has a lexicon."""
    own = lambda df: df.where(F.col("lang") == lang)
    pages = own(found.pages()).select("page_id", F.struct(F.col("topic_id").alias("TopicID"), F.col("tot").alias("Tot"), F.col("words").alias("Words")).alias("v"))
    topics = own(found.topics()).select("topic_id", F.col("words").alias("v"))
    words = own(found.global_words()).select("term", F.col("a").alias("v"))
    write_file(pages, f"{folder}/{FILES['pages']}", "page_id", "v")
    write_file(topics, f"{folder}/{FILES['topics']}", "topic_id", "v")
    write_file(words, f"{folder}/{FILES['words']}", "term", "v", whole=True)
    if config.lexicon_language(lang) is not None:
        value = F.struct(F.col("topic_id").alias("TopicID"), F.col("abs").alias("Abs"), F.col("rel").alias("Rel"), F.col("badw").alias("BadW"))
        write_file(own(found.badwords()).select("page_id", value.alias("v")), f"{folder}/{FILES['badwords']}", "page_id", "v")


def write_file(df: DataFrame, path: str, key: str, value: str, whole: bool = False) -> None:
    """One gzip file of entries in order of the key. ``whole``: a valid JSON object, without the line protocol's last comma."""
    parts = f"{path}.parts"
    results.write_lines(df, parts, key, value, gzip=True, whole=whole)
    results.join_parts(df.sparkSession, parts, path)


class Layout:
    """The files of one language; opening checks that they are there."""

    def __init__(self, spark: SparkSession, folder: str, lang: str):
        self.spark, self.folder, self.lang = spark, folder, config.check_language(lang)
        self.has_badwords = config.lexicon_language(lang) is not None
        for path in self._paths():
            p, fs = results.path_of(spark, path)
            if not fs.exists(p):
                raise FileNotFoundError(path)

    def _paths(self) -> list[str]:
        return [f"{self.folder}/{name}" for kind, name in FILES.items() if kind != "badwords" or self.has_badwords]

    def _lines(self, kind: str, value: str) -> DataFrame:
        lines = results.read_lines(self.spark, f"{self.folder}/{FILES[kind]}", value)
        return lines.select(F.lit(self.lang).alias("lang"), F.col("key").try_cast("bigint").alias("key"), "value")

    def pages(self) -> DataFrame:
        return self._lines("pages", PAGE).select("lang", F.col("key").alias("page_id"), F.col("value.TopicID").alias("topic_id"), F.col("value.Tot").alias("tot"), F.col("value.Words").alias("words"))

    def topics(self) -> DataFrame:
        return self._lines("topics", "map<string,bigint>").select("lang", F.col("key").alias("topic_id"), F.lit(None).cast("bigint").alias("tot"), F.col("value").alias("words"))

    def global_words(self) -> DataFrame:
        """Words and occurrences; their total in the corpus if the file states it."""
        lines = results.read_lines(self.spark, f"{self.folder}/{FILES['words']}", "bigint")
        total = lines.where(F.col("key") == TOTAL).agg(F.max("value")).first()[0]
        return lines.where(F.col("key") != TOTAL).select(F.lit(self.lang).alias("lang"), F.col("key").alias("term"), F.col("value").alias("a"), F.lit(total).cast("bigint").alias("total_word"))

    def badwords(self) -> DataFrame:
        """Empty if the language has no lexicon."""
        if not self.has_badwords:
            return self.spark.createDataFrame([], results.SCHEMAS["badwords"])
        v = F.col("value")
        return self._lines("badwords", BADWORDS).select("lang", F.col("key").alias("page_id"), v["TopicID"].alias("topic_id"), v["Abs"].alias("abs"), v["Rel"].alias("rel"), v["BadW"].alias("badw"))

    def delete(self) -> None:
        """Remove these files and nothing else."""
        for path in self._paths():
            p, fs = results.path_of(self.spark, path)
            fs.delete(p, True)
