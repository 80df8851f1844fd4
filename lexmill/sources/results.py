"""Results on disk: gzipped JSON lines, a line protocol for exchange, and a typed reader."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import config
from lexmill.scratch import save

NAMES = {"pages": "pages_top", "topics": "topics_top", "words": "words_top", "totals": "totals", "badwords": "badwords"}
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_COMPRESSION"}  # level 9
SCHEMAS = {
    "pages": "lang string, page_id bigint, topic_id bigint, tot bigint, words map<string,double>",
    "topics": "lang string, topic_id bigint, tot bigint, words map<string,bigint>",
    "words": "lang string, term string, a bigint, i bigint",
    "totals": "lang string, total_word bigint, total_page bigint",
    "badwords": "lang string, page_id bigint, topic_id bigint, abs bigint, rel double, badw map<string,bigint>",
}


def path_of(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write(df: DataFrame, folder: str, kind: str) -> None:
    """One result as gzipped JSON lines, level 9."""
    df.select(*(c.split()[0] for c in SCHEMAS[kind].split(", "))).write.mode("overwrite").options(**GZIP).json(f"{folder}/{NAMES[kind]}")


class Results:
    """The results in a folder; opening checks that all of them are there."""

    def __init__(self, spark: SparkSession, folder: str, lang: str | None = None):
        if lang is not None:
            config.check_language(lang)
        self.spark, self.folder, self.lang = spark, folder, lang
        self.has_badwords = lang is None or config.lexicon_language(lang) is not None
        for kind in NAMES:
            p, fs = path_of(spark, f"{folder}/{NAMES[kind]}")
            if (kind != "badwords" or self.has_badwords) and not fs.exists(p):
                raise FileNotFoundError(str(p))

    def _read(self, kind: str) -> DataFrame:
        df = self.spark.read.schema(SCHEMAS[kind]).json(f"{self.folder}/{NAMES[kind]}")
        return df if self.lang is None else df.where(F.col("lang") == self.lang)

    def pages(self) -> DataFrame:
        """Page id, topic, true total and top words."""
        return self._read("pages")

    def topics(self) -> DataFrame:
        """Topic, the total of its page counts before the cut, and top words."""
        return self._read("topics")

    def global_words(self) -> DataFrame:
        """Top words with the corpus's true totals."""
        return self._read("words").join(F.broadcast(self._read("totals")), "lang")

    def badwords(self) -> DataFrame:
        """Bad words by page; empty if the language has no lexicon."""
        return self._read("badwords") if self.has_badwords else self.spark.createDataFrame([], SCHEMAS["badwords"])

    def iterate(self, kind: str, order: str) -> Iterator:
        """Rows in order, partition by partition, for a consumer that streams."""
        return self._read(kind).orderBy(order).toLocalIterator()

    def delete(self) -> None:
        """Remove the results' own folders and nothing else."""
        for name in NAMES.values():
            p, fs = path_of(self.spark, f"{self.folder}/{name}")
            if fs.exists(p):
                fs.delete(p, True)


def write_lines(df: DataFrame, path: str, key: str, value: str, gzip: bool = False, whole: bool = False) -> None:
    """The line protocol: an opening brace before the first entry, ``"key":json,`` on each line, a closing brace at the end.

    Parts are ordered by key and, read one after the other, are the file; all tasks write.  Rows with a null key are left out.
    ``gzip``: compress the parts at level 9.  ``whole``: no comma after the last entry, so that all parts together are valid JSON.
    """
    rows = save(df.where(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(value).alias("v")), "entries")
    ends = rows.agg(F.min("key").alias("first"), F.max("key").alias("last")).first()
    json = lambda c: F.to_json(F.struct(c.alias("x")), {"ignoreNullFields": "false"})
    bare = lambda c: F.substring(json(c), F.lit(6), F.length(json(c)) - 6)  # noqa: E731 - what is between {"x": and }
    opening, comma = F.when(F.col("key") == F.lit(ends["first"]), "{").otherwise(""), F.when((F.col("key") == F.lit(ends["last"])) & F.lit(whole), "").otherwise(",")
    lines = rows.select("key", F.concat(opening, bare(F.col("key").cast("string")), F.lit(":"), bare(F.col("v")), comma).alias("value"))
    closing = df.sparkSession.createDataFrame([(None, "}" if ends["first"] is not None else "{}")], lines.schema)
    out = lines.union(closing).orderBy(F.col("key").asc_nulls_last()).select("value").write.mode("overwrite")
    if gzip:
        out = out.options(**GZIP)
    out.text(path)


def join_parts(spark: SparkSession, parts: str, path: str) -> None:
    """Put the parts together, in order and as they are, into one file, which replaces what is there; the parts go. The bytes stream through the driver."""
    p, fs = path_of(spark, parts)
    to, _ = path_of(spark, path)
    names = sorted(s.getPath().getName() for s in fs.listStatus(p))
    beside, _ = path_of(spark, f"{path}.new")
    out = fs.create(beside, True)
    try:
        for name in names:
            if name.startswith("part-"):
                source = fs.open(path_of(spark, f"{parts}/{name}")[0])
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
                source.close()
    finally:
        out.close()
    fs.delete(to, False)
    fs.rename(beside, to)
    fs.delete(p, True)


def read_lines(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(key, value) of files in the line protocol; ``value`` is the type's DDL. Lines may be of any length."""
    lines = spark.read.text(path).where("value NOT IN ('}', '{}')")
    wrapped = F.concat(F.lit("{"), F.regexp_replace(F.regexp_replace("value", r"^\{", ""), r",\s*$", ""), F.lit("}"))
    kind = f"map<string,{value}>"  # a line that is whole by itself is read as it is
    return lines.select(F.explode(F.coalesce(F.from_json(wrapped, kind), F.from_json("value", kind))).alias("key", "value"))
