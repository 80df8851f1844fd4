"""From texts to tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from lexmill import config
from lexmill.functions import columns as C

#: Language providers: DataFrame with ``text`` and ``lang``, what to do with bad records -> the same with ``tokens`` in place of ``text``.
PROVIDERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {}


def provider(name: str):
    """Register a provider of tokens: a tagger, lemmatiser or segmenter may replace the blank one."""

    def register(f):
        PROVIDERS[name] = f
        return f

    return register


@provider("blank")
def blank(df: DataFrame, bad_records: str = "fail") -> DataFrame:
    return df.withColumn("tokens", C.tokens(F.col("text"))).drop("text")


def text_provider(name: str):
    """Register a provider made from ``make()``, called once in each task: it gives a function from text and language to tokens.

    A text that it can't take ends the run, or, with ``bad_records`` 'drop', is logged and has no tokens.
    """

    def register(make: Callable[[], Callable[[str, str | None], list[str]]]):
        @provider(name)
        def run(df: DataFrame, bad_records: str = "fail") -> DataFrame:
            import pandas as pd

            def each(batches):
                tokens_of = make()
                for pdf in batches:
                    out = []
                    for lang, text in zip(pdf["lang"], pdf["text"]):
                        try:
                            out.append(list(tokens_of(text, lang)) if isinstance(text, str) else [])
                        except Exception:
                            if bad_records != "drop":
                                raise
                            config.log.exception("provider %s: a text of %d characters has no tokens", name, len(text))
                            out.append([])
                    yield pdf.drop(columns="text").assign(tokens=pd.Series(out, dtype=object))

            rest = df.drop("text")
            return df.select(*rest.columns, "text").mapInPandas(each, StructType([*rest.schema.fields, StructField("tokens", ArrayType(StringType()))]))

        return make

    return register


@text_provider("spacy")
def spacy_tokens():
    """Lemmas of adjectives, adverbs, nouns and verbs where the language's model lemmatises, else its lower-cased tokens. Needs spaCy and its models on the executors."""
    import spacy

    models = {}

    def tokens_of(text: str, lang: str | None) -> list[str]:
        if lang not in models:
            name, lemmas = config.nlp_model(lang or "xx")
            models[lang] = (spacy.load(name, exclude=["parser", "ner"]) if "_" in name else spacy.blank(name)), lemmas
        nlp, lemmas = models[lang]
        return [t.lemma_ for t in nlp(text) if t.pos_ in config.KEPT_POS] if lemmas else [t.lower_ for t in nlp(text)]

    return tokens_of


def lemmatise(terms: DataFrame, lemmas: DataFrame) -> DataFrame:
    """``terms`` (tokens, or better distinct page terms) with lemmas for words, less those whose part of speech isn't kept.

    ``lemmas``: (lang, word, lemma, pos), a dictionary with at most one row per word; Spark chooses how to join it.  Words that it lacks stay
    as they are, as do those with a null pos; a null lemma is the word itself.
    """
    table = lemmas.select("lang", F.col("word").alias("term"), "lemma", "pos")
    joined = terms.join(table, ["lang", "term"], "left")
    kept = joined.where(F.col("pos").isNull() | F.col("pos").isin(*config.KEPT_POS))
    return kept.withColumn("term", F.coalesce("lemma", "term")).drop("lemma", "pos")


def stopword_table(spark, langs: list[str]) -> DataFrame:
    """(lang, word): the stopwords of the given languages, a table of fixed size."""
    return spark.createDataFrame([(x, w) for x in sorted(langs) for w in sorted(config.stopwords(x))], "lang string, word string")


def explode_tokens(df: DataFrame) -> DataFrame:
    """One row per alphabetic token, with ``pos`` its place in the text.

    The outer form is meant: for the inner one the optimiser adds a filter on the array's size, which evaluates the whole cleaning twice.
    """
    others = [c for c in df.columns if c != "tokens"]
    return df.select(*others, F.posexplode_outer("tokens").alias("pos", "term")).where(C.alphabetic(F.col("term")))


def drop_stopwords(tokens: DataFrame, stop: DataFrame, other: frozenset[str] | None = None) -> DataFrame:
    """Tokens that, in lower case, are no stopword of their language; languages that ``stop`` lacks use the English list.

    ``stop`` is of fixed size (a few hundred words for each language) and broadcast.
    """
    other = config.stopwords("") if other is None else other
    s = F.broadcast(stop.select(F.col("lang").alias("_l"), F.col("word").alias("_w")))
    kept = tokens.join(s, (F.col("lang") == F.col("_l")) & (F.lower("term") == F.col("_w")), "left_anti")
    known = [r[0] for r in stop.select("lang").distinct().collect()]
    return kept.where(F.col("lang").isin(known) | ~F.lower("term").isin(sorted(other)))


def drop_bad_lengths(tokens: DataFrame) -> DataFrame:
    return tokens.where(C.good_length(F.col("term"), F.coalesce("lang", F.lit(""))))


def legacy_filter(tokens: DataFrame) -> DataFrame:
    """The older rule: 4 to 50 characters and no word of HTML."""
    return tokens.where(F.length("term").between(4, 50) & ~F.col("term").isin(*config.HTML_WORDS))


def normalise(revs: DataFrame, stop: DataFrame, name: str = "blank", markup: bool = True, bad_records: str = "fail") -> DataFrame:
    """Tokens of cleaned texts after all filters: columns of ``revs`` without text, with pos and term."""
    if name not in PROVIDERS:
        raise ValueError(f"no provider {name!r}")
    if markup:
        revs = revs.withColumn("text", C.clean_markup(F.col("text")))
    return drop_bad_lengths(drop_stopwords(explode_tokens(PROVIDERS[name](revs, bad_records)), stop))
