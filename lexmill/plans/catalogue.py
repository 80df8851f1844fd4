"""The catalogue: every operator as a query over whole tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill import config
from lexmill.functions import columns as C
from lexmill.operators import badwords, counts, pages, stems, text, topn
from lexmill.plans import pipeline
from lexmill.scratch import new_path, save
from lexmill.sources import layout, results
from lexmill.sources.tables import pages_of_documents, revisions, table
from lexmill.streaming.upsert import RevisionStore, follow

LIMITS = config.Limits()
START, END = "2019-06-01T00:00", "2020-06-01T00:00"
SMALL_BUDGET = 5_000

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL."""

    def register(f):
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    lists = ", ".join(f"('{x}', [{_quoted(config.stopwords(x))}])" for x in pipeline.LANGS)
    return {name: sql.replace("@STOPWORDS@", lists).replace("@ENGLISH@", _quoted(config.stopwords(""))) for name, sql in _SQL.items()}


def _delivered(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "reduced_page")


def _revs(spark: SparkSession, d: str) -> DataFrame:
    return revisions(_delivered(spark, d)).select(F.coalesce("lang", F.lit("")).alias("lang"), "page_id", "topic_id", "rev_id", "ts", "text")


# ---- SQL parts -------------------------------------------------------------------------------

_LETTERS = r"'\p{L}+'"
_REVS = "revs AS (SELECT DISTINCT coalesce(lang, '') AS lang, page_id, topic_id, r.rev_id AS rev_id, r.ts AS ts, r.text AS text FROM (SELECT lang, page_id, topic_id, unnest(revision) AS r FROM reduced_page))"


def _latest(n: int) -> str:
    return f"latest AS (SELECT * FROM revs QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY ts DESC NULLS LAST, rev_id DESC) <= {n})"


def _budget(budget: int) -> str:
    return f"budget AS (SELECT lang, page_id, topic_id, rev_id, ts, CASE WHEN sum(coalesce(length(text), 0)) OVER (PARTITION BY page_id ORDER BY ts NULLS FIRST, rev_id ROWS UNBOUNDED PRECEDING) <= {budget} THEN text END AS text FROM latest)"


_TOKEN_SQL = config.TOKEN_CLASS.replace("'", "''")
_CLEAN = f"clean AS (SELECT lang, page_id, topic_id, rev_id, ts, {C.markup_sql('text')} AS text FROM budget)"
_ALPHA = f"""alpha AS (SELECT * FROM (SELECT lang, page_id, topic_id, rev_id, ts, t[pos + 1] AS term, pos FROM (
SELECT lang, page_id, topic_id, rev_id, ts, t, unnest(range(len(t))) AS pos FROM (SELECT *, regexp_extract_all(lower(text), '{_TOKEN_SQL}') AS t FROM clean))) WHERE regexp_full_match(term, {_LETTERS}))"""


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in sorted(words))


#: The stopword lists are put in where the SQL is asked for, so that importing reads no file.
_STOP = "stop AS (SELECT lang, unnest(words) AS word FROM (VALUES @STOPWORDS@) v(lang, words))"
_FREE = f"free AS (SELECT * FROM alpha a WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = a.lang AND s.word = lower(a.term)) AND (lang IN ({_quoted(pipeline.LANGS)}) OR lower(term) NOT IN (@ENGLISH@)))"
_MIN = f"CASE WHEN lang IN ({_quoted(config.ONE_LETTER_LANGS)}) THEN 1 ELSE 3 END"
_KEPT = f"kept AS (SELECT * FROM free WHERE length(term) BETWEEN {_MIN} AND {config.MAX_WORD_LENGTH})"
_TERMS = "terms AS (SELECT lang, page_id, topic_id, term, count(*) AS abs FROM kept GROUP BY ALL)"
_TOKENS = ", ".join([_REVS, _latest(LIMITS.revisions), _budget(config.CHAR_BUDGET), _CLEAN, _ALPHA, _STOP, _FREE, _KEPT])
_ALL = f"{_TOKENS}, {_TERMS}"


def _scored(terms: str) -> str:
    """CTEs of totals, document frequencies and TF-IDF over a CTE of page terms."""
    return f"""tot AS (SELECT lang, page_id, sum(abs)::BIGINT AS tot FROM {terms} GROUP BY ALL),
words AS (SELECT lang, term, sum(abs)::BIGINT AS a, count(*) AS i FROM {terms} GROUP BY ALL),
totals AS (SELECT lang, sum(tot)::BIGINT AS total_word, count(*) AS total_page FROM tot GROUP BY ALL),
scored AS (SELECT t.lang, t.page_id, t.topic_id, t.term, t.abs, tot.tot, words.i AS df, t.abs / tot.tot AS tf, log10(total_page::DOUBLE / words.i) AS idf,
round((t.abs / tot.tot) * log10(total_page::DOUBLE / words.i) * 10000) / 10000 AS tfidf
FROM {terms} t JOIN tot ON tot.lang = t.lang AND tot.page_id = t.page_id JOIN words ON words.lang = t.lang AND words.term = t.term JOIN totals ON totals.lang = t.lang)"""


_SCORED = f"{_ALL}, {_scored('terms')}"
_PAGE_TOP = f"""SELECT lang, page_id, term, tfidf, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, page_id ORDER BY tfidf DESC, term) AS rank, count(*) OVER (PARTITION BY lang, page_id) AS n FROM scored)
WHERE rank <= {LIMITS.page_words} AND (n <= {LIMITS.page_words} OR length(term) BETWEEN {_MIN} AND 33)"""
_TOPICS = """topics AS (SELECT lang, topic_id, term, count(*) AS n_pages FROM terms GROUP BY ALL), with_pseudo AS (SELECT * FROM topics UNION ALL SELECT DISTINCT lang, topic_id, '', 1 FROM topics)"""
_TOPIC_TOP = f"""SELECT lang, topic_id, term, n_pages, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang, topic_id ORDER BY n_pages DESC, term) AS rank FROM with_pseudo) WHERE rank <= {LIMITS.topic_words} AND length(term) BETWEEN {_MIN} AND 33"""
_GLOBAL_TOP = f"""SELECT lang, term, a, i, rank FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY a DESC, term) AS rank FROM words WHERE length(term) BETWEEN {_MIN} AND 33) WHERE rank <= {LIMITS.global_words}"""
_LEX = "lex AS (SELECT DISTINCT lang, word AS term FROM badword_lexicon WHERE lang IS NOT NULL AND word IS NOT NULL)"
_REPORT = "SELECT s.lang, page_id, topic_id, count(*) AS abs, count(*) / max(tot) AS rel, sum(abs)::BIGINT AS occurrences FROM scored s JOIN lex ON lex.lang = s.lang AND lex.term = s.term GROUP BY ALL"
_STEMMED = f"""stemmed AS (SELECT *, {stems.SUFFIX_STEM_SQL.format(w='term')} AS stem FROM kept),
page_rev AS (SELECT lang, page_id, stem, arg_min(term, (length(term), coalesce(ts, TIMESTAMPTZ '0001-01-01 00:00:00+00'), rev_id, pos)) AS surface FROM stemmed GROUP BY ALL),
rev AS (SELECT lang, stem, arg_min(surface, (strlen(surface), 'StemRev_' || page_id || '.json')) AS surface FROM page_rev GROUP BY ALL),
sterms AS (SELECT lang, page_id, topic_id, stem AS term, count(*) AS abs FROM stemmed GROUP BY ALL)"""
_STEM_ALL = f"{_TOKENS}, {_STEMMED}"
_STEM_SCORED = f"{_STEM_ALL}, {_scored('sterms')}"

# ---- pages and revisions ---------------------------------------------------------------------


@query(f"WITH {_REVS} SELECT page_id, rev_id, length(text) AS n_chars FROM revs")
def revision_rows(spark, d):
    return _revs(spark, d).dropDuplicates(["page_id", "rev_id"]).select("page_id", "rev_id", F.length("text").cast("bigint").alias("n_chars"))


@query(f"WITH {_REVS} SELECT page_id, rev_id FROM revs WHERE page_id IN (SELECT page_id FROM badword_report)")
def page_special_list(spark, d):
    """Revisions of the pages in a list: those with a bad word report."""
    listed = table(spark, d, "badword_report").select("page_id")
    return pages.special_pages(_revs(spark, d), listed).select("page_id", "rev_id").distinct()


@query(f"WITH {_REVS} SELECT page_id, rev_id FROM revs WHERE ts > TIMESTAMPTZ '2019-06-01 00:00:00+00' AND ts < TIMESTAMPTZ '2020-06-01 00:00:00+00'")
def revision_time_range(spark, d):
    return pages.time_range(_revs(spark, d), START, END).select("page_id", "rev_id").distinct()


@query("SELECT event_id, user_id FROM events WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 12:00:00'")
def event_time_range(spark, d):
    """The same range on a column of the file: both bounds reach the scan."""
    return pages.time_range(table(spark, d, "events"), "2024-01-05T00:00", "2024-01-20T12:00").select("event_id", "user_id")


@query(f"WITH {_REVS}, {_latest(LIMITS.revisions)} SELECT page_id, rev_id, length(text) AS n_chars FROM latest")
def revision_top_n(spark, d):
    return pages.latest_revisions(_revs(spark, d), LIMITS.revisions).select("page_id", "rev_id", F.length("text").cast("bigint").alias("n_chars"))


@query(f"WITH {_REVS}, {_latest(3)} SELECT page_id, rev_id FROM latest")
def revision_top_3(spark, d):
    return pages.latest_revisions(_revs(spark, d).drop("text"), 3).select("page_id", "rev_id")


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) <= 10")
def event_top_n(spark, d):
    return pages.latest_revisions(table(spark, d, "events"), 10, page="user_id", tie="event_id").select("user_id", "event_id")


def _budgeted(spark, d, budget):
    kept = pages.char_budget(pages.latest_revisions(_revs(spark, d), LIMITS.revisions), budget)
    return kept.where("text IS NOT NULL").select("page_id", "rev_id", F.length("text").cast("bigint").alias("n_chars"))


@query(f"WITH {_REVS}, {_latest(LIMITS.revisions)}, {_budget(config.CHAR_BUDGET)} SELECT page_id, rev_id, length(text) AS n_chars FROM budget WHERE text IS NOT NULL")
def revision_char_budget(spark, d):
    return _budgeted(spark, d, config.CHAR_BUDGET)


@query(f"WITH {_REVS}, {_latest(LIMITS.revisions)}, {_budget(SMALL_BUDGET)} SELECT page_id, rev_id, length(text) AS n_chars FROM budget WHERE text IS NOT NULL")
def revision_char_budget_small(spark, d):
    """A budget that bites."""
    return _budgeted(spark, d, SMALL_BUDGET)


@query("SELECT (page_id % 1000) AS bucket, count(*) AS pages FROM (SELECT DISTINCT page_id FROM reduced_page) GROUP BY ALL")
def page_bucket_sizes(spark, d):
    return _delivered(spark, d).select("page_id").distinct().groupBy(C.bucket_1000(F.col("page_id")).alias("bucket")).agg(F.count("*").alias("pages"))


@query("SELECT DISTINCT page_id, 'S' || lpad(page_id::VARCHAR, 20, '0') || '.json' AS name, page_id AS parsed FROM reduced_page")
def padded_names(spark, d):
    name = C.padded_name(F.col("page_id"), "S")
    return _delivered(spark, d).select("page_id").distinct().select("page_id", name.alias("name"), C.page_of_name(name, "S").alias("parsed"))


@query("SELECT page_id, count(*) AS deliveries FROM reduced_page GROUP BY page_id ORDER BY page_id")
def pages_sorted(spark, d):
    return _delivered(spark, d).groupBy("page_id").agg(F.count("*").alias("deliveries")).orderBy("page_id")


# ---- texts and tokens ------------------------------------------------------------------------


@query(f"WITH {_REVS}, {_latest(LIMITS.revisions)}, {_budget(config.CHAR_BUDGET)}, {_CLEAN} SELECT rev_id, text FROM clean")
def markup_clean(spark, d):
    return pipeline.reduced(_delivered(spark, d), LIMITS.revisions).select("rev_id", C.clean_markup(F.col("text")).alias("text"))


def _alpha(spark, d):
    revs = pipeline.reduced(_delivered(spark, d), LIMITS.revisions).withColumn("text", C.clean_markup(F.col("text")))
    return text.explode_tokens(text.blank(revs))


def _stop(spark):
    return text.stopword_table(spark, list(pipeline.LANGS))


_CTE = ", ".join([_REVS, _latest(LIMITS.revisions), _budget(config.CHAR_BUDGET), _CLEAN, _ALPHA])


@query(f"WITH {_CTE} SELECT rev_id, term, count(*) AS n FROM alpha GROUP BY ALL")
def tokens_alpha_lower(spark, d):
    return _alpha(spark, d).groupBy("rev_id", "term").agg(F.count("*").alias("n"))


@query(f"WITH {_CTE}, {_STOP}, {_FREE} SELECT lang, term, count(*) AS n FROM free GROUP BY ALL")
def tokens_stopword_filtered(spark, d):
    return text.drop_stopwords(_alpha(spark, d), _stop(spark)).groupBy("lang", "term").agg(F.count("*").alias("n"))


@query(f"WITH {_CTE} SELECT lang, term, count(*) AS n FROM alpha WHERE length(term) BETWEEN {_MIN} AND 33 GROUP BY ALL")
def tokens_length_filtered(spark, d):
    return text.drop_bad_lengths(_alpha(spark, d)).groupBy("lang", "term").agg(F.count("*").alias("n"))


@query(f"WITH {_CTE} SELECT lang, term, count(*) AS n FROM alpha WHERE length(term) BETWEEN 4 AND 50 AND term NOT IN ({_quoted(config.HTML_WORDS)}) GROUP BY ALL")
def tokens_legacy_filter(spark, d):
    return text.legacy_filter(_alpha(spark, d)).groupBy("lang", "term").agg(F.count("*").alias("n"))


# ---- counts and TF-IDF -----------------------------------------------------------------------


def _terms(spark, d):
    return pipeline.terms(_delivered(spark, d), LIMITS.revisions)


def _saved_terms(spark, d):
    """Page terms with their page's total, which is computed where a page's terms lie together."""
    return save(counts.with_total(_terms(spark, d)), "terms")


@query(f"WITH {_ALL} SELECT * FROM terms")
def page_word_freq(spark, d):
    return _terms(spark, d)


_NORMALISED = "nterms AS (SELECT lang, page_id, topic_id, term, count(*) AS abs FROM (SELECT lang, page_id, topic_id, unnest(r.text) AS term FROM (SELECT lang, page_id, topic_id, unnest(revision) AS r FROM (SELECT DISTINCT ON (page_id) * FROM normalised_page))) WHERE term IS NOT NULL GROUP BY ALL)"


@query(f"WITH {_NORMALISED} SELECT * FROM nterms")
def normalised_word_freq(spark, d):
    return counts.normalised_terms(table(spark, d, "normalised_page"))


@query(f"WITH {_ALL} SELECT lang, page_id, sum(abs)::BIGINT AS tot FROM terms GROUP BY ALL")
def page_word_totals(spark, d):
    return counts.page_totals(_terms(spark, d))


@query(f"WITH {_ALL} SELECT lang, page_id, topic_id, sum(abs)::BIGINT AS tot, string_agg(term || '=' || abs, ' ' ORDER BY term) AS words FROM terms GROUP BY ALL")
def page_word_maps(spark, d):
    """One row per page; the map in key order, shown as text."""
    maps = counts.word_maps(_terms(spark, d))
    shown = F.array_join(F.transform(F.map_entries("words"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), " ")
    return maps.withColumn("words", shown)


@query(f"WITH {_ALL} SELECT lang, term, sum(abs)::BIGINT AS a, count(*) AS i FROM terms GROUP BY ALL")
def global_words(spark, d):
    return counts.global_words(_terms(spark, d))


@query("SELECT lang, term, sum(coalesce(a, 0))::BIGINT AS a, sum(coalesce(i, 0))::BIGINT AS i FROM (SELECT DISTINCT lang, shard_id, term, a, i FROM global_words) WHERE term NOT IN ('@Total Word', '@Total Page') GROUP BY ALL")
def stored_global_words(spark, d):
    """Global words summed over the shards of a stored table."""
    shards = table(spark, d, "global_words").where("term NOT IN ('@Total Word', '@Total Page')").select("lang", "shard_id", "term", "a", "i").distinct()
    zero = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
    return shards.groupBy("lang", "term").agg(zero("a"), zero("i"))


@query(f"WITH {_SCORED} SELECT * FROM totals")
def corpus_totals(spark, d):
    return counts.corpus_totals(_terms(spark, d))


@query(f"WITH {_SCORED} SELECT lang, page_id, term, tf FROM scored")
def page_tf(spark, d):
    return counts.with_total(_terms(spark, d)).select("lang", "page_id", "term", C.tf(F.col("abs"), F.col("tot")).alias("tf"))


@query(f"WITH {_SCORED} SELECT DISTINCT lang, term, df, round(idf, 9) AS idf FROM scored")
def word_idf(spark, d):
    t = _saved_terms(spark, d)
    words = counts.global_words(t).join(F.broadcast(counts.corpus_totals(t)), "lang")
    return words.select("lang", "term", F.col("i").alias("df"), F.round(C.idf(F.col("total_page"), F.col("i")), 9).alias("idf"))


@query(f"WITH {_SCORED} SELECT lang, page_id, topic_id, term, abs, tot, tfidf FROM scored")
def page_tfidf(spark, d):
    return counts.tfidf(_saved_terms(spark, d)).select("lang", "page_id", "topic_id", "term", "abs", "tot", "tfidf")


_STORED = "pterms AS (SELECT lang, page_id, topic_id, e.key AS term, e.value AS abs FROM (SELECT lang, page_id, topic_id, unnest(map_entries(words)) AS e FROM (SELECT DISTINCT ON (page_id) * FROM page_words WHERE words IS NOT NULL)))"


@query(f"WITH {_STORED}, {_scored('pterms')} SELECT lang, page_id, term, tfidf FROM scored")
def stored_page_tfidf(spark, d):
    """TF-IDF from stored page counts, each page once."""
    stored = table(spark, d, "page_words").where("words IS NOT NULL").dropDuplicates(["page_id"]).select("lang", "page_id", "topic_id", F.explode("words").alias("term", "abs"))
    return counts.tfidf(save(stored, "stored")).select("lang", "page_id", "term", "tfidf")


_DOCS = "revs AS (SELECT coalesce(lang, '') AS lang, page_id, topic_id, doc_id AS rev_id, rev_ts AS ts, text FROM documents WHERE page_id IS NOT NULL)"
_DOC_TERMS = ", ".join([_DOCS, _latest(LIMITS.revisions), _budget(config.CHAR_BUDGET), _CLEAN, _ALPHA, _STOP, _FREE, _KEPT, _TERMS])


@query(f"WITH {_DOC_TERMS} SELECT lang, term, sum(abs)::BIGINT AS a, count(*) AS i FROM terms GROUP BY ALL")
def document_global_words(spark, d):
    """The same engine over another source: documents as revisions of their pages."""
    return counts.global_words(pipeline.terms(pages_of_documents(table(spark, d, "documents")), LIMITS.revisions))


_LEMMAS = """known AS (SELECT DISTINCT lang, term FROM global_words WHERE lang IS NOT NULL AND term IS NOT NULL),
lemmas AS (SELECT k.lang, k.term AS word, b.term AS lemma, CASE WHEN length(k.term) = 3 THEN 'ADP' ELSE 'NOUN' END AS pos FROM known k LEFT JOIN known b ON b.lang = k.lang AND b.term || 's' = k.term)"""


@query(f"WITH {_ALL}, {_LEMMAS} SELECT t.lang, coalesce(lemma, t.term) AS term, sum(abs)::BIGINT AS a FROM terms t LEFT JOIN lemmas l ON l.lang = t.lang AND l.word = t.term WHERE coalesce(pos, 'NOUN') <> 'ADP' GROUP BY ALL")
def lemma_words(spark, d):
    """Words by lemma, less those of a part of speech that isn't kept; the dictionary is one that can be had from the tables: plurals whose singular is known, and short words as adpositions."""
    known = table(spark, d, "global_words").where("lang IS NOT NULL AND term IS NOT NULL").select("lang", F.col("term").alias("word")).distinct()
    singular = known.select("lang", F.concat("word", F.lit("s")).alias("word"), F.col("word").alias("lemma"))
    lemmas = known.join(singular, ["lang", "word"], "left").withColumn("pos", F.when(F.length("word") == 3, "ADP").otherwise("NOUN"))
    return text.lemmatise(_terms(spark, d), lemmas).groupBy("lang", "term").agg(F.sum("abs").alias("a"))


_GOLDEN = {
    "sv": {"flickorna": "flick", "hundarna": "hund", "jaktkarlarne": "jaktkarl", "klokaste": "klok", "friskt": "frisk"},
    "hu": {"babakocsi": "babakocs", "babakocsijáért": "babakocs", "babakocsit": "babakocs", "házakban": "ház", "kertekkel": "kert", "asztalokat": "asztal"},
    "ar": {"المكتبات": "كتب", "الكتابة": "كتب", "يدرسون": "درس", "مدرسة": "درس"},
}
_GOLDEN_ROWS = ", ".join(f"('{lang}', '{w}', '{s}')" for lang, words in _GOLDEN.items() for w, s in words.items())


@query(f"SELECT * FROM (VALUES {_GOLDEN_ROWS}) v(lang, term, stem) UNION ALL SELECT DISTINCT lang, term, term FROM global_words WHERE lang IS NOT NULL AND term IS NOT NULL")
def stem_languages(spark, d):
    """Each language's words by its own stemmer: words of known stem in three languages, and the stored words, whose languages are lemmatised or have none and stay."""
    known = spark.createDataFrame([(lang, w) for lang, words in _GOLDEN.items() for w in words], "lang string, term string")
    stored = table(spark, d, "global_words").where("lang IS NOT NULL AND term IS NOT NULL").select("lang", "term").distinct()
    return stems.stem_by_language(known.union(stored)).select("lang", "term", "stem")


# ---- topics, cuts, bad words -----------------------------------------------------------------


@query(f"WITH {_SCORED} {_PAGE_TOP}")
def page_top_words(spark, d):
    """The flagship: the 50 words of every page with the highest TF-IDF."""
    return topn.page_top(counts.tfidf(_saved_terms(spark, d)), LIMITS.page_words).select("lang", "page_id", "term", "tfidf", F.col("rank").cast("bigint").alias("rank"))


@query(f"WITH {_SCORED} {_GLOBAL_TOP}")
def global_top_words(spark, d):
    return topn.global_top(counts.global_words(_terms(spark, d)), LIMITS.global_words).withColumn("rank", F.col("rank").cast("bigint"))


@query(f"WITH {_ALL}, {_TOPICS} SELECT * FROM topics")
def topic_words(spark, d):
    return counts.topic_words(_terms(spark, d))


@query(f"WITH {_ALL}, {_TOPICS} SELECT * FROM with_pseudo")
def topic_words_compat(spark, d):
    return counts.topic_words(save(_terms(spark, d), "terms"), pseudo_word=True)


@query(f"WITH {_ALL}, {_TOPICS} {_TOPIC_TOP}")
def topic_top_words(spark, d):
    top = topn.topic_top(save(counts.topic_words(save(_terms(spark, d), "terms"), pseudo_word=True), "topics"), LIMITS.topic_words)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query(f"SELECT topic_id, word, n_pages FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY n_pages DESC NULLS LAST, word) AS rank FROM (SELECT DISTINCT topic_id, word, n_pages FROM topic_words)) WHERE rank <= {LIMITS.topic_words} AND length(word) BETWEEN 3 AND 33")
def stored_topic_top(spark, d):
    stored = table(spark, d, "topic_words").select("topic_id", "word", "n_pages").distinct().select(F.lit("").alias("lang"), "topic_id", F.col("word").alias("term"), "n_pages")
    return topn.topic_top(stored, LIMITS.topic_words).select("topic_id", F.col("term").alias("word"), "n_pages")


@query(f"WITH {_SCORED}, {_LEX} SELECT s.lang, page_id, s.term, abs FROM scored s JOIN lex ON lex.lang = s.lang AND lex.term = s.term")
def badword_pairs(spark, d):
    return badwords.pairs(_terms(spark, d), table(spark, d, "badword_lexicon")).select("lang", "page_id", "term", "abs")


@query(f"WITH {_SCORED}, {_LEX} {_REPORT}")
def badword_report(spark, d):
    return badwords.report(_saved_terms(spark, d), table(spark, d, "badword_lexicon"))


@query("SELECT code, CASE WHEN code IN ('simple', 'cr') THEN 'en' WHEN code IN (" + _quoted(config.LEXICON_LANGS) + ") THEN code END AS lexicon FROM (SELECT unnest([" + _quoted([*config.LANGUAGE_NAMES, "cr"]) + "]) AS code)")
def badword_languages(spark, d):
    return spark.createDataFrame([(x, config.lexicon_language(x)) for x in [*config.LANGUAGE_NAMES, "cr"]], "code string, lexicon string")


@query(f"WITH {_SCORED}, {_LEX} SELECT * FROM ({_REPORT}) WHERE lang = 'de'")
def badword_report_de(spark, d):
    return badwords.for_language(_saved_terms(spark, d), table(spark, d, "badword_lexicon"), "de")


# ---- stems -----------------------------------------------------------------------------------


def _stemmed(spark, d):
    return save(stems.stem_terms(counts.first_terms(pipeline.tokens(_delivered(spark, d), LIMITS.revisions))), "stemmed")


@query(f"WITH {_STEM_ALL} SELECT DISTINCT lang, term, stem FROM stemmed")
def stem_terms(spark, d):
    return stems.stem_terms(_terms(spark, d).select("lang", "term").distinct())


@query(f"WITH {_STEM_ALL} SELECT * FROM page_rev")
def stem_reverse_page(spark, d):
    return stems.page_reverse(_stemmed(spark, d))


@query(f"WITH {_STEM_ALL} SELECT * FROM rev")
def stem_reverse_global(spark, d):
    return stems.global_reverse(stems.page_reverse(_stemmed(spark, d)))


def _stem_parts(spark, d):
    stemmed = _stemmed(spark, d)
    back = save(stems.global_reverse(stems.page_reverse(stemmed)), "stems")
    return save(counts.with_total(stems.stemmed_page_terms(stemmed)), "terms"), back


@query(f"WITH {_STEM_SCORED} SELECT s.lang, page_id, term, coalesce(surface, term) AS surface, tfidf FROM scored s LEFT JOIN rev ON rev.lang = s.lang AND rev.stem = s.term")
def destem_page_tfidf(spark, d):
    t, back = _stem_parts(spark, d)
    return stems.destem(counts.tfidf(t), back).select("lang", "page_id", "term", "surface", "tfidf")


@query(f"WITH {_STEM_SCORED} SELECT w.lang, term, coalesce(surface, term) AS surface, a, i FROM words w LEFT JOIN rev ON rev.lang = w.lang AND rev.stem = w.term")
def destem_global_words(spark, d):
    t, back = _stem_parts(spark, d)
    return stems.destem(counts.global_words(t), back).select("lang", "term", "surface", "a", "i")


@query(f"WITH {_STEM_SCORED} SELECT w.lang, term, surface, a, i FROM words w JOIN rev ON rev.lang = w.lang AND rev.stem = w.term WHERE surface < term OR NOT EXISTS (SELECT 1 FROM words g WHERE g.lang = w.lang AND g.term = surface)")
def destem_global_words_compat(spark, d):
    t, back = _stem_parts(spark, d)
    return stems.destem_lossy(save(counts.global_words(t), "words"), back).select("lang", "term", "surface", "a", "i")


# ---- results ---------------------------------------------------------------------------------


def _exported(spark, d):
    folder = new_path(spark, "results")
    return pipeline.Engine(LIMITS).run(_delivered(spark, d), table(spark, d, "badword_lexicon"), folder)


@query(f"WITH {_SCORED} SELECT t.lang, t.page_id, topic_id, tot.tot, t.term, tfidf FROM ({_PAGE_TOP}) t JOIN tot ON tot.lang = t.lang AND tot.page_id = t.page_id JOIN (SELECT DISTINCT page_id, topic_id FROM terms) p ON p.page_id = t.page_id")
def export_pages(spark, d):
    """The whole run written and read again: pages."""
    return _exported(spark, d).pages().select("lang", "page_id", "topic_id", "tot", F.explode("words").alias("term", "tfidf"))


@query(f"WITH {_ALL}, {_TOPICS} SELECT t.lang, t.topic_id, s.tot, term, n_pages FROM ({_TOPIC_TOP}) t JOIN (SELECT lang, topic_id, sum(n_pages)::BIGINT AS tot FROM topics GROUP BY ALL) s ON s.lang = t.lang AND s.topic_id IS NOT DISTINCT FROM t.topic_id")
def export_topics(spark, d):
    return _exported(spark, d).topics().select("lang", "topic_id", "tot", F.explode("words").alias("term", "n_pages"))


@query(f"WITH {_SCORED} SELECT t.lang, term, a, i, total_word, total_page FROM ({_GLOBAL_TOP}) t JOIN totals ON totals.lang = t.lang")
def export_global_words(spark, d):
    return _exported(spark, d).global_words()


@query(f"WITH {_SCORED}, {_LEX} SELECT s.lang, page_id, topic_id, count(*) OVER (PARTITION BY page_id) AS abs, s.term FROM scored s JOIN lex ON lex.lang = s.lang AND lex.term = s.term")
def export_badwords(spark, d):
    return _exported(spark, d).badwords().select("lang", "page_id", "topic_id", "abs", F.explode("badw").alias("term", "_n")).drop("_n")


@query(f"WITH {_SCORED} SELECT page_id, tot, term, abs FROM scored")
def line_protocol(spark, d):
    """Page words in the line protocol, written and read again."""
    path = new_path(spark, "lines")
    maps = counts.word_maps(_terms(spark, d)).select("page_id", F.struct("topic_id", "tot", "words").alias("value"))
    results.write_lines(maps, path, "page_id", "value")
    back = results.read_lines(spark, path, "struct<topic_id:bigint,tot:bigint,words:map<string,bigint>>")
    return back.select(F.col("key").cast("bigint").alias("page_id"), "value.tot", F.explode("value.words").alias("term", "abs"))


@query(f"WITH {_SCORED} SELECT page_id, topic_id, tot.tot, t.term, tfidf FROM ({_PAGE_TOP}) t JOIN tot USING (lang, page_id) JOIN (SELECT DISTINCT page_id, topic_id FROM terms) p USING (page_id) WHERE lang = 'en'")
def layout_pages(spark, d):
    """One language's results as single gzip files of the older format, opened again: pages."""
    folder = new_path(spark, "layout")
    layout.export(_exported(spark, d), folder, "en")
    return layout.Layout(spark, folder, "en").pages().select("page_id", "topic_id", "tot", F.explode("words").alias("term", "tfidf"))


# ---- streaming -------------------------------------------------------------------------------


@query(f"WITH {_ALL} SELECT lang, page_id, term, abs FROM terms")
def stream_page_terms(spark, d):
    """Pages arriving as a stream are merged into the store; page terms follow from the store."""
    source = f"{d}/reduced_page.parque[t]"  # as a pattern it may be a file or a folder
    stream = spark.readStream.schema(table(spark, d, "reduced_page").schema).option("maxFilesPerTrigger", 64).parquet(source)
    store = RevisionStore(spark, new_path(spark, "store"), LIMITS.revisions)
    arriving = revisions(stream).select(F.coalesce("lang", F.lit("")).alias("lang"), "page_id", "topic_id", "rev_id", "ts", "text")
    follow(arriving, store, new_path(spark, "offsets")).awaitTermination()
    kept = pages.char_budget(store.read())
    return counts.page_terms(text.normalise(kept, _stop(spark))).select("lang", "page_id", "term", "abs")
