"""The training-data queries: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import abuse, encodings, frequent, leaks, mixing, near_duplicates, pieces, term_counts, top_n
from lexmill.scratch import save
from lexmill.sources.tables import revisions, table

PAGE_WORDS, TOPIC_WORDS = 20, 50


def p1_page_top(spark: SparkSession, d: str) -> DataFrame:
    """The 20 words of each page with the highest TF-IDF, ranked."""
    out = top_n.top_n(table(spark, d, "page_tfidf"), "page_id", "word", "tfidf", PAGE_WORDS)
    return out.select(F.col("grp").alias("page_id"), F.col("item").alias("word"), F.col("score").alias("tfidf"), F.col("rank").cast("bigint").alias("rank"))


def p1_topic_top(spark: SparkSession, d: str) -> DataFrame:
    """The 50 words of each topic found in most pages, ranked."""
    out = top_n.top_n(table(spark, d, "topic_words"), "topic_id", "word", "n_pages", TOPIC_WORDS)
    return out.select(F.col("grp").alias("topic_id"), F.col("item").alias("word"), F.col("score").alias("n_pages"), F.col("rank").cast("bigint").alias("rank"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pages = p1_page_top(spark, d).select(F.lit("page").alias("grp"), F.col("page_id").alias("group_id"), "word")
    topics = p1_topic_top(spark, d).select(F.lit("topic").alias("grp"), F.col("topic_id").alias("group_id"), "word")
    return pages.union(topics)


FEW_REPEATED = 1_000_000  # repeated pages whose first places are broadcast, 24 bytes each


def _once(pages: DataFrame, content: Column, *columns: Column | str) -> DataFrame:
    """``columns`` of each page once; ``pages`` is a table of files, ``content`` tells pages without an id apart.

    A page's first row in the files is kept.  Ids and places in the files, combined within each task, tell which pages are
    repeated; where these are few, their other rows are left out in the scan, else pages are sent whole.
    """
    place = F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    alone = pages.where("page_id IS NULL").withColumn("_alone", content).dropDuplicates(["_alone"]).select(*columns)
    whole = pages.where("page_id IS NOT NULL")
    firsts = whole.select("page_id", place.alias("place")).groupBy("page_id").agg(F.min("place").alias("_first"), F.count("*").alias("_n"))
    firsts = save(firsts.where("_n > 1").select("page_id", "_first"), "repeated")
    if firsts.count() > FEW_REPEATED:
        return whole.dropDuplicates(["page_id"]).select(*columns).union(alone)
    named = whole.select("page_id", place.alias("_place"), *(c.alias(f"_c{i}") if isinstance(c, Column) else F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)))
    kept = named.join(F.broadcast(firsts), "page_id", "left").where("_first IS NULL OR _first = _place")
    return kept.select(*(f"_c{i}" for i in range(len(columns)))).union(alone)


def _page_tokens(spark: SparkSession, d: str) -> DataFrame:
    tokens = F.flatten(F.filter(F.col("revision.text"), lambda x: x.isNotNull()))
    return save(_once(table(spark, d, "normalised_page"), F.xxhash64(tokens), "lang", tokens.alias("tokens")).toDF("lang", "tokens"), "tokens")


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    """Words that make up 0.2 % of a language's tokens: exact count and the sketch's bounds."""
    out = frequent.frequent_items(_page_tokens(spark, d), "lang", "tokens", share=0.002, least=10)
    return out.select(F.col("k").alias("lang"), F.col("item").alias("word"), "n", "lower", "upper", F.col("total").alias("tokens"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return p2_counts(spark, d).select("lang", "word")


def p2_words(spark: SparkSession, d: str) -> DataFrame:
    """The same words with their exact counts, without the sketch's bounds."""
    return p2_counts(spark, d).select("lang", "word", "n", "tokens")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = revisions(table(spark, d, "reduced_page").select("revision"))
    out = near_duplicates.near_duplicate_pairs(rows, "rev_id", "text", threshold=0.7, k=3, min_words=20)
    return out.select(F.col("id_a").alias("rev_id_a"), F.col("id_b").alias("rev_id_b"))


def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups of revisions linked by five-word runs at a similarity of 0.8: one row per revision."""
    out = near_duplicates.near_duplicate_groups(revisions(table(spark, d, "reduced_page").select("revision")), "rev_id", "text", threshold=0.8, k=5)
    return out.withColumnRenamed("id", "rev_id")


def p3_links(spark: SparkSession, d: str) -> DataFrame:
    """For every revision, how many other texts are near its own."""
    return p3_groups(spark, d).select("rev_id", "links")


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Revision texts over 6 000 characters as ordered pieces that repeat up to 200 characters."""
    out = pieces.long_pieces(revisions(table(spark, d, "reduced_page").select("revision")), "rev_id", "text")
    return out.withColumnRenamed("id", "rev_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return p4_pieces(spark, d).where("piece = 0 AND n_pieces > 1").select("rev_id").distinct()


def _page_terms(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    pages = save(_once(table(spark, d, "page_words").where("words IS NOT NULL"), F.to_json("words"), "lang", "words").toDF("lang", "words"), "pages")
    terms = pages.select("lang", F.explode("words").alias("word", "n")).withColumn("pages", F.lit(1))
    totals = pages.where(F.size("words") > 0).groupBy(F.col("lang").alias("tk")).agg(F.count("*").alias("total"))
    return terms, totals


def p5_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every word of page_words with occurrences and pages per language, marked if too rare or too common."""
    terms, totals = _page_terms(spark, d)
    counts = term_counts.term_counts(terms, "lang", "word", "n", "pages")
    out = term_counts.mark(counts, totals, rare=2, common=3, share=0.15)
    return out.select(F.col("k").alias("lang"), F.col("term").alias("word"), F.col("n").alias("occurrences"), F.col("records").alias("pages"), "mark")


def p5_global_terms(spark: SparkSession, d: str) -> DataFrame:
    """Every word of global_words, summed over its shards; repeated rows count once, the sentinels are no words."""
    shards = table(spark, d, "global_words").where("term NOT IN ('@Total Word', '@Total Page')").select("lang", "shard_id", "term", "a", "i").distinct()
    totals = table(spark, d, "global_words").where("term = '@Total Page'").select("lang", "shard_id", "a").distinct().groupBy(F.col("lang").alias("tk")).agg(F.sum("a").alias("total"))
    out = term_counts.mark(term_counts.term_counts(shards, "lang", "term", "a", "i"), totals, rare=2, common=3, share=0.15)
    return out.select(F.col("k").alias("lang"), F.col("term").alias("word"), F.col("n").alias("occurrences"), F.col("records").alias("pages"), "mark")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_terms(spark, d).where("mark IS NOT NULL").select("lang", "word", "mark")


def _scores(spark: SparkSession, d: str) -> DataFrame:
    texts = revisions(table(spark, d, "reduced_page").select("source", "revision"))
    model = abuse.fit(texts, "rev_id", "text", abuse.votes(table(spark, d, "review_labels"), "rev_id", "rater", "label"))
    return abuse.scored(texts, "rev_id", "text", model, keep=("source",)).distinct()


def p6_scores(spark: SparkSession, d: str) -> DataFrame:
    """Every revision with its score for abusive language, and whether to review it."""
    return _scores(spark, d).withColumnRenamed("id", "rev_id")


def p6_rates(spark: SparkSession, d: str) -> DataFrame:
    """Per source: revisions, those to review, and their rate."""
    rows = _scores(spark, d).groupBy("source").agg(F.count("*").alias("revisions"), F.sum(F.col("review").cast("bigint")).alias("to_review"), F.avg("score").alias("mean_score"))
    return rows.withColumn("rate", F.col("to_review") / F.col("revisions"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _scores(spark, d).where("review").select(F.col("id").alias("rev_id")).distinct()


def p7_leaks(spark: SparkSession, d: str) -> DataFrame:
    """Documents with passages of evaluation items: the longest exact run and the longest overlap with substitutions, in words."""
    out = leaks.leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "text")
    return out.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "exact_run", "overlap")


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked items with the number of documents that contain a run of 12 of their words."""
    return p7_leaks(spark, d).where("exact_run >= 12").groupBy("item_id").agg(F.count("*").alias("documents"), F.max("exact_run").alias("longest_run"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return p7_leaks(spark, d).where("exact_run >= 12").select("doc_id", "item_id")


def _mixed(spark: SparkSession, d: str) -> tuple[DataFrame, list[dict]]:
    targets = table(spark, d, "mix_targets")
    texts = save(mixing.sized(table(spark, d, "documents"), "doc_id", "text", "source", targets=targets), "texts")
    entries = mixing.plan(texts, targets)
    return mixing.mix(texts, entries), entries


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    """The documents of the mixture with the number of copies of each."""
    mixed, _ = _mixed(spark, d)
    return mixed.withColumnRenamed("id", "doc_id")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    """Per source of mix_targets: target and actual share of the tokens, and what was available and used."""
    return mixing.shares(*_mixed(spark, d))


def p9_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Garbled documents with their text as far as it could be restored."""
    out = encodings.garbled(table(spark, d, "documents"), "doc_id", "text")
    return out.select(F.col("id").alias("doc_id"), "text", F.array_join("ways", ",").alias("ways"), "runs", "lost").distinct()


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return p9_repaired(spark, d).select("doc_id").distinct()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[:1] == "p" and name[1:2].isdigit()}


_TOP = """SELECT {group}, word, {score}, rank FROM (
    SELECT {group}, word, max({score}) AS {score}, row_number() OVER (PARTITION BY {group} ORDER BY max({score}) DESC, word) AS rank
    FROM {table} WHERE {group} IS NOT NULL AND word IS NOT NULL AND {score} IS NOT NULL AND NOT isnan({score}::DOUBLE) GROUP BY {group}, word
) WHERE rank <= {n}"""
_PAGE_TOP = _TOP.format(group="page_id", score="tfidf", table="page_tfidf", n=PAGE_WORDS)
_TOPIC_TOP = _TOP.format(group="topic_id", score="n_pages", table="topic_words", n=TOPIC_WORDS)
_P2 = """WITH page AS (SELECT page_id, any_value(lang) AS lang, any_value(revision) AS revision FROM normalised_page GROUP BY page_id),
token AS (SELECT lang, unnest(r.text) AS word FROM (SELECT lang, unnest(revision) AS r FROM page)),
n AS (SELECT lang, word, count(*) AS n FROM token WHERE word IS NOT NULL GROUP BY lang, word),
total AS (SELECT lang, sum(n) AS total FROM n GROUP BY lang)
SELECT n.lang, n.word FROM n JOIN total ON n.lang IS NOT DISTINCT FROM total.lang WHERE n >= 10 AND n >= 0.002 * total"""
_RUNS = """WITH rev AS (SELECT DISTINCT r.rev_id, r.text FROM (SELECT unnest(revision) AS r FROM reduced_page) WHERE r.text IS NOT NULL),
w AS (SELECT rev_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM rev),
run AS (SELECT DISTINCT rev_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS run FROM w WHERE len(w) >= 20),
n AS (SELECT rev_id, count(*) AS n FROM run GROUP BY rev_id),
both_in AS (SELECT a.rev_id AS rev_id_a, b.rev_id AS rev_id_b, count(*) AS c FROM run a JOIN run b ON a.run = b.run AND a.rev_id < b.rev_id GROUP BY 1, 2)
SELECT rev_id_a, rev_id_b FROM both_in JOIN n a ON a.rev_id = rev_id_a JOIN n b ON b.rev_id = rev_id_b WHERE c >= 0.7 * (a.n + b.n - c)"""
_P4 = "SELECT DISTINCT r.rev_id FROM (SELECT unnest(revision) AS r FROM reduced_page) WHERE length(r.text) > 6000"
_P7 = """WITH w AS (SELECT doc_id AS id, 'd' AS kind, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents
UNION ALL SELECT item_id, 'i', regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM eval_items),
run AS (SELECT DISTINCT kind, id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS run FROM w WHERE len(w) >= 12)
SELECT DISTINCT a.id AS doc_id, b.id AS item_id FROM run a JOIN run b ON a.run = b.run WHERE a.kind = 'd' AND b.kind = 'i'"""
_P7_ITEMS = """WITH w AS (SELECT DISTINCT doc_id AS id, 'd' AS kind, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents
UNION ALL SELECT item_id, 'i', regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') FROM eval_items),
run AS (SELECT kind, id, unnest(range(1, len(w) - 10)) AS pos, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS run FROM w WHERE len(w) >= 12),
hit AS (SELECT a.id AS doc_id, b.id AS item_id, a.pos, a.pos - b.pos AS shift FROM run a JOIN run b ON a.run = b.run WHERE a.kind = 'd' AND b.kind = 'i'),
row_of AS (SELECT doc_id, item_id, shift, pos - row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY pos) AS r FROM hit),
length AS (SELECT doc_id, item_id, count(*) + 11 AS n FROM row_of GROUP BY doc_id, item_id, shift, r)
SELECT item_id, count(DISTINCT doc_id) AS documents, max(n) AS longest_run FROM length GROUP BY item_id"""
_P3_LINKS = """WITH rev AS (SELECT DISTINCT r.rev_id, r.text FROM (SELECT unnest(revision) AS r FROM reduced_page) WHERE r.text IS NOT NULL AND r.rev_id IS NOT NULL),
w AS (SELECT rev_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM rev),
own AS (SELECT rev_id, list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS runs FROM w),
class AS (SELECT row_number() OVER () AS c, runs, len(runs) AS n FROM (SELECT DISTINCT runs FROM own WHERE len(runs) > 0)),
run AS (SELECT c, n, unnest(runs) AS run FROM class),
common AS (SELECT a.c AS a, b.c AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k FROM run a JOIN run b ON a.run = b.run AND a.c <> b.c GROUP BY a.c, b.c),
link AS (SELECT a, count(*) AS links FROM common WHERE k >= 0.8 * (na + nb - k) GROUP BY a)
SELECT rev_id, coalesce(links, 0) AS links FROM own LEFT JOIN class USING (runs) LEFT JOIN link ON a = c"""
_P5_MARK = "CASE WHEN pages <= 2 THEN 'rare' WHEN pages >= 3 AND pages >= 0.15 * total THEN 'common' END"
_P5 = f"""WITH page AS (SELECT page_id, any_value(lang) AS lang, any_value(words) AS words FROM page_words WHERE words IS NOT NULL GROUP BY page_id),
t AS (SELECT lang, unnest(map_entries(words)) AS e FROM page),
n AS (SELECT lang, e.key AS word, sum(e.value)::BIGINT AS occurrences, count(*) AS pages FROM t GROUP BY lang, e.key),
total AS (SELECT lang, count(*) AS total FROM page WHERE cardinality(words) > 0 GROUP BY lang)
SELECT n.lang, word, occurrences, pages, {_P5_MARK} AS mark FROM n LEFT JOIN total ON n.lang IS NOT DISTINCT FROM total.lang"""
_P5_GLOBAL = f"""WITH g AS (SELECT DISTINCT lang, shard_id, term, a, i FROM global_words),
total AS (SELECT lang, sum(a) AS total FROM (SELECT DISTINCT lang, shard_id, a FROM global_words WHERE term = '@Total Page') GROUP BY lang),
n AS (SELECT lang, term AS word, sum(coalesce(a, 0))::BIGINT AS occurrences, sum(coalesce(i, 0))::BIGINT AS pages FROM g WHERE term NOT IN ('@Total Word', '@Total Page') GROUP BY lang, term)
SELECT n.lang, word, occurrences, pages, {_P5_MARK} AS mark FROM n LEFT JOIN total ON n.lang IS NOT DISTINCT FROM total.lang"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_page_top": _PAGE_TOP,
        "p1_topic_top": _TOPIC_TOP,
        "p1_found": f"SELECT 'page' AS grp, page_id AS group_id, word FROM ({_PAGE_TOP}) UNION ALL SELECT 'topic', topic_id, word FROM ({_TOPIC_TOP})",
        "p2_found": _P2,
        "p3_found": _RUNS,
        "p4_found": _P4,
        "p5_terms": _P5,
        "p5_global_terms": _P5_GLOBAL,
        "p2_words": _P2.replace("SELECT n.lang, n.word FROM", "SELECT n.lang, n.word, n.n, total.total::BIGINT AS tokens FROM"),
        "p3_links": _P3_LINKS,
        "p7_items": _P7_ITEMS,
        "p7_found": _P7,
        "p5_found": f"SELECT lang, word, mark FROM ({_P5}) WHERE mark IS NOT NULL",
    }
