"""Core operators: worked examples, edge cases, and every query against its SQL."""

import gzip
import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lexmill import config
from lexmill.functions import columns as C
from lexmill.functions import stemmers
from lexmill.operators import badwords, counts, pages, stems, text, topn
from lexmill.plans import catalogue, pipeline
from lexmill.scratch import save
from lexmill.sources import layout, lexicons, results
from lexmill.sources.tables import pages_of_turns, revisions
from lexmill.streaming.upsert import RevisionStore
from tests.conftest import DATA, check_against_sql


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def golden(spark):
    """Three small pages; the fourth has no token."""
    data = [(1, 2147483638, "go go gopher lang code gopher"), (2, 2147483638, "go rust rust rust"), (3, 2147483637, "lang")]
    tokens = [("en", p, t, w) for p, t, s in data for w in s.split()]
    return counts.page_terms(spark.createDataFrame(tokens, "lang string, page_id bigint, topic_id bigint, term string")).cache()


def test_catalogue_equals_sql(spark):
    check_against_sql(spark, catalogue.queries(), catalogue.oracle_sql(), [n for n in catalogue.oracle_sql() if not n.startswith("export_")])


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_import_needs_no_files_of_an_installation():
    """The queries and their SQL come without reading anything beside this package, as when Spark's jars lie elsewhere."""
    script = """
import builtins, io, os, sys
import pyspark, pyspark.sql
for name in ("duckdb", "numpy", "pandas", "pyarrow", "pyarrow.compute", "tiktoken"):
    __import__(name)
seen = []
sys.addaudithook(lambda event, args: seen.append(str(args[0])) if event in ("open", "os.listdir", "os.scandir", "glob.glob") else None)
import __spark_entry__ as e
assert not [p for p in seen if "jars" in p or p.endswith(".txt")], seen
assert len(e.queries()) > 40 and len(e.oracle_sql()) > 40 and "@STOPWORDS@" not in str(e.oracle_sql())
assert not [p for p in seen if "jars" in p], seen
"""
    subprocess.run([sys.executable, "-c", script], check=True, cwd=Path(__spark_entry__.__file__).parent)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_counts(golden):
    assert rows(golden.where("page_id = 1"), "term", "abs") == [("code", 1), ("go", 2), ("gopher", 2), ("lang", 1)]
    assert rows(counts.page_totals(golden), "page_id", "tot") == [(1, 6), (2, 4), (3, 1)]
    assert rows(counts.corpus_totals(golden), "lang", "total_word", "total_page") == [("en", 11, 3)]
    got = {(r.page_id, r.term): (r.df, r.tfidf) for r in counts.tfidf(golden).collect()}
    assert got == {(1, "code"): (1, 0.0795), (1, "go"): (2, 0.0587), (1, "gopher"): (1, 0.159), (1, "lang"): (2, 0.0293), (2, "go"): (2, 0.044), (2, "rust"): (1, 0.3578), (3, "lang"): (2, 0.1761)}


def test_tf_sums_to_one_and_df_is_bounded(spark):
    scored = counts.tfidf(pipeline.terms(spark.read.parquet(f"{DATA}/reduced_page.parquet")))
    assert scored.groupBy("lang", "page_id").agg(F.sum("tf").alias("s")).where(F.abs(F.col("s") - 1) > 1e-9).count() == 0
    assert scored.where("tfidf < 0 OR idf < 0 OR df < 1").count() == 0


def test_topic_pseudo_word_uses_up_a_place(golden):
    words = counts.topic_words(golden, pseudo_word=True)
    assert ("", 1) in rows(words.where("topic_id = 2147483638"), "term", "n_pages")
    assert rows(topn.topic_top(words, 3).where("topic_id = 2147483638"), "term") == [("code",)]


def test_page_top_filters_lengths_only_after_a_cut(spark):
    df = spark.createDataFrame([("en", 1, w, v) for w, v in (("go", 3.0), ("abc", 2.0), ("abd", 2.0))] + [("en", 2, "go", 1.0)], "lang string, page_id bigint, term string, tfidf double")
    assert rows(topn.page_top(df, 2), "page_id", "term") == [(1, "abc"), (2, "go")]
    assert rows(topn.page_top(df, 3), "page_id", "term") == [(1, "abc"), (1, "abd"), (1, "go"), (2, "go")]


def test_latest_revisions(spark):
    data = [(1, i, f"2020-01-0{i}") for i in (5, 4, 3)] + [(1, 5, "2020-01-05"), (2, 1, None), (2, 9, "2020-01-01"), (2, 8, "2020-01-01")]
    df = spark.createDataFrame(data, "page_id bigint, rev_id bigint, t string").select("page_id", "rev_id", F.col("t").cast("timestamp").alias("ts"), F.lit(1).alias("_rank"))
    out = pages.latest_revisions(df, 2)
    assert rows(out, "page_id", "rev_id") == [(1, 4), (1, 5), (2, 8), (2, 9)] and "_rank" in out.columns
    assert rows(pages.latest_revisions(df, 2, many_copies=True), "page_id", "rev_id") == rows(out, "page_id", "rev_id")
    arrived = df.where("page_id = 1").distinct().withColumn("seq", -F.col("rev_id"))
    assert rows(pages.latest_by_arrival(arrived, 2), "rev_id") == [(3,), (5,)]
    assert rows(pages.latest_by_arrival(arrived.withColumn("seq", F.col("rev_id")), 2), "rev_id") == [(4,), (5,)]


def test_char_budget(spark):
    data = [(1, i, n) for i, n in enumerate((4, 6, 1, 0))] + [(2, 0, None)]
    df = spark.createDataFrame(data, "page_id bigint, rev_id bigint, n int").select("page_id", "rev_id", F.timestamp_seconds("rev_id").alias("ts"), F.repeat(F.lit("x"), "n").alias("text"))
    assert rows(pages.char_budget(df, 10).where("text IS NOT NULL"), "page_id", "rev_id") == [(1, 0), (1, 1)]


def test_filters(spark):
    df = spark.createDataFrame([(1, "2020-01-01 00:00:00"), (2, "2020-01-02 00:00:00"), (3, None)], "page_id bigint, t string").select("page_id", F.col("t").cast("timestamp").alias("ts"))
    assert pages.time_range(df) is df and pages.special_pages(df, []) is df and pages.special_pages(df, None) is df
    assert rows(pages.time_range(df, "2020-01-01T00:00", "2020-01-02T00:01"), "page_id") == [(2,)]
    assert rows(pages.time_range(df, start="2019-12-31T00:00"), "page_id") == [(1,), (2,)]
    assert rows(pages.special_pages(df, [2, 7]), "page_id") == [(2,)]
    assert rows(pages.special_pages(df, spark.createDataFrame([(1,), (1,), (None,)], "i bigint")), "page_id") == [(1,)]
    assert rows(pages.where_all(df, F.col("page_id") > 1, F.col("ts").isNotNull()), "page_id") == [(2,)]
    with pytest.raises(Exception):
        pages.time_range(df, "01.02.2020").collect()


def test_names(spark):
    df = spark.createDataFrame([(i,) for i in (1, 12, 9, 101)], "i bigint").withColumn("n", C.padded_name(F.col("i"), "M"))
    assert [r.n for r in df.orderBy("n").collect()] == [f"M{i:020}.json" for i in (1, 9, 12, 101)]
    assert df.where(C.page_of_name(F.col("n"), "M") == F.col("i")).count() == 4
    assert df.select(C.page_of_name(F.lit("Mx.json"), "M").alias("p")).first().p is None


def test_markup_and_tokens(spark):
    raw = "== Head ==\n* A [[b|link]] [[plain]] '''bold''' {{t|{{u|{{v}}}}}} <ref>no</ref><b>yes</b> &amp; [http://x.y site] don't x1 <!-- c -->"
    df = spark.createDataFrame([("en", raw), ("en", None), ("en", ""), ("de", "Größe " * 50_000)], "lang string, text string").withColumn("text", C.clean_markup(F.col("text")))
    out = text.explode_tokens(text.blank(df))
    assert [r.term for r in out.where("lang = 'en'").orderBy("pos").collect()] == ["head", "a", "link", "plain", "bold", "yes", "site"]
    assert out.where("lang = 'de'").count() == 50_000


def test_stopwords_and_lengths(spark):
    toks = spark.createDataFrame([("en", "the"), ("en", "isbn"), ("en", "village"), ("en", "go"), ("de", "der"), ("de", "the"), ("xx", "the"), ("xx", "der"), ("zh", "字"), ("en", "x" * 34), (None, "abc")], "lang string, term string")
    stop = text.stopword_table(spark, ["en", "de", "zh"])
    assert rows(text.drop_bad_lengths(text.drop_stopwords(toks.where("lang IS NOT NULL"), stop)), "lang", "term") == [("en", "village"), ("xx", "der"), ("zh", "字")]
    assert config.has_stopwords("pl") and config.has_stopwords("zh") and not config.has_stopwords("ro") and not config.has_stopwords("")
    assert "jest" in config.stopwords("pl") and "这个" in config.stopwords("zh") and config.stopwords("ro") == config.stopwords("")
    assert "il" in config.stopwords("vec") and "il" not in config.stopwords("xx") and "isbn" in config.stopwords("xx")


def test_badwords(spark):
    terms = spark.createDataFrame([("en", 1, 5, "darn", 3), ("en", 1, 5, "hello", 1), ("en", 2, 5, "fine", 1)], "lang string, page_id bigint, topic_id bigint, term string, abs bigint")
    lex = spark.createDataFrame([("en", "darn"), ("en", "darn"), ("en", "holy cow"), ("en", "Hello"), (None, "fine"), ("en", None)], "lang string, word string")
    assert rows(badwords.report(counts.with_total(terms), lex), "page_id", "abs", "rel", "occurrences") == [(1, 1, 0.25, 3)]
    assert badwords.for_language(counts.with_total(terms), lex, "en").count() == 1
    assert badwords.for_language(counts.with_total(terms), lex, "tr").count() == 0


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "english").write_text("darn\n Two words \n")
    assert rows(lexicons.read(spark, str(tmp_path), "simple"), "lang", "word") == [("simple", " Two words "), ("simple", "darn")]
    assert lexicons.read(spark, str(tmp_path), "tr").count() == 0
    with pytest.raises(Exception):
        lexicons.read(spark, str(tmp_path), "de").count()


def test_reverse_stems(spark):
    toks = spark.createDataFrame([("en", 1, 0, p, w, "talk") for p, w in enumerate(("talks", "talked", "talk", "talk"))] + [("en", 10, 0, 0, "tält", "t"), ("en", 2, 0, 0, "talts", "t")], "lang string, page_id bigint, rev_id bigint, pos int, term string, stem string").withColumn("ts", F.lit(None).cast("timestamp"))
    each = stems.page_reverse(toks)
    assert rows(each.where("page_id = 1"), "stem", "surface") == [("talk", "talk")]
    assert rows(stems.global_reverse(each), "stem", "surface") == [("t", "tält"), ("talk", "talk")]


def test_destem(spark):
    words = spark.createDataFrame([("en", "run", 5, 1), ("en", "walk", 2, 1)], "lang string, term string, a bigint, i bigint")
    back = spark.createDataFrame([("en", "run", "run"), ("en", "walk", "walked")], "lang string, stem string, surface string")
    assert rows(stems.destem(words, back), "surface", "a") == [("run", 5), ("walked", 2)]
    assert rows(stems.destem_lossy(words, back), "surface", "a") == [("walked", 2)]


def test_stemmers(spark):
    df = spark.createDataFrame([(w,) for w in ("ponies", "cats", "glass", "buses", "is", "trees", "corpus")], "term string")
    assert dict(rows(stems.stem_terms(df), "term", "stem")) == {"ponies": "pony", "cats": "cat", "glass": "glass", "buses": "buse", "is": "is", "trees": "tree", "corpus": "corpus"}
    swedish = {"jaktkarlarne": "jaktkarl", "klokaste": "klok", "kloster": "klost", "jämtlands": "jämtland", "hundarna": "hund", "friskt": "frisk", "rättslig": "rätts"}
    got = dict(rows(stems.stem_terms(spark.createDataFrame([(w,) for w in swedish], "term string"), stemmers.swedish), "term", "stem"))
    assert got == swedish


def test_config():
    with pytest.raises(ValueError):
        config.Limits(page_words=0)
    with pytest.raises(ValueError):
        config.check_language("")
    assert config.check_language("eml") == "eml"
    assert (config.min_word_length("vi"), config.min_word_length("en")) == (1, 3)
    assert config.lexicon_language("cr") == "en" and config.lexicon_language("ru") is None
    assert config.nlp_model("hu") == ("xx", False) and config.nlp_model("la") == ("it", False)
    assert (config.stemmer("sv"), config.stemmer("ar"), config.stemmer("en"), config.stemmer("ja")) == ("snowball", "isri", None, None)


GOLDEN_STEMS = {
    "sv": {"flickorna": "flick", "flickor": "flick", "hundarna": "hund", "friskt": "frisk"},
    "hu": {"babakocsi": "babakocs", "babakocsijáért": "babakocs", "babakocsit": "babakocs", "házakban": "ház", "kertekkel": "kert", "könyveim": "könyv", "asztalokat": "asztal", "ház": "ház", "": "", "k": "k"},
    "ar": {"المكتبات": "كتب", "الكتابة": "كتب", "يدرسون": "درس", "مدرسة": "درس", "والكتاب": "كتب", "من": "من", "": ""},
}


def test_golden_stems():
    for lang, words in GOLDEN_STEMS.items():
        assert {w: stemmers.STEMMERS[lang](w) for w in words} == words


def test_languages_have_their_own_stemmers(spark):
    """Swedish, Hungarian and Arabic are stemmed; languages that are lemmatised, or have no stemmer, aren't."""
    words = {(lang, w): s for lang, ws in GOLDEN_STEMS.items() for w, s in ws.items() if w} | {("en", "ponies"): "ponies", ("ja", "cats"): "cats", ("", "cats"): "cats"}
    toks = spark.createDataFrame([(lang, 1, 1, w) for lang, w in words] * 2, "lang string, page_id bigint, topic_id bigint, term string")
    got = {(r.lang, r.term): r.stem for r in stems.stem_by_language(counts.page_terms(toks)).collect()}
    assert got == words
    more = {(r.lang, r.term): r.stem for r in stems.stem_by_language(counts.page_terms(toks), suffixes=True).collect()}
    assert more == words | {("en", "ponies"): "pony", ("ja", "cats"): "cat", ("", "cats"): "cat"}


@pytest.mark.parametrize("stem", ["", "languages", "suffixes"])
def test_engine_round_trip(spark, tmp_path, stem):
    delivered = spark.read.parquet(f"{DATA}/reduced_page.parquet")
    lexicon = spark.read.parquet(f"{DATA}/badword_lexicon.parquet")
    out = pipeline.Engine(config.Limits(page_words=5), stem=stem).run(delivered, lexicon, str(tmp_path / "out"), "en")
    assert out.pages().where(F.size("words") > 5).count() == 0 and out.pages().count() > 10
    assert out.global_words().select("total_word").distinct().count() == 1 and out.topics().count() > 0
    ids = [r.page_id for r in out.iterate("pages", "page_id")]
    assert ids == sorted(ids)
    out.delete()
    with pytest.raises(FileNotFoundError):
        results.Results(spark, str(tmp_path / "out"), "en")


def test_engine_on_empty_and_null_input(spark, tmp_path):
    schema = spark.read.parquet(f"{DATA}/reduced_page.parquet").schema
    lexicon = spark.createDataFrame([], "lang string, word string")
    for data in ([], [(1, None, None, None, None, None), (2, None, "en", None, None, []), (3, None, "en", None, None, [(1, None, None), (2, None, "")])]):
        out = pipeline.Engine().run(spark.createDataFrame(data, schema), lexicon, str(tmp_path / f"o{len(data)}"))
        assert out.pages().count() == out.topics().count() == out.global_words().count() == out.badwords().count() == 0


def test_line_protocol(spark, tmp_path):
    read = lambda path: [x for p in sorted((tmp_path / path).glob("part-*")) for x in p.read_text().splitlines()]
    df = spark.createDataFrame([(2, "b"), (1, "ä,}"), (None, "x")], "i bigint, w string").select("i", F.struct("w").alias("v"))
    results.write_lines(df, str(tmp_path / "l"), "i", "v")
    lines = read("l")
    assert lines == ['{"1":{"w":"ä,}"},', '"2":{"w":"b"},', "}"] and json.loads(lines[0][:-1] + "}")
    assert rows(results.read_lines(spark, str(tmp_path / "l"), "struct<w:string>").select("key", "value.w"), "key", "w") == [("1", "ä,}"), ("2", "b")]
    results.write_lines(df.limit(0), str(tmp_path / "none"), "i", "v")
    assert read("none") == ["{}"] and results.read_lines(spark, str(tmp_path / "none"), "struct<w:string>").count() == 0
    many = spark.range(1000).select(F.concat(F.lit('a"'), F.col("id").cast("string")).alias("i"), F.col("id").alias("v")).repartition(4)
    results.write_lines(many, str(tmp_path / "many"), "i", "v", whole=True)
    whole = json.loads("".join(read("many")))
    assert whole == {f'a"{i}': i for i in range(1000)} and list(whole) == sorted(whole)
    (tmp_path / "one").write_text('{"a": 1, "b": 2}')
    assert rows(results.read_lines(spark, str(tmp_path / "one"), "bigint"), "key", "value") == [("a", 1), ("b", 2)]


def test_older_layout(spark, tmp_path):
    """The four files are single, valid gzip files with the names and fields of the format, and open again; other files are left alone."""
    found = pipeline.Engine(config.Limits(page_words=5)).run(spark.read.parquet(f"{DATA}/reduced_page.parquet"), spark.read.parquet(f"{DATA}/badword_lexicon.parquet"), str(tmp_path / "out"), "en")
    layout.export(found, str(tmp_path / "old"), "en")
    assert sorted(p.name for p in (tmp_path / "old").iterdir() if not p.name.startswith(".")) == sorted(layout.FILES.values())
    words = json.loads(gzip.open(tmp_path / "old" / layout.FILES["words"]).read())
    assert words == {r.term: r.a for r in found.global_words().collect()}
    lines = gzip.open(tmp_path / "old" / layout.FILES["pages"]).read().decode().splitlines()
    assert lines[0][0] == "{" and lines[-1] == "}" and set(json.loads("{" + lines[1][:-1] + "}").popitem()[1]) == {"TopicID", "Tot", "Words"}
    old = layout.Layout(spark, str(tmp_path / "old"), "en")
    shown = lambda df, *names: rows(df.select(*(F.to_json(n).alias(n) if n in ("words", "badw") else n for n in names)), *names)
    for kind, names in (("pages", ("page_id", "topic_id", "tot", "words")), ("badwords", ("page_id", "topic_id", "abs", "rel", "badw"))):
        assert shown(getattr(old, kind)(), *names) == shown(getattr(found, kind)(), *names)
    assert shown(old.topics(), "topic_id", "words") == shown(found.topics().where("topic_id IS NOT NULL"), "topic_id", "words")
    (tmp_path / "old" / "mine").write_text("x")
    old.delete()
    assert [p.name for p in (tmp_path / "old").iterdir() if not p.name.startswith(".")] == ["mine"]
    with pytest.raises(FileNotFoundError):
        layout.Layout(spark, str(tmp_path / "old"), "en")


def test_a_failed_run_is_taken_up_again(spark, tmp_path, monkeypatch):
    """Steps that were finished are read, not computed; one that was broken off is computed anew."""
    delivered, lexicon = spark.read.parquet(f"{DATA}/reduced_page.parquet"), spark.read.parquet(f"{DATA}/badword_lexicon.parquet")
    engine = pipeline.Engine(work=str(tmp_path / "work"))
    with monkeypatch.context() as m:
        m.setattr(counts, "corpus_totals", lambda terms: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            engine.run(delivered, lexicon, str(tmp_path / "out"))
    (tmp_path / "work" / "words" / "_SUCCESS").unlink()
    before = (tmp_path / "work" / "terms" / "_SUCCESS").stat().st_mtime_ns
    want = pipeline.Engine().run(delivered, lexicon, str(tmp_path / "other"))
    got = engine.run(delivered, lexicon, str(tmp_path / "out"))
    assert (tmp_path / "work" / "terms" / "_SUCCESS").stat().st_mtime_ns == before and (tmp_path / "work" / "words" / "_SUCCESS").exists()
    assert rows(got.global_words(), "lang", "term", "a", "i") == rows(want.global_words(), "lang", "term", "a", "i")


def test_providers_and_bad_records(spark):
    def make():
        def tokens_of(text, lang):
            if "bad" in text:
                raise ValueError(text)
            return text.split()

        return tokens_of

    text.text_provider("test")(make)
    df = spark.createDataFrame([("en", "good words"), ("en", "bad words"), (None, None)], "lang string, text string")
    assert [r.tokens for r in text.PROVIDERS["test"](df, "drop").collect()] == [["good", "words"], [], []]
    with pytest.raises(Exception):
        text.PROVIDERS["test"](df).collect()


def test_lemmas(spark):
    terms = spark.createDataFrame([("en", "cats", 2), ("en", "under", 1), ("en", "odd", 1), ("de", "cats", 1)], "lang string, term string, abs bigint")
    lemmas = spark.createDataFrame([("en", "cats", "cat", "NOUN"), ("en", "under", None, "ADP"), ("en", "odd", None, None)], "lang string, word string, lemma string, pos string")
    assert rows(text.lemmatise(terms, lemmas), "lang", "term", "abs") == [("de", "cats", 1), ("en", "cat", 2), ("en", "odd", 1)]


def test_other_sources(spark):
    turns = spark.createDataFrame([(1, 0, "first"), (1, 1, "second"), (None, 0, "x")], "conv bigint, turn int, text string")
    assert rows(revisions(pages_of_turns(turns, "conv", "turn", "text")), "page_id", "rev_id", "text") == [(1, 0, "first"), (1, 1, "second")]


def test_store_is_idempotent_and_takes_late_pages(spark, tmp_path):
    df = revisions(spark.read.parquet(f"{DATA}/reduced_page.parquet"))
    store = RevisionStore(spark, str(tmp_path / "s"), keep=3, compact=3)
    assert store.read().count() == 0
    part = F.pmod("rev_id", F.lit(5))
    for i in range(5):
        store.upsert(df.where(part == i), i)
        store.upsert(df.where(part == i), i)
        assert rows(store.read(), "page_id", "rev_id") == rows(pages.latest_revisions(df.where(part <= i), 3), "page_id", "rev_id")
    kept = {p.name for p in (tmp_path / "s").iterdir()}
    assert "base-2" in kept and {"delta-3", "delta-4"} <= kept and not {"delta-0", "delta-1", "delta-2"} & kept
    (tmp_path / "s" / "delta-9").mkdir()  # as a batch leaves it that fails before its manifest is there
    (tmp_path / "s" / "manifest" / "x.new").write_text("{")
    assert rows(store.read(), "page_id", "rev_id") == rows(pages.latest_revisions(df, 3), "page_id", "rev_id")


def test_one_exchange_to_page_terms(spark):
    plan = pipeline.terms(spark.read.parquet(f"{DATA}/reduced_page.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan


def exchanges(df):
    df.collect()  # so that the plan is the one that ran
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_exchanges(spark):
    """From saved page terms, scoring needs no exchange, and ranking the words of pages one."""
    terms = catalogue._saved_terms(spark, DATA)
    scored = counts.tfidf(terms, totals=save(counts.corpus_totals(terms), "totals"))
    assert exchanges(scored) == 0
    assert exchanges(topn.page_top(scored, 50)) == 1


def test_frequencies_of_rare_words_are_joined(golden, monkeypatch):
    terms = counts.with_total(golden)
    want = rows(counts.tfidf(terms), "page_id", "term", "df", "tfidf")
    for most in (1, 2, 3):
        monkeypatch.setattr(counts, "HOT_WORDS", most)
        assert rows(counts.tfidf(terms), "page_id", "term", "df", "tfidf") == want


def test_nothing_outside_imports_the_subpackage():
    import pathlib
    import re

    root = pathlib.Path(catalogue.__file__).parents[1]
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"\bllm\b", p.read_text()), p
