"""Column functions: each is one expression, evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill import config


def padded_name(page_id: Column, prefix: str = "", suffix: str = ".json") -> Column:
    """File name of a page: prefix, id padded to 20 digits, suffix."""
    return F.concat(F.lit(prefix), F.lpad(page_id.cast("string"), 20, "0"), F.lit(suffix))


def page_of_name(name: Column, prefix: str = "", suffix: str = ".json") -> Column:
    """The id in a padded name; null if it isn't one."""
    return F.regexp_extract(name, f"(?:^|/)\\Q{prefix}\\E(\\d+)\\Q{suffix}\\E$", 1).try_cast("bigint")


def bucket_1000(page_id: Column) -> Column:
    """The last three digits of an id."""
    return F.pmod(page_id, F.lit(1000))


def tf(count: Column, total: Column) -> Column:
    return count / total


def idf(pages: Column, df: Column) -> Column:
    return F.log10(pages.cast("double") / df)


def tfidf(count: Column, total: Column, pages: Column, df: Column) -> Column:
    """tf x idf, rounded to four places half away from zero."""
    return F.round(tf(count, total) * idf(pages, df) * 10000, 0) / 10000


def min_length(lang: Column) -> Column:
    return F.when(lang.isin(*config.ONE_LETTER_LANGS), 1).otherwise(3)


def good_length(word: Column, lang: Column) -> Column:
    """Whether a word's length in code points is within its language's bounds, both inclusive."""
    return F.length(word).between(min_length(lang), F.lit(config.MAX_WORD_LENGTH))


def alphabetic(word: Column) -> Column:
    return word.rlike("^\\p{L}+$")


def tokens(text: Column) -> Column:
    """Array of lower-cased tokens."""
    return F.regexp_extract_all(F.lower(text), F.lit(config.TOKEN_CLASS), F.lit(0))


def parse_time(flag: Column) -> Column:
    """A time given as yyyy-MM-ddTHH:mm; an error if it is anything else."""
    return F.to_timestamp(flag, "yyyy-MM-dd'T'HH:mm")


#: Patterns and replacements, in order; few passes, as each reads the whole text. Three of them take templates, from the inside out.
_MARKUP = (
    (r"(?is)<!--.*?-->|<(?:script|style|ref)\b[^>]*?/>|<script\b.*?</script>|<style\b.*?</style>|<ref\b.*?</ref>|\{\{[^{}]*\}\}", " "),
    (r"(?is)\{\{[^{}]*\}\}|\{\|.*?\|\}|\[\[(?:file|image|category):[^\[\]]*\]\]", " "),
    (r"\[\[(?:[^\[\]|]*\|)?([^\[\]]*)\]\]|\[[a-z]+://[^\s\]]+\s*([^\]]*)\]", "$1$2"),
    (r"</?[A-Za-z][^>]*>|&nbsp;|\{\{[^{}]*\}\}", " "),
    (r"(?m)^=+[ \t]*(.*?)[ \t]*=+[ \t]*$", "$1"),
    (r"(?m)'{2,5}|^[*#:;]+[ \t]*", ""),
)
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&"))


def clean_markup(text: Column) -> Column:
    """Text without HTML and common wiki markup: link texts and headings stay, templates, references and tables go."""
    for pattern, by in _MARKUP:
        text = F.regexp_replace(text, pattern.replace("(?m)", "(?md)"), by)
    for entity, by in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(by))
    return text


def markup_sql(column: str) -> str:
    """``clean_markup`` as an SQL expression for RE2 engines."""
    for pattern, by in _MARKUP:
        quoted, to = (x.replace("'", "''") for x in (pattern, by.replace("$", "\\")))
        column = f"regexp_replace({column}, '{quoted}', '{to}', 'g')"
    for entity, by in _ENTITIES:
        column = f"replace({column}, '{entity}', '{by}')"
    return column
