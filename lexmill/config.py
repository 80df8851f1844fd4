"""Limits and language tables."""

from __future__ import annotations

import functools
import logging
from dataclasses import dataclass
from importlib import resources

log = logging.getLogger("lexmill")

MAX_WORD_LENGTH = 33
CHAR_BUDGET = 1_000_000
#: One run of these is a token; tokens that aren't letters only are dropped whole.
TOKEN_CLASS = r"[\p{L}\p{M}\p{N}'’_]+"

# They decide results.
LEAK_WORDS = ("file", "isbn", "noeditsection", "rowspan", "colspan", "br", "en")
HTML_WORDS = ("colspan", "colspan=", "style", "style=", "https", "http")
ONE_LETTER_LANGS = ("gan", "ja", "ko", "vi", "wuu", "zh", "zh-classical", "zh-yue")
ITALIAN_LIKE_LANGS = ("co", "eml", "fur", "lij", "lmo", "nap", "pms", "sc", "scn", "roa-tara", "vec")
LANGUAGE_NAMES = {
    "en": "english", "ar": "arabic", "da": "danish", "nl": "dutch", "fi": "finnish", "fr": "french", "de": "german", "el": "greek",
    "hu": "hungarian", "id": "indonesian", "it": "italian", "kk": "kazakh", "ne": "nepali", "no": "norwegian", "pt": "portuguese",
    "ro": "romanian", "ru": "russian", "es": "spanish", "sv": "swedish", "tr": "turkish", "hy": "armenian", "az": "azerbaijani",
    "eu": "basque", "bn": "bengali", "bg": "bulgarian", "ca": "catalan", "zh": "chinese", "sh": "croatian", "cs": "czech",
    "gl": "galician", "he": "hebrew", "hi": "hindi", "ga": "irish", "ja": "japanese", "ko": "korean", "lv": "latvian",
    "lt": "lithuanian", "mr": "marathi", "fa": "persian", "pl": "polish", "sk": "slovak", "th": "thai", "uk": "ukrainian",
    "ur": "urdu", "simple": "english",
}
#: Languages with a lexicon, apart from "simple" and "cr", which use the English one.
LEXICON_LANGS = ("en", "ar", "da", "nl", "fi", "fr", "de", "hu", "it", "no", "pt", "es", "sv", "zh", "cs", "hi", "ja", "ko", "fa", "pl", "th")
LEXICON_ALIASES = {"simple": "en", "cr": "en"}
#: Languages whose model has another code than they.
MODEL_CODES = {"simple": "en", "no": "nb"}
#: Parts of speech that lemmatised texts keep.
KEPT_POS = ("ADJ", "ADV", "NOUN", "PROPN", "VERB")
LEMMA_LANGS = ("en", "simple", "ca", "da", "de", "el", "es", "fr", "it", "lt", "mk", "nl", "pl", "pt", "ro", "ru", "no")
SNOWBALL_LANGS = ("en", "da", "nl", "fr", "de", "es", "hu", "it", "simple", "no", "pt", "ro", "ru", "sv")


@dataclass(frozen=True)
class Limits:
    """How much each cut keeps; every limit must be positive."""

    page_words: int = 50
    global_words: int = 100
    topic_words: int = 100
    revisions: int = 10

    def __post_init__(self):
        for name, value in vars(self).items():
            if value <= 0:
                raise ValueError(f"{name} must be positive, not {value}")


def check_language(lang: str) -> str:
    """Any language code but the empty one is accepted."""
    if not lang:
        raise ValueError("no language given")
    return lang


def min_word_length(lang: str) -> int:
    return 1 if lang in ONE_LETTER_LANGS else 3


def lexicon_language(lang: str) -> str | None:
    """The language whose lexicon is used, or None if there is none."""
    lang = LEXICON_ALIASES.get(lang, lang)
    return lang if lang in LEXICON_LANGS else None


@functools.cache
def _models() -> dict[str, tuple[str, bool]]:
    """Language to (name of its model, whether that lemmatises)."""
    blank = {x: ("it", False) for x in ("la", *ITALIAN_LIKE_LANGS) if x != "co"}
    lemmas = {x: (f"{MODEL_CODES.get(x, x)}_core_{'web' if MODEL_CODES.get(x, x) == 'en' else 'news'}_sm", True) for x in LEMMA_LANGS}
    return blank | lemmas | {"ja": ("ja_core_news_sm", False), "zh": ("zh_core_web_sm", False)}


def nlp_model(lang: str) -> tuple[str, bool]:
    """(name of the language model, whether it lemmatises); the multilingual blank one where there is none."""
    return _models().get(lang, ("xx", False))


def stemmer(lang: str) -> str | None:
    """The stemmer that a language's tokens go through: none for those that are lemmatised."""
    if nlp_model(lang)[1]:
        return None
    return "snowball" if lang in SNOWBALL_LANGS else "isri" if lang == "ar" else None


def _stopword_file(name: str):
    return resources.files("lexmill").joinpath("stopwords", f"{name}.txt")


@functools.cache
def base_stopwords(name: str) -> tuple[str, ...]:
    """The stopword list under a language's English name; empty if there is none.

    The lists are those of Apache Spark's StopWordsRemover, with Polish and Chinese ones of our own.
    They come with the package, so that no installation of Spark is needed to read them.
    """
    path = _stopword_file(name)
    return tuple(path.read_text("utf-8").split("\n")[:-1]) if path.is_file() else ()


def has_stopwords(lang: str) -> bool:
    """Whether the language has a list of its own (or Italian, for its minorities)."""
    name = LANGUAGE_NAMES.get("it" if lang in ITALIAN_LIKE_LANGS else lang)
    return name is not None and _stopword_file(name).is_file()


@functools.cache
def stopwords(lang: str) -> frozenset[str]:
    """Words of the language (or of Italian, for its minorities), English ones, and words that leak from markup. A language without a list uses the English one; that is logged."""
    name = LANGUAGE_NAMES.get("it" if lang in ITALIAN_LIKE_LANGS else lang)
    if lang and not has_stopwords(lang):
        log.warning("no stopword list for language %r: English words only", lang)
    return frozenset(base_stopwords(name) if name else ()) | frozenset(base_stopwords("english")) | frozenset(LEAK_WORDS)
