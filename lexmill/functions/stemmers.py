"""Stemmers by their published descriptions: Snowball for Swedish and Hungarian, ISRI for Arabic. Each takes one word in lower case."""

from __future__ import annotations

import re

# Fixed values of the Swedish stemmer.
_SV_VOWELS = "aeiouyäåö"
_SV_STEP1 = sorted(("a arna erna heterna orna ad e ade ande arne are aste en anden aren heten ern ar er heter or as arnas ernas ornas es ades andes ens arens hetens erns at andet het ast").split(), key=len, reverse=True)
_SV_S_AFTER = "bcdfghjklmnoprtvy"
_SV_STEP2 = ("dd", "gd", "nn", "dt", "gt", "kt", "tt")


def swedish(word: str) -> str:
    region = len(word)
    for i in range(1, len(word)):
        if word[i] not in _SV_VOWELS and word[i - 1] in _SV_VOWELS:
            region = max(i + 1, 3)
            break

    def ends(suffix: str) -> bool:
        return word.endswith(suffix) and len(word) - len(suffix) >= region

    found = next((s for s in _SV_STEP1 if ends(s)), "")
    if found:
        word = word[: -len(found)]
    elif ends("s") and len(word) > 1 and word[-2] in _SV_S_AFTER:
        word = word[:-1]
    if any(ends(s) for s in _SV_STEP2):
        word = word[:-1]
    if ends("fullt") or ends("löst"):
        return word[:-1]
    last = next((s for s in ("lig", "els", "ig") if ends(s)), "")
    return word[: len(word) - len(last)]


# Fixed values of the Hungarian stemmer: the steps after the instrumental, each a suffix and what replaces it.
_HU_VOWELS = "aeiouáéíóöőúüű"
_HU_DIGRAPHS = ("dzs", "cs", "gy", "ly", "ny", "sz", "ty", "zs")
_HU_DOUBLE = tuple("bb cc ccs dd ff gg ggy jj kk ll lly mm nn nny pp rr ss ssz tt tty vv zz zzs".split())


def _steps(gone: str, to_a: str = "", to_e: str = "") -> dict[str, str]:
    return dict.fromkeys(gone.split(), "") | dict.fromkeys(to_a.split(), "a") | dict.fromkeys(to_e.split(), "e")


_HU_CASE = _steps("ban ben ba be ra re nak nek val vel tól től ról ről ból ből hoz hez höz nál nél ig at et ot öt ért képp képpen kor ul ül vá vé onként enként anként ként en on an ön n t")
_HU_SPECIAL = _steps("", "án ánként", "én")
_HU_OTHER = _steps("astul estül stul stül", "ástul", "éstül")
_HU_OWNED = _steps("oké öké aké eké ké éi é", "áké áéi", "éké ééi éé")
_HU_SING = _steps("ünk unk nk juk jük uk ük em om am m od ed ad öd d ja je a e o", "ánk ájuk ám ád á", "énk éjük ém éd é")
_HU_PLUR = _steps("jaim jeim aim eim im jaid jeid aid eid id jai jei ai ei i jaink jeink eink aink ink jaitok jeitek aitok eitek itek itok jeik jaik aik eik ik", "áim áid ái áink áitok áik", "éim éid éi éink éitek éik")
_HU_PLURAL = _steps("ök ak ok ek k", "ák", "ék")


def _hungarian_region(word: str) -> int:
    """Where the first region begins: after the first consonant of a word that begins with a vowel, else after its first vowel."""
    vowel = [c in _HU_VOWELS for c in word]
    if vowel[:1] == [True]:
        i = vowel.index(False) if False in vowel else len(word)
        return min(i + len(next((d for d in _HU_DIGRAPHS if word.startswith(d, i)), "x")), len(word))
    return vowel.index(True) + 1 if True in vowel else len(word)


def hungarian(word: str) -> str:
    region = _hungarian_region(word)

    def suffix(known) -> str | None:
        """The longest known suffix, if it lies in the region."""
        found = max((s for s in known if word.endswith(s)), key=len, default=None)
        return found if found is not None and len(word) - len(found) >= region else None

    def doubled(known: tuple[str, ...]) -> str:
        """Without a suffix that follows a double consonant, which becomes single."""
        s = suffix(known)
        rest = word[: len(word) - len(s)] if s else ""
        return rest[:-2] + rest[-1] if s and rest.endswith(_HU_DOUBLE) else word

    def replaced(step: dict[str, str]) -> str:
        s = suffix(step)
        return word if s is None else word[: len(word) - len(s)] + step[s]

    word = doubled(("al", "el"))
    before = word
    word = replaced(_HU_CASE)
    if word != before and (s := suffix(("á", "é"))):
        word = word[:-1] + {"á": "a", "é": "e"}[s]
    word = replaced(_HU_SPECIAL)
    word = replaced(_HU_OTHER)
    word = doubled(("á", "é"))
    for step in (_HU_OWNED, _HU_SING, _HU_PLUR, _HU_PLURAL):
        word = replaced(step)
    return word


# Fixed values of the ISRI stemmer: affixes, and by length the patterns whose marked letters are the root's.
_AR_MARKS = re.compile("[ً-ْ]")
_AR_HAMZA = re.compile("^[آأإ]")
_AR_PREFIXES = ((6, ("كال", "بال", "ولل", "وال")), (5, ("ال", "لل")))
_AR_SUFFIXES = ((6, ("تمل", "همل", "تان", "تين", "كمل")), (5, ("ون", "ات", "ان", "ين", "تن", "كم", "هن", "نا", "يا", "ها", "تم", "كن", "ني", "وا", "ما", "هم")))
_AR_FIRST, _AR_LAST = "لبفسويتنا", "ةهيكتان"
_AR_4 = ("م(...)", "(.)ا(..)", "(..)[اوي](.)", "(...)ة")
_AR_5 = (
    "ا(.)[ات](..)", "م(..)[ايو](.)", "[اتم](...)ة", "[ميت](.)ت(..)", "[مت](.)ا(..)", "(..)[او](.)ة", "[ام]ن(...)", "ا(..)ا(.)",
    "(...)ان", "ت(..)ي(.)", "(.)ا(.)و(.)", "(.)وا(..)", "(..)ائ(.)", "(.)ا(..)ة", "(..)ا(.)ي",
)
_AR_5_TO_4 = ("[اتم](....)", "(....)ة", "(..)ا(..)")
_AR_6 = ("[ام]ست(...)", "م(..)ا(.)ة", "ا(.)ت(.)ا(.)", "ا(.)(.)و\\2(.)", "ت(.)ا(.)ي(.)")
_AR_6_TO_4 = ("ا(...)ا(.)", "مت(....)")


def _root(word: str, patterns: tuple[str, ...]) -> str | None:
    """The letters that the first matching pattern marks."""
    for p in patterns:
        if m := re.fullmatch(p, word):
            return "".join(m.groups())
    return None


def _shorter(word: str) -> str:
    """Without a last letter that is a suffix, else without a first one that is a prefix."""
    if word[-1] in _AR_LAST:
        return word[:-1]
    return word[1:] if word[0] in _AR_FIRST else word


def arabic(word: str) -> str:
    word = _AR_MARKS.sub("", word)
    for affixes, cut in ((_AR_PREFIXES, lambda w, a: w[len(a) :] if w.startswith(a) else w), (_AR_SUFFIXES, lambda w, a: w[: len(w) - len(a)] if w.endswith(a) else w)):
        for least, known in affixes:
            shorter = next((x for a in known if len(word) >= least and (x := cut(word, a)) != word), word)
            if shorter != word:
                word = shorter
                break
    if len(word) >= 4 and word.startswith("وو"):
        word = word[1:]
    word = _AR_HAMZA.sub("ا", word)
    if len(word) == 7:
        word = _shorter(word)
    if len(word) == 6:
        word = _root(word, _AR_6) or _shorter(word)
        if len(word) == 6:
            return _root(word, _AR_6_TO_4) or word
    if len(word) == 5:
        word = _root(word, _AR_5) or _shorter(word)
        if len(word) == 5:
            return _root(word, _AR_5_TO_4) or word
    if len(word) == 4:
        word = _root(word, _AR_4) or _shorter(word)
    return word


#: By language; which language's words are stemmed at all is decided by ``config.stemmer``.
STEMMERS = {"sv": swedish, "hu": hungarian, "ar": arabic}
