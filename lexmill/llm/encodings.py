"""Texts read with a wrong character encoding: round-trip repair.

Bytes of a multi-byte character are all above 127, so a garbled character is mostly a run of at least
two non-ASCII characters.  Each run is re-encoded under candidate legacy encodings and strictly
decoded as the encoding that was meant; the result is taken if a garbling cost drops, and tried
again for nested layers, however many.  The cost of a character grows with how little it belongs where it is:
controls, replacement characters, box drawing and symbols within words, capitals after small letters.

A run that only partly decodes is repaired where another run of the same text decoded as a
whole in the same way, or, if none did, where a part of some run decodes and lowers the run's cost.
Replacement characters (U+FFFD) show garbling that can't be restored.

Where one character was left of each, a text without garbled runs is looked at as a whole: a Chinese character inside
Latin words of a text without other Chinese is UTF-8 read as GBK; several signs inside words, that in
another one-byte encoding are letters, are letters of that encoding.

Nulls: rows with a null id or null text are left out.  Correct letters and signs of any language have nothing to repair.
"""

from __future__ import annotations

import codecs
import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Legacy encodings that a UTF-8 text may have been read in.
READ_AS = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "cp437", "mac-roman", "cp850", "cp852", "cp866", "koi8-r", "cp1254", "iso8859-15", "cp1253", "cp1257")
#: Other encodings meant, with what they were read in.
OTHERS = (("cp1252", "gbk"), ("latin-1", "gbk"), ("gbk", "utf-8"), ("cp1252", "cp1251"), ("latin-1", "cp1251"), ("latin-1", "koi8-r"))
#: Runs of non-ASCII characters, those of Chinese and full-width ones by themselves.
RUN = re.compile(r"[^\x00-\x7f\u3000-\u9fff\uff00-\uffef]{2,}|[\u3000-\u9fff\uff00-\uffef]{2,}")
SEQUENCE = re.compile(rb"(?:[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3})+")
#: Single characters: a Chinese one after a small Latin letter; a sign between two, and the ways it may be a letter.
LONE_HANZI = re.compile("(?<=[a-z])[\u4e00-\u9fff](?![\u3000-\u9fff\uff00-\uffef])")
LONE_SIGN = re.compile("(?<=[a-z])[¹³±¶¼¿](?=[a-z])")
#: A Latin letter or a quote whose UTF-8 was read as cp1252 or Latin-1.
IN_PART = re.compile("[ÂÃÄÅ][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]|â€")
ONE_BYTE = (("cp1252", "cp1250"), ("latin-1", "iso8859-2"))
LETTERS = re.compile("[^\\x00-\\x7f]")
QUOTES = frozenset("’‘“”„«»–—…‹›‚")


@functools.cache
def _codec(name: str):
    """The inverse of a single-byte encoding; bytes without a character stand for the C1 control of their number."""
    table = []
    for b in range(256):
        try:
            table.append(bytes([b]).decode(name))
        except UnicodeDecodeError:
            table.append(chr(b))
    return codecs.charmap_build("".join(table))


def _encode(run: str, name: str) -> bytes | None:
    try:
        return run.encode("gbk") if name == "gbk" else codecs.charmap_encode(run, "strict", _codec(name))[0]
    except UnicodeEncodeError:
        return None


@functools.lru_cache(100_000)
def _weight(c: str) -> float:
    o = ord(c)
    if o == 0xFFFD:
        return 4
    kind = unicodedata.category(c)
    if kind in ("Cc", "Co", "Cn", "Cs"):
        return 3
    if c in QUOTES or 0x3000 <= o < 0x3020 or 0xFF00 <= o < 0xFF66 or c in "€™":
        return 0.5
    if 0x4E00 <= o < 0xA000:
        return 0.5
    if kind[0] == "L":
        known = 0xC0 <= o < 0x180 or 0x218 <= o < 0x21C or 0x386 <= o < 0x3CF or 0x400 <= o < 0x460 or 0x1E00 <= o < 0x1F00 or 0x3040 <= o < 0x3100 or 0xAC00 <= o < 0xD7B0
        return 0.6 if known and c not in "ªº" else 1.3 if c in "ªº" else 3
    if o < 0x100:
        return 0.5 if o == 0xA0 else 0.9 if c in "¿¡£§©°" else 1.3
    return 1.6


def cost(run: str, before: str = "") -> float:
    """How garbled a run looks after the character ``before``."""
    total, letters = 0.0, 0
    for i, c in enumerate(run):
        total += _weight(c)
        letters = letters + 1 if 0xC0 <= ord(c) < 0x180 else 0
        if letters > 3:
            total += 0.4
        prev = run[i - 1] if i else before
        if c.isupper():
            if prev.islower():
                total += 0.8
            elif not i and "A" <= prev <= "Z":
                total -= 0.55
        elif i == 1 and len(run) == 2 and prev.isupper() and c in QUOTES and "A" <= before <= "Z":
            total -= 0.4
    return total


@functools.cache
def _common_hanzi(c: str) -> bool:
    try:
        lead = c.encode("gb2312")[0]
    except UnicodeEncodeError:
        return False
    return 0xB0 <= lead <= 0xD7 or lead in (0xA1, 0xA3)


def _plausible(run: str, out: str, way: tuple[str, str]) -> bool:
    if way[1] == "gbk":
        return len(out) >= 4 and len(set(out)) >= 3 and sum(map(_common_hanzi, out)) >= 0.85 * len(out)
    if way[1] != "utf-8":
        return len(run) >= (8 if way[1] == "koi8-r" else 4) and all("Ѐ" <= c < "Ѡ" for c in out) and sum(map(str.isupper, out)) <= 1
    return True


MARGIN = 0.25  # by which the cost must drop
WAYS = (*((e, "utf-8") for e in READ_AS), *OTHERS)


def _decoded(run: str, way: tuple[str, str]) -> str | None:
    """The run re-encoded and strictly decoded, if that can be done and gives something plausible."""
    raw = _encode(run, way[0])
    if raw is None:
        return None
    try:
        out = raw.decode(way[1])
    except UnicodeDecodeError as e:
        if way[1] != "gbk" or e.start < len(raw) - 1 or raw[-1] < 0x80:
            return None
        out = raw[:-1].decode(way[1]) + run[-1]  # the last character may be the first of a correct word
    return out if out != run and _plausible(run, out, way) else None


@functools.lru_cache(50_000)
def options(run: str, before: str) -> tuple[tuple[float, str, tuple[str, str]], ...]:
    """The decodings of the whole run that lower its cost, best first."""
    price = cost(run, before) - MARGIN
    found = [(cost(out, before), k, out, way) for k, way in enumerate(WAYS) if (out := _decoded(run, way)) is not None]
    return tuple((c, out, way) for c, _, out, way in sorted(found) if c < price)


@functools.lru_cache(50_000)
def whole(run: str, before: str, prefer: tuple[str, str] | None = None) -> tuple[str, tuple[tuple[str, str], ...]]:
    """The run repaired through all its layers, each of which lowers its cost, and the ways taken; the preferred way is taken where it is one of the options."""
    ways = []
    while len(run) > 1 and (found := options(run, before)):
        _, run, way = next((o for o in found if o[2] == prefer), found[0])
        ways.append(way)
    return run, tuple(ways)


def common_way(runs: list[tuple[str, str]]) -> tuple[str, str] | None:
    """Of a text's runs, the way that lowers their cost most; a text was mostly read wrongly in one way."""
    gain: Counter = Counter()
    for (run, before), n in Counter(runs).items():
        now = cost(run, before)
        for c, _, way in options(run, before):
            gain[way] += (now - c) * n
    return min(gain, key=lambda w: (-round(gain[w], 6), WAYS.index(w))) if gain else None


@functools.lru_cache(50_000)
def partly(run: str, before: str, name: str) -> str:
    """The run with those parts repaired that are UTF-8 read as ``name``."""
    out, i = [], 0
    while i < len(run):
        j = i
        while j < len(run) and _encode(run[j], name) is not None:
            j += 1
        raw, at = _encode(run[i:j], name) or b"", i
        for m in SEQUENCE.finditer(raw):
            part = run[i + m.start() : i + m.end()]
            fixed = whole(part, run[i + m.start() - 1] if i + m.start() else before)[0]
            out += [run[at : i + m.start()], fixed]
            at = i + m.end()
        out.append(run[at : j + 1])
        i = j + 1
    return "".join(out)


def lone(text: str) -> tuple[str, list[str], int]:
    """``repair`` of a text in which one character was left of each garbled one."""
    hanzi = LONE_HANZI.findall(text)
    if hanzi and len(hanzi) == sum("\u4e00" <= c <= "\u9fff" for c in text):

        def letter(c: str) -> str | None:
            try:
                out = c.encode("gbk").decode("utf-8")
            except UnicodeError:
                return None
            return out if len(out) == 1 and "\xc0" <= out < "\u0180" and out.isalpha() else None

        if all(map(letter, hanzi)):
            return LONE_HANZI.sub(lambda m: letter(m.group()), text), ["gbk>utf-8"], len(hanzi)
    if len(LONE_SIGN.findall(text)) >= 2:
        for source, meant in ONE_BYTE:
            fixed = LETTERS.sub(lambda m: (_encode(m.group(), source) or m.group().encode()).decode(meant, "replace"), text)  # noqa: B023
            n = sum(a != b for a, b in zip(fixed, text))
            if len(fixed) == len(text) and all(b == a or b.isalpha() for a, b in zip(text, fixed)) and not LONE_SIGN.search(fixed):
                return fixed, [f"{source}>{meant}"], n
    return text, [], 0


def _latin(run: str, fixed: str) -> bool:
    """Whether what is new in a run are Latin letters and quotes."""
    return all("\xc0" <= c < "\u0180" and c.isalpha() or c in QUOTES for c in set(fixed) - set(run))


def _best_part(runs: list[tuple[str, str]]) -> tuple[str, str] | None:
    """Where no run decodes as a whole: the way by which parts of runs lower the cost of all of them most."""
    found = []
    runs = [r for r in runs if IN_PART.search(r[0])]
    for k, way in enumerate(WAYS[:2] if runs else ()):
        drop = sum(cost(run, before) - cost(fixed, before) for run, before in runs if (fixed := partly(run, before, way[0])) != run and _latin(run, fixed))
        if drop > MARGIN:
            found.append((-drop, k, way))
    return min(found)[2] if found else None


def repair(text: str) -> tuple[str, list[str], int]:
    """(text as repaired, ways such as 'cp1252>utf-8' by number of runs, runs repaired)."""
    ways: Counter = Counter()
    found = [(m, text[m.start() - 1] if m.start() else "") for m in RUN.finditer(text)]
    prefer = common_way([(m.group(), before) for m, before in found])
    in_part = prefer is None
    if in_part:
        prefer = _best_part([(m.group(), before) for m, before in found])
    if prefer is None:
        return lone(text)
    parts, n, at = [], 0, 0
    for m, before in found:
        run = m.group()
        fixed, taken = whole(run, before, prefer)
        if not taken and prefer[1] == "utf-8":
            fixed = partly(run, before, prefer[0])
            if in_part and (not _latin(run, fixed) or cost(fixed, before) >= cost(run, before) - MARGIN):
                fixed = run
            taken = (prefer,) if fixed != run and in_part else ()
        n += fixed != run
        ways.update(taken)
        parts += [text[at : m.start()], fixed]
        at = m.end()
    parts.append(text[at:])
    return "".join(parts), [f"{a}>{b}" for (a, b), _ in ways.most_common()], n


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            fixed, ways, n = repair(t)
            lost = t.count("�")
            if n or lost:
                rows.append((i, fixed, ways, n, lost))
        ids, fixed, ways, n, lost = zip(*rows) if rows else ((),) * 5
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(fixed, pa.string()), pa.array(ways, pa.list_(pa.string())), pa.array(n, pa.int64()), pa.array(lost, pa.int64())], names=["id", "text", "ways", "runs", "lost"])


def garbled(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, ways, runs, lost) of the garbled rows: the text as far as it could be restored, how, in how many places, and replacement characters left.

    Texts without two adjacent non-ASCII characters, such a character inside a word, or a replacement character don't leave the JVM.
    """
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL").where(F.col("text").rlike("[^\\x00-\\x7F]{2}|[a-z][\u4e00-\u9fff]|[a-z][¹³±¶¼¿][a-z]|�"))
    return rows.mapInArrow(_repair, "id bigint, text string, ways array<string>, runs bigint, lost bigint")
