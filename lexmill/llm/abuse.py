"""Abusive, hateful or sexual language: subword embeddings under a linear softmax, trained in numpy.

A text is cut into segments: sentences, and overlapping stretches of ``SPAN`` words of longer
ones.  A segment's features are the character n-grams of its words (with their edges), the
words and the pairs of neighbours, hashed into a table of embeddings; their mean goes through a
linear softmax.  Embeddings and softmax are trained together.  A misspelt word shares n-grams
with the word it was made from.  A text's score is that of its worst segment.

Labels are for whole texts.  Training begins with every segment of a labelled text under its
label, by one model for each half of the texts.  Then each half's abusive segments are named by the model of the
other half, which can't have learnt them by heart: the worst segment of an abusive text if that model finds it
abusive, and others it is sure of.  Texts in which it finds nothing are set aside, as raters err.  This is done twice; the final
model is trained on all segments so chosen and those of the texts that aren't abusive.
Features of few texts are left at zero, so that the invented and rare words of a text aren't learnt by heart.

Labels are few beside texts.  Up to ``PER_CLASS`` labelled texts of each kind are used.  What is missing to ``FILL`` comes from the
other texts: of those in which the model finds abuse it is sure of, the worst segment; of a sample in which it finds
none, the text.  The model is then trained anew, ``ROUNDS`` times.

For scoring, embeddings and softmax collapse to one number per feature, so a text costs a few lookups per character.

Nulls: a row with a null id or text has no score; an empty text scores 0.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm import vec
from lexmill.scratch import save

BITS = 18
ORDERS = (3, 4)
SPAN = 10
SMOOTH = 6  # added to a segment's number of features, so that a few words alone don't decide
LEAST_SHARE = 0.004  # a feature of fewer texts than this share of the abusive ones, or of one text only, learns nothing
DIM = 4
PER_CLASS = (2000, 5000)  # labelled texts used at most, abusive and not, by hash
LEAST_BAD = 50  # abusive labelled texts from which others are added; what fewer teach isn't sure enough
FILL = (1000, 1500)  # texts of each kind that are wanted; others fill up to them, by hash
MOST_CHARS = 30_000_000  # of the texts of one kind
ROUNDS = 2
SURE, CALM = 0.5, 0.2  # scores from which, and up to which, a text without label counts as abusive, or not
HELD_POSITIVES = 100  # held-out abusive texts needed to choose a threshold; with fewer it is 0.5
ENDS = np.array([ord(c) for c in ".!?。！？\n"], np.uint32)
U32 = np.uint32


@functools.cache
def _chars() -> np.ndarray:
    return (vec.char_table() >> np.uint64(32)).astype(U32)


def _ngrams(w: vec.Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By order: the feature at each position, and for each word the first position and the one after the last."""
    cp = np.where(vec.alnum_table()[w.cp], w.cp, U32(1))
    cp = np.concatenate((np.ones(1, U32), cp, np.ones(max(ORDERS), U32)))  # position p + 1 is character p
    t = _chars()[cp]
    h, first = t, w.start
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * U32(0x9E3779B1) + t[n - 1 :]
        if n in ORDERS:
            yield ((h ^ (h >> U32(15))) * U32(0x85EBCA77 + 2 * n)) >> U32(32 - BITS), first, np.maximum(w.end + 3 - n, first)


def _joint(w: vec.Words, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of whole words; of pairs with the next word; whether there is a next one in the sentence."""
    word = (w.hash >> np.uint64(64 - BITS)).astype(np.int64)
    with_next = np.zeros(len(w.hash), bool)
    with_next[:-1] = sentence[1:] == sentence[:-1]
    pair = (vec.mix(w.hash * np.uint64(3) + np.roll(w.hash, -1)) >> np.uint64(64 - BITS)).astype(np.int64)
    return word, pair, with_next


def _segments(w: vec.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence of each word; first word and the word after the last of each segment)."""
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.concatenate(([0], np.cumsum(np.isin(w.cp, ENDS))))
    new = np.concatenate(([True], (w.doc[1:] != w.doc[:-1]) | (ends[w.start[1:]] != ends[w.end[:-1]])))
    sentence = np.cumsum(new) - 1
    start = np.flatnonzero(new)
    place = np.arange(n) - start[sentence]
    length = np.diff(np.append(start, n))[sentence]
    half = SPAN // 2
    a = np.flatnonzero((place % half == 0) & ((place == 0) | (place + half < length)))
    return sentence, a, np.minimum(a + SPAN, (start[sentence] + length)[a])


@dataclass
class Model:
    table: np.ndarray  # one float32 per feature
    bias: float
    threshold: float

    def segment_scores(self, texts: list[str]) -> Iterator[tuple[int, int, vec.Words, np.ndarray, np.ndarray, np.ndarray]]:
        """By block with segments: first text and the one after the last, words, first word and the one after the last of each segment, and its logit."""
        for lo, hi in vec.blocks(texts):
            w = vec.words(texts[lo:hi])
            sentence, a, b = _segments(w)
            if not len(a):
                continue
            word, pair, with_next = _joint(w, sentence)
            total = self.table[word].astype(np.float64) + np.where(with_next, self.table[pair], 0)
            count = 1 + with_next
            for grams, p, q in _ngrams(w):
                run = np.concatenate(([0.0], np.cumsum(self.table[grams], dtype=np.float64)))
                total += run[q] - run[p]
                count = count + (q - p)
            total, count = (np.concatenate(([0], np.cumsum(x))) for x in (total, count))
            yield lo, hi, w, a, b, (total[b] - total[a]) / (count[b] - count[a] + SMOOTH) + self.bias

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for lo, hi, w, a, _, logit in self.segment_scores(texts):
            best = np.full(hi - lo, -np.inf)
            np.maximum.at(best, w.doc[a], logit)
            out[lo:hi] = 1 / (1 + np.exp(-np.clip(best, -50, 50)))
            out[lo:hi][np.isinf(best)] = 0
        return out

    def worst(self, texts: list[str], score: float) -> list[str | None]:
        """Of each text with a segment of at least this score, the worst segment."""
        out: list[str | None] = [None] * len(texts)
        for lo, _, w, a, b, logit in self.segment_scores(texts):
            order = np.lexsort((logit, w.doc[a]))
            last = order[np.append(w.doc[a][order][1:] != w.doc[a][order][:-1], True)]
            for i in last[logit[last] >= np.log(score / (1 - score))]:
                out[lo + w.doc[a[i]]] = w.cp[w.start[a[i]] : w.end[b[i] - 1]].tobytes().decode("utf-32-le", "surrogatepass")
        return out


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of all segments in a row; number of features of each segment; text of each segment)."""
    rows, sizes, docs = [], [], []
    for lo, hi in vec.blocks(texts):
        w = vec.words(texts[lo:hi])
        sentence, a, b = _segments(w)
        if not len(a):
            continue
        word, pair, with_next = _joint(w, sentence)
        n = len(w.hash)
        feats, owner = [word, pair[with_next]], [np.arange(n), np.flatnonzero(with_next)]
        for grams, p, q in _ngrams(w):
            size = q - p
            at = np.repeat(p - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
            feats.append(grams[at].astype(np.int64))
            owner.append(np.repeat(np.arange(n), size))
        feats, owner = np.concatenate(feats), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        feats = feats[order].astype(np.int32)
        at = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))
        size = at[b] - at[a]
        idx = np.repeat(at[a] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        rows.append(feats[idx])
        sizes.append(size)
        docs.append(w.doc[a] + lo)
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(sizes), np.concatenate(docs)


def _order(f: np.ndarray) -> np.ndarray:
    """A stable order of features, by 16 bits at a time, which numpy sorts in linear time."""
    low = np.argsort((f & 0xFFFF).astype(np.uint16), kind="stable")
    return low[np.argsort((f >> 16).astype(np.uint16)[low], kind="stable")]


class _Trainer:
    def __init__(self, rng: np.random.Generator):
        self.rng = rng
        self.e = np.zeros((DIM, 1 << BITS), np.float32)
        self.w = rng.normal(0, 0.5, (DIM, 2)).astype(np.float32)
        self.b = np.zeros(2, np.float32)
        self.ge, self.gw, self.gb = np.full(1 << BITS, 1e-8, np.float32), np.full((DIM, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)

    def epochs(self, feats, used, size, y, weight, n: int, rate: float, batch: int = 2000) -> None:
        """``used``: how many of ``feats`` each segment has; ``size``: how many features it has in all."""
        start = np.concatenate(([0], np.cumsum(used)))
        keep = np.flatnonzero((weight > 0) & (used > 0))
        parts = np.array_split(self.rng.permutation(keep), max(1, len(keep) // batch))
        prepared = []
        for p in parts:
            if not len(p):
                continue
            s = used[p]
            idx = np.repeat(start[p] - np.concatenate(([0], np.cumsum(s)[:-1])), s) + np.arange(s.sum())
            f = feats[idx]
            owner = np.repeat(np.arange(len(p), dtype=np.int32), s)
            order = _order(f)
            ordered = f[order]
            first = np.flatnonzero(np.diff(ordered, prepend=-1))
            prepared.append((p, f, np.concatenate(([0], np.cumsum(s)[:-1])), owner[order], ordered[first], first))
        for _ in range(n):
            for p, f, first, owner, uniq, ufirst in prepared:
                hidden = np.stack([np.add.reduceat(e[f], first) for e in self.e], axis=1) / size[p][:, None].astype(np.float32)
                z = hidden @ self.w + self.b
                z -= z.max(axis=1, keepdims=True)
                prob = np.exp(z)
                prob /= prob.sum(axis=1, keepdims=True)
                prob[np.arange(len(p)), y[p]] -= 1
                g = (prob * weight[p][:, None]).astype(np.float32)
                gh = (g @ self.w.T) / size[p][:, None].astype(np.float32)
                grad = [np.add.reduceat(x[owner], ufirst) for x in np.ascontiguousarray(gh.T)]
                self.ge[uniq] += sum(x**2 for x in grad) / DIM
                step = rate / np.sqrt(self.ge[uniq])
                for e, x in zip(self.e, grad):
                    e[uniq] -= step * x
                gw, gb = hidden.T @ g, g.sum(axis=0)
                self.gw += gw**2
                self.gb += gb**2
                self.w -= rate * gw / np.sqrt(self.gw)
                self.b -= rate * gb / np.sqrt(self.gb)

    def collapsed(self) -> tuple[np.ndarray, float]:
        return ((self.w[:, 1] - self.w[:, 0]) @ self.e).astype(np.float32), float(self.b[1] - self.b[0])


def train(texts: list[str], positive: np.ndarray, votes: np.ndarray, sure: list[str] = (), calm: list[str] = (), rarity: float = 1.0, seed: int = 7) -> Model:
    """``positive``: raters who found the text abusive, of ``votes``.  ``sure`` and ``calm``: abusive segments, and texts without abuse, by an earlier model.

    With enough labelled texts, a fifth of them is held out to set the threshold.  ``rarity``: how much rarer abuse is in all texts than among the labelled.
    """
    labelled = len(texts)
    texts = [*texts, *sure, *calm]
    positive = np.concatenate((positive, np.full(len(sure), 2), np.zeros(len(calm), np.int64)))
    votes = np.concatenate((votes, np.full(len(sure), 2), np.ones(len(calm), np.int64)))
    rng = np.random.default_rng(seed)
    label = 2 * positive > votes
    sure = np.abs(2 * positive - votes) / np.maximum(votes, 1)
    single = votes < 2
    held = (rng.random(len(texts)) < 0.2) & (np.arange(len(texts)) < labelled) & (label[:labelled].sum() >= 5 * HELD_POSITIVES)
    feats, size, doc = _features(texts)
    if not len(size) or not label.any() or label.all():
        return Model(np.zeros(1 << BITS, np.float32), -10.0, 0.5)
    order = _order(feats)
    ordered, of = feats[order], np.repeat(doc.astype(np.int32), size)[order]  # texts in order within a feature
    other = np.concatenate(([True], (ordered[1:] != ordered[:-1]) | (of[1:] != of[:-1])))
    known = np.bincount(ordered[other], minlength=1 << BITS) >= max(2, round(LEAST_SHARE * label.sum()))
    del order, ordered, of, other
    mask = known[feats]
    used = np.add.reduceat(mask, np.concatenate(([0], np.cumsum(size)[:-1])), dtype=np.int64)
    feats = feats[mask]
    owner = np.repeat(np.arange(len(size), dtype=np.int32), used)
    size = size + SMOOTH
    count = np.bincount(doc, minlength=len(texts))
    y = label[doc].astype(np.int64)
    base = np.where(held, 0, np.maximum(sure, 0.1) * np.where(single, 0.6, 1.0))[doc]
    half = rng.random(len(texts)) < 0.5

    def fitted(weight: np.ndarray, epochs: int, t: _Trainer | None = None) -> tuple[np.ndarray, float]:
        if t is None:
            t = _Trainer(rng)
            t.e[:, known] = rng.normal(0, 0.1, (DIM, int(known.sum())))
        t.epochs(feats, used, size, y, weight, epochs, 0.2)
        return t.collapsed()

    weight = base * np.where(y == 1, 3.0 / np.maximum(count[doc], 1) ** 0.5, 1.0)
    for stage in range(2):
        logit = np.zeros(len(size))
        for part in (half, ~half):
            table, bias = fitted(np.where(part[doc], weight, 0), 4)
            other = ~part[doc]
            logit[other] = (np.bincount(owner, weights=table[feats], minlength=len(size)) / size + bias)[other]
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, doc, logit)
        usual, most = np.quantile(top[~label & np.isfinite(top)], (0.95, 0.99))
        chosen = (logit >= np.maximum(top[doc] - 1e-9, usual)) | (logit > most)
        contradicted = single & ~label & (top > 2.5)
        weight = np.where(y == 1, 3.0 * chosen, ~contradicted[doc]) * base
    final = _Trainer(rng)
    final.e[:, known] = rng.normal(0, 0.1, (DIM, int(known.sum())))
    for epochs in (6, 4):  # the second time with the negative segments that the first took for abusive
        table, bias = fitted(weight, epochs, final)
        logit = np.bincount(owner, weights=table[feats], minlength=len(size)) / size + bias
        weight = np.where((y == 0) & (logit > -2.0) & ~contradicted[doc], 2 * base, weight)
    model = Model(table, bias, 0.5)
    check = np.flatnonzero(held & (votes >= 2) & (sure > 0.99))
    if label[check].sum() >= HELD_POSITIVES // 2:
        s, truth = model.scores([texts[i] for i in check]), label[check]
        steps = np.linspace(0.2, 0.95, 31)
        f1 = [2 * ((s >= x) & truth).sum() / max(((s >= x) * np.where(truth, 1, rarity)).sum() + truth.sum(), 1) for x in steps]
        best = np.flatnonzero(np.array(f1) >= max(f1) - 1e-9)
        model.threshold = float(steps[best[np.argmin(np.abs(steps[best] - 0.5))]])
    return model


def votes(labels: DataFrame, id_col: str, rater: str, label: str, positive: tuple[str, ...] = ("abusive", "1")) -> DataFrame:
    """(id, positive, votes): distinct raters per text; null labels don't count."""
    rows = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(rater).alias("rater"), F.lower(F.trim(F.col(label))).isin(*positive).cast("int").alias("bad")).where("id IS NOT NULL AND bad IS NOT NULL").distinct()
    return rows.groupBy("id").agg(F.sum("bad").alias("positive"), F.count("*").alias("votes"))


def _pick(rows: DataFrame, most: int) -> DataFrame:
    """Of rows (id, chars), those with the smallest hash of the id: at most ``most``, and MOST_CHARS characters together, none with a twentieth of them."""
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(most).toPandas()
    picked = picked[picked["chars"] <= MOST_CHARS // 20]  # none so long that it leaves no room
    ids = picked["id"][picked["chars"].cumsum() <= MOST_CHARS]
    return rows.sparkSession.createDataFrame([(int(i),) for i in ids], "id bigint")


def _named(model):
    """Task over (id, text): the worst segment of the texts in which the model is sure to find abuse."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            worst = pa.array(model.value.worst(b.column(1).to_pylist(), SURE), pa.string())
            yield pa.record_batch([b.column(0), worst], names=["id", "segment"]).filter(worst.is_valid())

    return run


def fit(texts: DataFrame, id_col: str, text_col: str, voted: DataFrame, per_class: tuple[int, int] = PER_CLASS, fill: tuple[int, int] = FILL) -> Model:
    """Train on at most ``per_class`` labelled texts, abusive and not, and on other texts where these are fewer than ``fill``.

    All are those with the smallest hash of the id, and those of a kind have at most MOST_CHARS characters; only they go to the driver.
    With fewer abusive labelled texts than ``fill``, all texts are read again in each round, to find more.
    """
    spark = texts.sparkSession
    rows = texts.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    voted = save(voted, "voted")
    sizes = save(rows.groupBy("id").agg(F.max(F.length("text")).alias("chars")).join(voted, "id", "left"), "lengths")
    bad = 2 * F.col("positive") > F.col("votes")
    parts = [_pick(sizes.where(kind).select("id", "chars"), most) for kind, most in ((bad, per_class[0]), (~bad, per_class[1]), (F.col("votes").isNull(), fill[1]))]
    want = parts[0].union(parts[1]).union(parts[2]).join(voted, "id", "left")
    got = rows.join(F.broadcast(want), "id").groupBy("id").agg(F.min("text").alias("text"), F.first("positive").alias("positive"), F.first("votes").alias("votes")).orderBy("id").toPandas()
    own = got["votes"].notna().to_numpy()
    named, positive, votes = got["text"][own].tolist(), got["positive"][own].to_numpy(np.int64), got["votes"][own].to_numpy(np.int64)
    other = got["text"][~own].tolist()
    n_bad = int((2 * positive > votes).sum())
    model = train(named, positive, votes)
    for _ in range(ROUNDS if LEAST_BAD <= n_bad < fill[0] else 0):
        found = rows.mapInArrow(_named(spark.sparkContext.broadcast(model)), "id bigint, segment string")
        found = found.join(voted.select("id"), "id", "left_anti").orderBy(F.xxhash64("id"), "id", "segment")
        sure = [r["segment"] for r in found.limit(fill[0] - n_bad).collect()]
        if not sure:
            break
        score = model.scores(other)
        calm = [other[i] for i in np.flatnonzero(score <= CALM)[: max(fill[1] - (len(named) - n_bad), 0)]]
        rarity = n_bad / max(len(named) - n_bad, 1) * (score < 0.5).sum() / max((score >= 0.5).sum(), 1)
        model = train(named, positive, votes, sure, calm, max(rarity, 1.0))
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.value.scores(b.column(1).to_pylist())
            yield pa.record_batch([b.column(0), *b.columns[2:], pa.array(s), pa.array(s >= model.value.threshold)], names=[*(n for i, n in enumerate(b.schema.names) if i != 1), "score", "review"])

    return run


def scored(texts: DataFrame, id_col: str, text_col: str, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``keep``..., score, review) of every row with an id and a text."""
    rows = texts.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"), *keep).where("id IS NOT NULL AND text IS NOT NULL")
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text")
    return rows.mapInArrow(_score(texts.sparkSession.sparkContext.broadcast(model)), f"{kinds}, score double, review boolean")
