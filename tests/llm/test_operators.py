"""The training-data operators against brute force, on small tables with nulls, ties, copies and hot groups."""

import collections
import functools
import random
import re
import time
import types

import numpy as np
import pyarrow as pa
import pytest

from lexmill.llm import abuse, encodings, frequent, leaks, mixing, near_duplicates, pieces, queries, term_counts, top_n, vec
from tests.conftest import DATA, check_against_sql


def words_of(t):
    return re.findall(r"[^\W_]+", t.lower())


def test_queries_equal_their_sql(spark):
    check_against_sql(spark, queries.queries(), queries.oracle_sql(), list(queries.oracle_sql()))


def test_every_query_runs(spark):
    for name, f in queries.queries().items():
        rows = f(spark, DATA).collect()
        assert len(set(rows)) == len(rows), name
        assert rows or name in ("p6_found",), name


def test_pages_are_taken_once(spark, tmp_path, monkeypatch):
    """Repeated pages count once, whether they are few or many; pages without an id are told apart by content."""
    rows = [(1, "en", {"a": 1}), (1, "en", {"a": 1}), (2, "de", {"b": 2}), (None, "en", {"c": 1}), (None, "en", {"c": 1}), (None, "en", {"d": 1}), (3, None, None), (2, "de", {"b": 2}), (4, None, {})]
    spark.createDataFrame(rows, "page_id bigint, lang string, words map<string,bigint>").repartition(4).write.parquet(str(tmp_path / "page_words.parquet"))
    for few in (10, 0):
        monkeypatch.setattr(queries, "FEW_REPEATED", few)
        got = sorted((r.lang, r.word, r.occurrences, r.pages) for r in queries.p5_terms(spark, str(tmp_path)).collect())
        assert got == [("de", "b", 2, 1), ("en", "a", 1, 1), ("en", "c", 1, 1), ("en", "d", 1, 1)]


# ---- words


def test_words_are_runs_of_letters_and_digits():
    texts = ["Ab_c 12é", "", "  ", "naïve—été\0x", "中文，字 a", "x" * 50_000 + " y"]
    w = vec.words(texts)
    assert w.counts().tolist() == [len(words_of(t.replace("\0", " "))) for t in texts]
    same = vec.words(["q AB é", "ab", "É"])
    assert same.hash[1] == same.hash[3] and same.hash[2] == same.hash[4] and len(set(same.hash.tolist())) == 3


def test_blocks_cover_all_texts():
    texts = ["a" * n for n in (5, 0, 100, 3, 3, 3)]
    assert [x for lo, hi in vec.blocks(texts, chars=10, docs=2) for x in range(lo, hi)] == list(range(6))


# ---- 1: top N


def test_top_n(spark):
    rng = random.Random(1)
    rows = [(g, f"w{rng.randrange(60)}", float(rng.randrange(8))) for g in (1, 2, 3) for _ in range(300)] + [(9, f"h{i:05}", 1.0) for i in range(3000)]
    rows += rows[:50] + [(None, "x", 1.0), (1, None, 9.0), (1, "n", None), (1, "nan", float("nan")), (4, "", 2.0), (1, "é", 7.0), (1, "z", 7.0)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "g bigint, item string, s double, rank string").repartition(7)
    got = {(r.grp, r.item, r.score, r["rank"]) for r in top_n.top_n(df, "g", "item", "s", 5).collect()}
    best = collections.defaultdict(dict)
    for g, w, s in rows:
        if g is not None and w is not None and s is not None and s == s:
            best[g][w] = max(s, best[g].get(w, s))
    want = {(g, w, s, i + 1) for g, ws in best.items() for i, (w, s) in enumerate(sorted(ws.items(), key=lambda x: (-x[1], x[0].encode()))[:5])}
    assert got == want
    assert top_n.top_n(df.limit(0), "g", "item", "s", 5).count() == 0
    with pytest.raises(ValueError):
        top_n.top_n(df, "g", "item", "s", 0)


def test_trim_sends_what_it_holds_where_groups_are_small(monkeypatch):
    """With groups smaller than n nothing can be trimmed: a task still holds a fixed number of rows; bounds stay valid."""
    monkeypatch.setattr(top_n, "HELD_ROWS", 100)
    batches = [pa.record_batch([pa.array([i * 10 + j // 2 for j in range(20)]), pa.array([f"w{j}" for j in range(20)]), pa.array([1.0 * j for j in range(20)])], names=["grp", "item", "score"]) for i in range(50)]
    out = list(top_n._trim(3)(iter(batches)))
    assert sum(b.num_rows for b in out) == 1000 and max(b.num_rows for b in out) <= 120 and not any(x for b in out for x in b.column(3).to_pylist())


# ---- 2: frequent items


def test_frequent_items_are_whole_in_a_narrow_sketch(spark):
    rng = random.Random(2)
    names = [f"w{i}" for i in range(400)]
    rows, truth = [], collections.defaultdict(collections.Counter)
    for _ in range(300):
        key = rng.choice(["en", "de", None])
        items = [rng.choice(names[: rng.choice([5, 30, 400])]) if rng.random() < 0.95 else None for _ in range(40)]
        truth[key].update(x for x in items if x is not None)
        rows.append((key, items))
    rows += [("en", []), ("fr", None)]
    df = spark.createDataFrame(rows, "k string, items array<string>").repartition(5)
    want = {(k, w, n) for k, c in truth.items() for w, n in c.items() if n >= 10 and n >= 0.01 * sum(c.values())}
    for width in (16, 2048):  # the narrow one can't name all of them: the exact pass must
        out = frequent.frequent_items(df, "k", "items", 0.01, 10, width).collect()
        assert {(r.k, r.item, r.n) for r in out} == want
        assert all(r.lower <= r.n <= r.upper for r in out if r.lower is not None)
    assert {(r.k, r.item, r.n) for r in frequent.frequent_items(df, "k", "items", 0.01, 10, most_keys=2).collect()} == want  # more keys than the sketch is for
    assert frequent.frequent_items(df.limit(0), "k", "items", 0.01).count() == 0


# ---- 3: near duplicates


def brute_pairs(rows, threshold, k, least):
    sets = {}
    for i, t in rows:
        if i is not None and t is not None and len(w := words_of(t)) >= max(k, least):
            sets[i] = {*zip(*(w[j:] for j in range(k)))}
    return {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-12}


def edited(rng, t, share):
    return " ".join("q%d" % rng.randrange(10**6) if rng.random() < share else w for w in t.split())


def near_rows(n=150):
    rng = random.Random(3)
    base = [" ".join(rng.choice(["the", "of", "a", f"w{rng.randrange(3000)}"]) for _ in range(rng.randrange(8, 120))) for _ in range(n)]
    texts = base + [edited(rng, rng.choice(base), rng.choice([0.01, 0.05, 0.1])) for _ in range(n)] + [base[0]] * 20 + ["", " ", "short", None]
    rows = list(enumerate(texts))
    return rows + [rows[1], (None, base[2])]


@pytest.mark.parametrize("threshold,k,least", [(0.7, 3, 20), (0.8, 5, 0)])
def test_near_duplicates(spark, threshold, k, least):
    rows = near_rows()
    df = spark.createDataFrame([(*r, 0) for r in rows], "i bigint, t string, a int").repartition(6)
    got = {(r.id_a, r.id_b) for r in near_duplicates.near_duplicate_pairs(df, "i", "t", threshold, k, least).collect()}
    assert got == brute_pairs(rows, threshold, k, least)
    assert near_duplicates.near_duplicate_pairs(df.limit(0), "i", "t").count() == 0


def test_near_duplicates_with_hot_keys(spark, monkeypatch):
    """Many texts share most of a template, so that keys are hot: spread over buckets, cut into large tiles and compared across."""
    rng = random.Random(4)
    template = " ".join(f"t{i}" for i in range(60))
    rows = [(i, edited(rng, template, 0.08)) for i in range(260)]
    _, _, run, _, _ = next(near_duplicates._sets([t for _, t in rows], 3, 20))
    levels = np.zeros(2 * near_duplicates.CELLS, np.uint8)
    a, c = near_duplicates._cells(run)
    levels[np.concatenate((a, c + near_duplicates.CELLS))] = 15  # as if every run were in 2**14 texts
    monkeypatch.setattr(near_duplicates, "_levels", lambda heavy: levels)
    df = spark.createDataFrame(rows, "i bigint, t string").repartition(3)
    got = {(r.id_a, r.id_b) for r in near_duplicates.near_duplicate_pairs(df, "i", "t", 0.7, 3, 20).collect()}
    assert got == brute_pairs(rows, 0.7, 3, 20)


@pytest.mark.parametrize("limits", [{"most": 2, "tile": 5}, {"bucket_bytes": 500, "buckets": 2}, {"buckets": 1}, {"buckets": 1000}])
def test_oversized_groups_and_buckets_lose_no_pair(spark, limits):
    """Groups over the limit and buckets in several pieces leave their task and are compared as large tiles."""
    rows = [(i, t) for i, t in near_rows(60) if i is not None and t]
    cid = {i: int(c[0]) for i, t in rows for _, _, _, _, c in near_duplicates._sets([t], 3, 20)}
    want = {tuple(sorted((cid[a], cid[b]))) for a, b in brute_pairs(rows, 0.7, 3, 20) if cid[a] != cid[b]}
    df = spark.createDataFrame(rows, "i bigint, t string").repartition(3)
    _, pairs = near_duplicates.class_pairs(df, "i", "t", 0.7, 3, 20, **limits)
    assert {(r.a, r.b) for r in pairs.collect()} == want


def test_tiles_lose_no_pair_within_the_radius():
    rng = np.random.default_rng(5)
    sk = rng.integers(0, 2**63, (300, 4), dtype=np.uint64) & rng.integers(0, 2**63, (300, 4), dtype=np.uint64)
    sk[100:200] = sk[:100] ^ np.uint64(5)
    n = np.full(300, 60)
    n[200:] = rng.integers(20, 200, 100)
    group = np.repeat(np.arange(6, dtype=np.uint64), (1, 2, 3, 9, 85, 200))
    allowed = near_duplicates._allowed(0.8)
    near = lambda i, j: max(int(np.bitwise_count(sk[i] ^ sk[j]).sum()), abs(int(n[i]) - int(n[j]))) <= allowed * (n[i] + n[j]) + 1e-9
    flat = lambda pairs: [tuple(sorted(p)) for a, b in pairs for p in zip(a.tolist(), b.tolist())]
    members, stats = rng.permutation(300), near_duplicates.Skipped()
    for g in (np.zeros(300, np.uint64), group):
        got = flat(near_duplicates.compare_tiles(g, members, n, sk, 0.8, stats))
        want = {tuple(sorted((int(members[i]), int(members[j])))) for i in range(300) for j in range(i + 1, 300) if g[i] == g[j] and near(members[i], members[j])}
        assert set(got) == want and len(got) == len(want) and (g.any() or len(want) >= 100)
    assert 0 < stats.skipped < stats.pairs
    got = flat(near_duplicates.compare_sides(members[:130], members[130:], n, sk, 0.8))
    assert set(got) == {tuple(sorted((int(i), int(j)))) for i in members[:130] for j in members[130:] if near(i, j)} and len(got) > 20


def test_tile_pairs_are_skipped_on_the_test_data(spark):
    """All groups of the texts of sf0.1 go through the tiles; of the tile pairs of those with several tiles, most are skipped by population counts."""
    from lexmill.sources.tables import revisions

    texts = [r.text for r in revisions(spark.read.parquet(f"{DATA.replace('0.001', '0.1')}/reduced_page.parquet")).where("text IS NOT NULL").select("text").distinct().collect()]
    batches = [pa.record_batch([pa.array(texts[i : i + 5000], pa.string())], names=["text"]) for i in range(0, len(texts), 5000)]
    levels = types.SimpleNamespace(value=np.zeros(2 * near_duplicates.CELLS, np.uint8))
    records = near_duplicates._emit(3, 20, 0.7, levels, 1, 1, near_duplicates.HOT)(iter(batches))
    groups = pa.Table.from_batches(list(near_duplicates._group(0.7, near_duplicates.HOT, near_duplicates.BUCKET_BYTES)(records)))
    assert not any(groups["large"].to_pylist())
    sketch = {}
    for _, doc, runs, n, cid in near_duplicates._sets(texts, 3, 20):
        sketch |= {int(c): (int(m), s) for c, m, s in zip(cid, n, near_duplicates._sketches(doc, runs, len(n)))}
    members = groups["members"].combine_chunks()
    ids, back = np.unique(members.flatten().to_numpy(), return_inverse=True)
    group = np.repeat(groups["gid"].to_numpy().view(np.uint64), np.diff(members.offsets.to_numpy()))
    n, sk = np.array([sketch[int(i)][0] for i in ids]), np.stack([sketch[int(i)][1] for i in ids])
    stats, pairs = near_duplicates.Skipped(), set()
    for a, b in near_duplicates.compare_tiles(group, back, n, sk, 0.7, stats):
        pairs |= {(min(p), max(p)) for p in zip(a.tolist(), b.tolist())}
    print(stats, len(pairs), len(group), len(ids))
    assert pairs and stats.skipped > 0.3 * stats.pairs > 0


def test_groups_are_components(spark):
    rows = near_rows(60)
    df = spark.createDataFrame(rows, "i bigint, t string").repartition(3)
    out = near_duplicates.near_duplicate_groups(df, "i", "t", 0.8, 5).collect()
    root = {r.id: r.group_id for r in out}
    parent = {i: i for i in root}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in brute_pairs(rows, 0.8, 5, 0):
        parent[find(a)] = find(b)
    assert len(out) == len(root)
    assert {frozenset(i for i in root if root[i] == g) for g in set(root.values())} == {frozenset(i for i in root if find(i) == g) for g in {find(i) for i in root}}


def test_verification_tells_runs_apart_that_share_32_bits(monkeypatch):
    low = np.arange(1, 11, dtype=np.uint64)
    runs = np.concatenate((low, low | np.uint64(1 << 40)))  # two sets without a common run
    monkeypatch.setattr(near_duplicates, "_sets", lambda *_: iter([(0, np.repeat([0, 1], 10), runs, np.array([10, 10]), np.array([7, 8]))]))
    everything = types.SimpleNamespace(value=np.full(1 << 14, -1, np.int64).view(np.uint64))
    (sets,) = near_duplicates._arrays(5, 0, everything)([pa.record_batch([pa.array(["", ""])], names=["text"])])
    x, y = sets.column("runs")
    rows = [(1, 7, None, x), (1, 8, None, y), (1, 7, 8, None), (2, 7, None, x), (2, 9, None, x), (2, 7, 9, None)]
    (got,) = near_duplicates._verify(0.8)([pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["f", "a", "b", "runs"])])
    assert got.to_pylist() == [{"a": 7, "b": 9, "similarity": 1.0}]


def test_the_bitmap_holds_all_classes(spark):
    ids = np.random.default_rng(6).integers(-(2**63), 2**63, (500, 2))
    df = spark.createDataFrame(pa.table([pa.array(ids[:, 0]), pa.array(ids[:, 1])], names=["a", "b"])).repartition(3)
    words = near_duplicates._bloom(df, 20)
    assert near_duplicates._inside(ids.ravel(), words).all()
    assert near_duplicates._inside(ids.ravel() + 1, words).sum() < 20


def test_groups_hold_short_texts(spark):
    """Texts with fewer words than a run come out, exact copies in one group; only min_words leaves texts out."""
    texts = ["See above", "see above!", "above see", "ok", "OK", "", "", " ", "...", "中文没有空格的长句子" * 40, "中文没有空格的长句子" * 40, "a b c d", "a b c d e", "a b c d e", None]
    df = spark.createDataFrame([*enumerate(texts), (None, "ok"), (3, "ok")], "i bigint, t string").repartition(3)
    out = near_duplicates.near_duplicate_groups(df, "i", "t", 0.8, 5).collect()
    assert sorted(r.id for r in out) == [i for i, t in enumerate(texts) if t is not None]
    groups = {frozenset(r.id for r in out if r.group_id == g) for g in {r.group_id for r in out}}
    assert groups == {frozenset(g) for g in ((0, 1), (2,), (3, 4), (5, 6), (7,), (8,), (9, 10), (11,), (12, 13))}
    assert {(r.id_a, r.id_b) for r in near_duplicates.near_duplicate_pairs(df, "i", "t").collect()} == {(0, 1), (3, 4), (5, 6), (9, 10), (12, 13)}
    assert {r.id for r in near_duplicates.near_duplicate_groups(df, "i", "t", 0.8, 5, min_words=2).collect()} == {0, 1, 2, 11, 12, 13}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    got = {r.node: r.root for r in near_duplicates.components(edges).collect()}
    assert got == {i: 0 for i in range(71)} | {100: 100, 101: 100}


# ---- 4: pieces


def test_pieces(spark):
    rng = random.Random(6)
    long = " ".join("".join(rng.choice("abcdefé中") for _ in range(rng.randrange(1, 9))) + rng.choice(["", "", ".", ".\n\n", "。"]) for _ in range(9000))
    texts = {1: long, 2: "x" * 20_000, 3: "", 4: "short. text", 5: "字。" * 7000, 6: "y" * 6000}
    df = spark.createDataFrame([*texts.items(), (7, None), (1, long)], "i bigint, t string")
    out = collections.defaultdict(list)
    for r in pieces.split_long(df, "i", "t").collect():
        out[r.id].append(r)
    assert set(out) == set(texts)
    for i, ps in out.items():
        ps.sort(key=lambda r: r.piece)
        end = 0
        for k, p in enumerate(ps):
            assert (p.piece, p.n_pieces) == (k, len(ps)) and len(p.text) <= 6000
            assert texts[i][p.begin : p.begin + len(p.text)] == p.text and 0 <= end - p.begin <= 200
            end = p.begin + len(p.text)
        assert end == len(texts[i])
    assert all(p.text[-1] in ".。 \n" for p in out[1][:-1]) and all(p.text[-1] == "。" for p in out[5][:-1])
    with pytest.raises(ValueError):
        pieces.split_long(df, "i", "t", maximum=100, minimum=100, overlap=50)


def test_an_edit_alters_only_near_pieces():
    rng = random.Random(7)
    text = " ".join("w%d" % rng.randrange(10**5) + ("." if rng.random() < 0.1 else "") for _ in range(20_000))
    cut = lambda t: [t[a:b] for a, b in pieces.cuts(t, 6000, 3000, 200)]
    before, after = cut(text), cut(text[:30_000] + " inserted words here" + text[30_000:])
    assert len(set(before) - set(after)) <= 6 < len(before)


# ---- 5: term counts


def test_term_counts_split_oversized_parts(spark):
    rng = random.Random(8)
    rows = [(rng.choice(["en", None]), rng.choice(["hot", f"t{rng.randrange(900)}", None, ""]), rng.randrange(5), 1) for _ in range(6000)] + [("de", "nul", None, None)]
    df = spark.createDataFrame(rows, "k string, term string, a bigint, i bigint").repartition(5)
    want = collections.defaultdict(lambda: [0, 0])
    for k, t, a, i in rows:
        if t is not None:
            want[k, t][0] += a or 0
            want[k, t][1] += i or 0
    for limit, bits in ((2000, 0), (2000, 3), (10**6, None)):
        out = term_counts.term_counts(df, "k", "term", "a", "i", limit, bits)
        assert {(r.k, r.term): [r.n, r.records] for r in out.collect()} == want
    assert term_counts.term_counts(df.limit(0), "k", "term", "a", "i").count() == 0


def test_oversized_parts_are_split_again_on_disk(tmp_path):
    """A part of many terms is split by bits, and its own parts again; one of a single hot term is combined and never split."""
    rows = lambda terms: term_counts._combined([pa.record_batch([["x"] * len(terms), terms, [1] * len(terms), [1] * len(terms)], names=["k", "term", "n", "records"])]).to_batches()
    part = term_counts.Part(*term_counts.file_system(f"file:{tmp_path}/a"), 0, 4000)
    for i in range(0, 20_000, 100):
        for b in rows([f"term {j}" for j in range(i, i + 100)]):
            part.add(b)
    seen = collections.Counter()
    for leaf in part.leaves():
        assert sum(b.nbytes for b in leaf) <= 4000
        seen.update(t for b in leaf for t in set(b.column("term").to_pylist()))
    assert len(seen) == 20_000 and set(seen.values()) == {1}  # no term in two parts
    assert part.splits > 17  # the first split makes 16 parts, all of them too large
    assert not [p for p in (tmp_path / "a").rglob("*") if p.is_file()]
    hot = term_counts.Part(*term_counts.file_system(f"{tmp_path}/b"), 0, 4000)
    for _ in range(5000):
        for b in rows(["hot"]):
            hot.add(b)
    assert hot.splits == 0 and not (tmp_path / "b").exists()
    assert pa.Table.from_batches(next(hot.leaves()))["n"].to_numpy().sum() == 5000


# ---- 6: abuse


def abuse_rows(n=900):
    rng = random.Random(9)
    vile = ["you are a complete grubnik", "shut up you grubnik", "we will hunt the zorvals down", "nobody would miss you if you were gone"]
    fine = ["the word grubnik is recorded as an insult", "a guild of hunters met the zorvals here", "she would miss the festival"]
    texts, truth = [], []
    for _ in range(n):
        own = [" ".join(f"{rng.choice('bdfgk')}{rng.choice('aeiou')}{rng.choice('lmnrt')}{rng.choice('aeiou')}" for _ in range(7)) for _ in range(rng.randrange(1, 9))]
        bad = rng.random() < 0.3
        if bad:
            own.append(rng.choice(vile))
        elif rng.random() < 0.5:
            own.append(rng.choice(fine))
        rng.shuffle(own)
        texts.append(". ".join(own) + ".")
        truth.append(bad)
    return texts, np.array(truth)


def test_abuse_on_held_out_texts_with_erring_raters():
    texts, truth = abuse_rows()
    rng = np.random.default_rng(1)
    n = 600
    votes = rng.integers(1, 4, n)
    positive = np.array([(np.where(rng.random(v) < 0.07, ~t, t)).sum() for v, t in zip(votes, truth[:n])])
    model = abuse.train(texts[:n], positive, votes)
    s = model.scores(texts[n:]) >= model.threshold
    assert (s & truth[n:]).sum() / s.sum() > 0.9 and (s & truth[n:]).sum() / truth[n:].sum() > 0.9
    assert model.scores(["", "...", "x" * 100_000]).shape == (3,)
    odd = model.scores(["shut up you grubnnik!", "the word grubnik is recorded"])
    assert odd[0] > odd[1]


def test_abuse_queries_survive_missing_labels(spark):
    texts = spark.createDataFrame([(1, "a b", "s"), (2, None, "s"), (None, "x", None), (3, "", None)], "i bigint, t string, source string")
    labels = spark.createDataFrame([], "i bigint, r string, l string")
    model = abuse.fit(texts, "i", "t", abuse.votes(labels, "i", "r", "l"))
    assert {r.id for r in abuse.scored(texts, "i", "t", model, ("source",)).collect()} == {1, 3}
    voted = abuse.votes(spark.createDataFrame([(1, "a", "Abusive "), (1, "a", "Abusive "), (1, "b", None), (1, "c", "0")], "i bigint, r string, l string"), "i", "r", "l").collect()
    assert [(r.positive, r.votes) for r in voted] == [(1, 2)]


# ---- 7: leaks


def test_leaks(spark):
    rng = random.Random(10)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(5, 60))) for i in range(40)] + [(98, None), (99, "")]
    items.append((97, items[3][1]))
    docs = []
    for i in range(200):
        t = text(rng.randrange(0, 90)).split()
        if i % 3 == 0:
            w = rng.choice(items[:40])[1].split()
            a = rng.randrange(max(1, len(w) - 5))
            part = w[a : a + rng.randrange(8, 30)]
            at = rng.randrange(len(t) + 1)
            t[at:at] = [x.upper() for x in part]
        docs.append((i, ", ".join(t)))
    docs += [(500, None), (None, items[0][1]), docs[0]]
    want = set()
    for i, d in docs:
        for j, x in items:
            if i is not None and d and x:
                a, b = words_of(d), words_of(x)
                if {*zip(*(a[k:] for k in range(12)))} & {*zip(*(b[k:] for k in range(12)))}:
                    want.add((i, j))
    df = spark.createDataFrame([(*r, 1) for r in docs], "i bigint, t string, pos int").repartition(4)
    it = spark.createDataFrame(items, "item bigint, x string")
    out = leaks.leaks(df, "i", "t", it, "item", "x").collect()
    assert {(r.id, r["item"]) for r in out if r.exact_run >= 12} == want and len(want) > 20
    assert leaks.leaks(df.limit(0), "i", "t", it, "item", "x").count() == 0
    assert leaks.leaks(df, "i", "t", it.limit(0), "item", "x").count() == 0


def test_short_items_are_found_whole(spark):
    items = [(1, "alone"), (2, "one two three four five"), (3, "a b c d e f g h i j k"), (4, "a b c d e f g h i j k l")]
    docs = [(10, "left ALONE, and one two three four five"), (11, "one two three four six"), (12, "x a b c d e f g h i j k y"), (13, "a b c d e f g h i j"), (14, "alone"), (15, "alone alone"), (16, "")]
    df = spark.createDataFrame(docs, "i bigint, t string").repartition(3)
    out = leaks.leaks(df, "i", "t", spark.createDataFrame(items, "item bigint, x string"), "item", "x").collect()
    assert {(r.id, r["item"], r.exact_run) for r in out} == {(10, 1, 1), (10, 2, 5), (12, 3, 11), (14, 1, 1), (15, 1, 1)}


def test_overlap_bridges_substitutions():
    x = np.arange(40, dtype=np.uint64)
    y = x.copy()
    at = lambda y: leaks.overlaps((x == y)[None, :])
    y[[10, 20]] = 999
    assert at(y) == (19, 38)
    y[11] = 999
    assert at(y) == (19, 27)
    assert at(x + np.uint64(100)) == (0, 0) and at(x) == (40, 40)
    rng = np.random.default_rng(3)
    for _ in range(200):  # several rows together are the best of each
        same = rng.random((3, 12)) < rng.choice([0.3, 0.7, 0.9])

        def around(row):
            best = 0
            for i in range(12):
                for j in range(i, 12):
                    miss = [k for k in range(i, j + 1) if not row[k]]
                    if all(b - a > leaks.GAP for a, b in zip(miss, miss[1:])):
                        best = max(best, j - i + 1 - len(miss))
            return best

        longest = lambda row: max(len(p) for p in "".join("x" if v else " " for v in row).split(" "))
        assert leaks.overlaps(same) == (max(map(longest, same)), max(map(around, same)))


def test_diagonals_of_repeated_words():
    rng = np.random.default_rng(4)
    for n, m, kinds in ((50, 20, 1), (400, 90, 2), (3000, 500, 1), (60, 60, 40)):
        seed, item_seed = rng.integers(0, kinds, n).astype(np.uint64), rng.integers(0, kinds, m).astype(np.uint64)
        want = sorted({i - j for k in range(kinds) for i in np.flatnonzero(seed == k).tolist() for j in np.flatnonzero(item_seed == k).tolist()})
        assert leaks.diagonals(np.arange(n), seed, np.arange(m), item_seed).tolist() == want


def test_time_grows_in_proportion_for_a_repeated_word():
    item = np.full(14, 7, np.uint64)

    def seconds(n):
        began = time.perf_counter()
        shifts = leaks.diagonals(np.arange(n), np.zeros(n, np.uint64), np.arange(3), np.zeros(3, np.uint64))
        assert leaks.compare(np.full(n, 7, np.uint64), item, shifts) == (14, 14)
        return time.perf_counter() - began

    seconds(1000)
    assert seconds(800_000) < 12 * min(seconds(100_000) for _ in range(3)) + 1


def test_substituted_passages_are_found(spark):
    """Passages with a word replaced every 6 to 9 words share no run of 12, but are found by the spaced seeds."""
    rng = random.Random(12)
    text = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    items = [(i, text(60)) for i in range(60)]
    docs = []
    for i, t in items:
        w = t.split()
        at = rng.randrange(3)
        while at < len(w):
            w[at] = "changed"
            at += rng.randrange(7, 11)
        docs.append((i, f"{text(30)} {' '.join(w)} {text(30)}"))
    out = leaks.leaks(spark.createDataFrame(docs, "i bigint, t string"), "i", "t", spark.createDataFrame(items, "item bigint, x string"), "item", "x").collect()
    assert all(r.exact_run < 12 for r in out)
    assert sum(r.id == r["item"] and r.overlap >= 45 for r in out) >= 0.95 * len(items)


def test_many_items_are_found_in_several_scans(spark):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(20)]
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in items], "i bigint, t string")
    out = leaks.leaks(docs, "i", "t", spark.createDataFrame(items, "item bigint, x string"), "item", "x", seeds_a_scan=300)
    assert {(r.id, r["item"], r.exact_run) for r in out.collect()} == {(i, i, 30) for i in range(20)}


def test_masks_are_no_longer_than_the_run():
    assert all(len(m) <= 12 and m[0] == m[-1] == "1" for m in leaks.MASKS)


# ---- 8: mixing


def test_mixing_reaches_shares(spark):
    rng = random.Random(11)
    rows = [(i, " ".join("word" for _ in range(rng.choice([3, 30, 30, 200]))) + f" {i}", rng.choice(["Big ", "big", "BIG", "small", "tiny"] if i % 9 == 0 else ["big"])) for i in range(3000)]
    rows += [(9000 + i, rows[i][1], "other") for i in range(40)] + [(9900, None, "big"), (9901, "", "big"), (9902, "x", None), (None, "y", "big")]
    df = spark.createDataFrame(rows, "i bigint, t string, s string").repartition(5)
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 4), ("tiny", 0.1, 2), ("absent", 0.1, 3)], "source string, target_share double, max_repeat bigint")
    texts = mixing.sized(df, "i", "t", "s").cache()
    entries = mixing.plan(texts, targets)
    out = mixing.mix(texts, entries).collect()
    most = {"big": 1, "small": 4, "tiny": 2}
    assert out and all(1 <= r.copies <= most[r.source] for r in out) and len({r.id for r in out}) == len(out)
    report = {r.source: r for r in mixing.shares(mixing.mix(texts, entries), entries).collect()}
    assert report["absent"].actual_share == 0
    for s, share in (("big", 0.5), ("small", 0.3), ("tiny", 0.1)):
        assert abs(report[s].actual_share - share / 0.9) < 0.01
    # the sum along the order is what one task would give
    order = sorted((r.tokens, r.h1, r.id) for r in texts.where("source = 'big'").collect())
    rate = next(e["copies"] for e in entries if e["source"] == "big")
    expect = sum(o[0] for o in order) * rate
    assert abs(sum(r.tokens * r.copies for r in out if r.source == "big") - expect) <= 2 * order[-1][0]
    assert mixing.mix(texts.limit(0), mixing.plan(texts.limit(0), targets)).count() == 0


def test_each_text_is_used_as_often_as_expected(spark):
    """Over many seeds, every text's copies come to its expected number, whatever its size; floor or ceiling each time."""
    rng = random.Random(13)
    texts = spark.createDataFrame([(i, "a", rng.getrandbits(60), rng.choice([1, 1, 5, 40, 900])) for i in range(60)], "id bigint, source string, h1 bigint, tokens bigint").cache()
    entries = [{"source": "a", "target_share": 1.0, "max_repeat": 2, "texts": 60, "tokens": 1, "copies": 1.3}]
    used, seeds = collections.Counter(), 60
    runs = [mixing.mix(texts, entries, seed).select("id", "copies") for seed in range(seeds)]
    for r in functools.reduce(lambda a, b: a.union(b), runs).collect():
        assert r.copies in (1, 2)
        used[r.id] += r.copies
    assert all(abs(used[i] / seeds - 1.3) < 0.25 for i in range(60)) and abs(sum(used.values()) / seeds / 60 - 1.3) < 0.01


def test_no_text_is_used_under_two_ids(spark):
    df = spark.createDataFrame([(i, "same text", "a") for i in range(50)] + [(99, "other text", "a")], "i bigint, t string, s string")
    assert {r.id for r in mixing.sized(df, "i", "t", "s").collect()} == {0, 99}


def test_a_text_is_kept_for_its_targeted_source(spark, tmp_path):
    rows = [(1, "same text", None), (2, "same text", " A"), (3, "more text", "other"), (4, "more text", "a"), (5, "own text", "other")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert {(r.id, r.source) for r in mixing.sized(df, "doc_id", "text", "source").collect()} == {(2, "a"), (3, "other"), (5, "other")}
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeat bigint").write.parquet(str(tmp_path / "mix_targets.parquet"))
    assert {r.doc_id for r in queries.p8_mix(spark, str(tmp_path)).collect()} == {2, 4}


def test_tokenizer_splits_and_joins():
    e = mixing.tokenizer(mixing.vocabulary())
    assert e.decode(e.encode_ordinary("Żółw <|endoftext|> 中文")) == "Żółw <|endoftext|> 中文"


# ---- 9: encodings

PLAIN = ["Café naïve – “curly” it’s", "La niña comió ¿qué? más", "Gęś źródło łódź jest wśród „Łąk”", "Größe über Straße für Ärger", "« L’été » où ? Ça coûte 8 € £9 30 °C"]


@pytest.mark.parametrize("read_as", ["cp1252", "latin-1", "cp1250", "cp437", "mac-roman", "iso8859-2"])
def test_round_trips(read_as):
    for t in PLAIN:
        bad = "".join(bytes([b]).decode(read_as, "ignore") or chr(b) for b in t.encode())
        fixed, ways, n = encodings.repair(f"plain words, {bad}, more")
        assert fixed == f"plain words, {t}, more", (read_as, bad)
        assert n


def garble(t, layers):
    for _ in range(layers):
        t = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in t.encode())
    return t


def test_nested_layers():
    for t in PLAIN:
        assert encodings.repair(garble(t, 2))[0] == t
    assert encodings.repair(garble("Größe naïve café", 6))[0] == "Größe naïve café"


def test_other_encodings_meant():
    assert encodings.repair("你好。" + "我们在北京的博物馆里看见了河流".encode("gbk").decode("latin-1"))[0] == "你好。我们在北京的博物馆里看见了河流"
    assert encodings.repair("Москва река".encode("cp1251").decode("latin-1"))[0] == "Москва река"


def test_single_characters():
    assert encodings.repair("caf茅 and th茅 in the garden")[0] == "café and thé in the garden"
    assert encodings.repair("pe³ny g³os m¹dry cz³owiek")[0] == "pełny głos mądry człowiek"
    for text in ("卡拉ok 很好", "the word a美国b", "x³y", "flow of 5 m³ per h, 3 m³", "5±3 and a±b", "T恤 is a shirt"):
        assert encodings.repair(text) == (text, [], 0), text


def test_a_run_beside_a_correct_character():
    assert encodings.repair("a school „Ã©cole” of old")[0] == "a school „école” of old"


def test_recall_of_garbled_places():
    """Words with one letter garbled, in texts of plain words: all are found and restored; the same texts as they should be are left alone."""
    rng = random.Random(14)
    letters = "éèàüößñółęąśźżćç"
    found = 0
    for _ in range(200):
        words = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randrange(3, 9))) for _ in range(30)]
        at = rng.randrange(30)
        words[at] = words[at][:2] + rng.choice(letters) + words[at][2:]
        good = " ".join(words)
        bad = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in good.encode())
        assert encodings.repair(good) == (good, [], 0)
        found += encodings.repair(bad)[0] == good
    assert found >= 190


@pytest.mark.parametrize("text", [*PLAIN, "VERÃO CORAÇÃO MANHÃS PÂRÂURI. DOUĂ” VÂLCĂU", "L’île « Âtre-Noir » coûte, ÂGÉ", "┌──────┬──────┐\n│ a │\n└──────┴──────┘", "Река «СССР» № 5", "中文文本，没有问题。", "x ± 2°, § 7 ¶ 2 ©", "ÀÉÎÕÜ", "“ÉTÉ”", "——……——", ""])
def test_correct_texts_stay(text):
    assert encodings.repair(text) == (text, [], 0)


def test_garbled_rows(spark):
    bad = "CafÃ© Ã©tÃ©"
    df = spark.createDataFrame([(1, bad), (2, "ascii"), (3, "lost �"), (4, None), (None, bad), (5, ""), (6, "Ã© " * 30_000)], "i bigint, t string")
    out = {r.id: r for r in encodings.garbled(df, "i", "t").collect()}
    assert set(out) == {1, 3, 6} and out[1].text == "Café été" and out[3].lost == 1 and out[6].text == "é " * 30_000
