"""N-gram join, embeddings, components and passages against brute force."""

import itertools
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surgecast.llm import common
from surgecast.llm import compact_windows as cw
from surgecast.llm import ngram_join as nj
from surgecast.llm import pq_dedup as pq
from surgecast.llm.common import table
from surgecast.llm.components import components
from tests.llm.rows import ODD_DOCUMENTS, Union, documents

WORDS = [f"w{i}" for i in range(400)]


# --- components -------------------------------------------------------------------------------


@pytest.mark.parametrize("rows", [0, 1 << 20])
def test_components_of_chains_stars_and_loops(spark, monkeypatch, rows):
    monkeypatch.setattr(common, "ROWS_A_TASK", rows)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(260)]
    rng.shuffle(links)
    links = [p if rng.random() < 0.5 else p[::-1] for p in links] * 2
    want = Union()
    for a, b in links:
        if a != b:
            want.link(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: want.top(n) for n in list(want.up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- prefix trees and the n-gram join ------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=12), min_size=1, max_size=25), st.sets(st.integers(0, 14), min_size=1))
def test_tree_search_by_brute_force(sets, query):
    tree = nj.Trie()
    for i, s in enumerate(sets):
        tree.add(np.array(sorted(s), np.uint64), i)
    got = sorted(tree.search(np.array(sorted(query), np.uint64)))
    assert got == [i for i, s in enumerate(sets) if 5 * len(s & query) >= 4 * len(s | query)]


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_join(rows):
    """{id: (set size, component)}"""
    sets = {k: shingles(t) for k, t in rows}
    by_set = defaultdict(list)
    for k, s in sets.items():
        if s:
            by_set[s].append(k)
    union, inverted = Union(), defaultdict(list)
    for s, ids in by_set.items():
        seen = Counter(o for g in s for o in inverted[g])
        for o, n in seen.items():
            if 100 * n >= 80 * (len(s) + len(o) - n):
                union.link(ids[0], by_set[o][0])
        for i in ids:
            union.link(ids[0], i)
        for g in s:
            inverted[g].append(s)
    return {k: (len(s), union.top(k)) for k, s in sets.items()}


def near_copies(seed, families=6, each=12):
    """Texts of some families: an original and copies with a few words changed, up to and beyond the threshold."""
    rng, rows = random.Random(seed), []
    line = " ".join(rng.choice(WORDS) for _ in range(25))
    for _ in range(families):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(30, 150))]
        for _ in range(each):
            own = list(words)
            for _ in range(rng.randrange(6)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append(" ".join(own) + ("\n" + line if rng.random() < 0.3 else ""))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("crowded", [False, True])
def test_join_by_brute_force(spark, monkeypatch, seed, crowded):
    if crowded:  # every n-gram counts as frequent, trees hold two sets, ids are shuffled
        monkeypatch.setattr(nj, "ROWS_A_GROUP", 1)
        monkeypatch.setattr(nj, "SETS_A_TREE", 2)
        monkeypatch.setattr(nj, "BROADCAST_IDS", 0)
        monkeypatch.setattr(nj, "ROWS_A_BLOCK", 3)
        monkeypatch.setattr(nj, "LIKELIEST", 1)
        monkeypatch.setattr(common, "ROWS_A_TASK", 0)
    rows = near_copies(seed)
    got = nj.join_ngrams(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert {r.doc_id: (r.n_ngrams, r.component) for r in got} == brute_join(rows)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=600), st.sets(st.integers(0, 2**64 - 1), max_size=60), st.sets(st.integers(0, 2**64 - 1), max_size=600))
def test_sketches_never_rule_out_a_link(common_part, left, right):
    a, b = (np.array(sorted(common_part | x) or [1], np.uint64) for x in (left, right))
    far = nj.distances([nj.sketch(a), nj.sketch(b)], np.array([0]), np.array([1]))[0]
    both = len(np.intersect1d(a, b))
    assert far <= len(a) + len(b) - 2 * both
    if nj.reaches(both, len(a), len(b)):
        assert far <= nj.most_apart(len(a), len(b))


@pytest.mark.parametrize("blocks", [1, 3])
def test_chosen_pairs_by_brute_force(blocks):
    """All pairs that no bound rules out are chosen in the end; of those compared before none."""
    rng = np.random.default_rng(blocks)
    sets = [np.unique(rng.integers(0, 2**63, 40, dtype=np.uint64))]
    for _ in range(29):
        own = sets[int(rng.integers(len(sets)))].copy()
        own[rng.integers(0, len(own), 3)] = rng.integers(0, 2**63, 3, dtype=np.uint64)
        sets.append(np.unique(own))
    rows = []
    for g in range(3):
        for i, s in enumerate(sets):
            if i % 3 != g:
                rows += [(g, min(i % blocks, o), max(i % blocks, o), i % blocks, i, i % 5, len(s), g, nj.sketch(s), [i + 5] if i == 0 else None) for o in range(blocks)]
    rows.sort(key=lambda r: r[:3])
    names = ["gram", "lo", "hi", "own", "name", "root", "n", "at", "sketch", "failed"]
    table = nj.pa.table({c: nj.pa.array(v, nj.pa.list_(nj.pa.int64())) if c == "failed" else nj.pa.array(v) for c, v in zip(names, zip(*rows, strict=True), strict=True)})
    want = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            together = any(i % 3 != g and j % 3 != g for g in range(3))
            near = nj.distances([nj.sketch(a), nj.sketch(b)], np.array([0]), np.array([1]))[0] <= nj.most_apart(len(a), len(b))
            if i % 5 != j % 5 and together and near:
                want.add((j, i))
    want.discard((0, 5))
    a, b, more = nj.likeliest(table, 100)
    got = list(zip(a.tolist(), b.tolist(), strict=True))
    assert set(got) == want and len(got) == len(want) and not len(more)
    a, b, more = nj.likeliest(table, 1)
    one = set(zip(a.tolist(), b.tolist(), strict=True))
    left = {(i, j) for i, j in want - one for g in more.tolist() if i % 3 != g and j % 3 != g}
    assert left == want - one
    assert one <= want and {i for p in one for i in p} == {i for p in want for i in p}


def test_join_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = nj.join_ngrams(docs, "doc_id", "text").collect()
    assert {r.doc_id: (r.n_ngrams, r.component) for r in got} == brute_join([(r.doc_id, r.text) for r in docs.collect()])


def test_join_of_odd_rows(spark):
    rows = nj.join_ngrams(documents(spark), "doc_id", "text").collect()
    assert len(rows) == len(ODD_DOCUMENTS)
    got = Counter((r.doc_id, r.n_ngrams, r.component) for r in rows)
    assert got[(1, 3, 1)] == got[(7, 3, 1)] == got[(None, 3, 1)] == 1
    assert got[(2, 0, 2)] == got[(3, 0, 3)] == got[(4, 0, 4)] == got[(None, 0, None)] == 1
    assert got[(6, 1, 6)] == 2 and got[(5, 2, 5)] == 1
    assert nj.join_ngrams(documents(spark, []), "doc_id", "text").count() == 0


# --- embeddings ---------------------------------------------------------------------------------


def brute_vectors(rows, least):
    """{id: (links, component)} of (id, vector, label) with distinct ids."""
    ok = [(i, np.array(v, float), c) for i, v, c in rows if c is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    union, links = Union(), Counter()
    for x, (i, v, c) in enumerate(ok):
        for j, w, d in ok[x + 1 :]:
            if c == d and len(v) == len(w) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                union.link(i, j)
                links.update((i, j))
    return {i: (links[i], union.top(i)) for i, *_ in rows}


@pytest.mark.parametrize("crowded", [False, True])
def test_vectors_by_brute_force(spark, monkeypatch, crowded):
    if crowded:
        monkeypatch.setattr(pq, "MEMBERS", 8)
        monkeypatch.setattr(pq, "QUERIES", 16)
        monkeypatch.setattr(pq, "SAMPLE", 200)
    rng = np.random.default_rng(4)
    rows = []
    for f in range(40):
        base = rng.normal(size=32)
        for _ in range(10):
            rows.append((len(rows), (base + rng.normal(size=32) * rng.choice([0.02, 0.2, 0.33])).tolist(), f % 3))
    rows += [(len(rows) + i, rows[0][1], 0) for i in range(30)]
    want = brute_vectors(rows, 0.93)
    got = {r.id: (r.n_links, r.component_id) for r in pq.dedup_embeddings(spark.createDataFrame(rows, "id long, v array<double>, c int"), "id", "v", "c", 0.93).collect()}
    assert got.keys() == want.keys()
    found, there = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert found >= 0.95 * there  # recall of links


def test_pairs_across_lists_count_for_both(spark):
    """Pairs on a circle, which the lists cut along the pairs' own direction."""
    rows = []
    for pair in range(300):
        for at in (0.021 * pair, 0.021 * pair + 0.36):
            rows.append((len(rows), [float(np.cos(at)), float(np.sin(at))] + [0.0] * 62, pair))
    got = pq.dedup_embeddings(spark.createDataFrame(rows, "id long, v array<double>, c int"), "id", "v", "c", 0.93).collect()
    assert {r.id: (r.n_links, r.component_id) for r in got} == brute_vectors(rows, 0.93)


def test_recall_on_the_table(spark):
    e = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r.vec_id, r.label, r.embedding) for r in e.collect()]
    got = {r.vec_id: r.n_links for r in pq.dedup_embeddings(e, "vec_id", "embedding", "label", 0.93).collect()}
    there = 0
    for label in {r[1] for r in rows}:
        ids = [r[0] for r in rows if r[1] == label]
        v = np.array([r[2] for r in rows if r[1] == label], float)
        v /= np.linalg.norm(v, axis=1)[:, None]
        near = v @ v.T >= 0.93
        np.fill_diagonal(near, False)
        for i, n in zip(ids, near.sum(axis=1), strict=True):
            assert got[i] <= n
            there += int(n)
    assert sum(got.values()) >= 0.99 * there


ODD_VECTORS = [
    (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None), (6, None, 1), (7, [], 1),
    (8, [0.0, 0.0], 1), (9, [1.0, None], 1), (10, [float("nan"), 1.0], 1), (11, [float("inf"), 1.0], 1), (12, [1.0, 0.0, 0.0], 1),
    (13, [1e-30, 0.0], 1), (14, [-1.0, 0.0], 1),
]


def test_odd_vectors(spark):
    frame = spark.createDataFrame(ODD_VECTORS, "vec_id long, embedding array<float>, label int").withColumns({"id": F.lit("x"), "copies": F.lit(3), "name": F.lit(1)})
    rows = pq.dedup_embeddings(frame, "vec_id", "embedding", "label", 0.93).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows}
    assert got == brute_vectors(ODD_VECTORS, 0.93)
    assert {r.vec_id for r in rows if r.kept} == {i for i, (_, c) in got.items() if i == c}
    assert pq.dedup_embeddings(frame.limit(0), "vec_id", "embedding", "label", 0.93).count() == 0
    again = frame.union(frame.filter("vec_id = 1")).union(frame.filter("vec_id = 1").withColumn("vec_id", F.lit(None).cast("long")))
    rows = pq.dedup_embeddings(again, "vec_id", "embedding", "label", 0.93).collect()
    assert Counter(r.vec_id for r in rows)[1] == 2 and all(r.n_links == 5 and r.component_id == 1 for r in rows if r.vec_id in (1, 2, 3, 13, None))
    assert [r.kept for r in rows if r.vec_id is None] == [False]


def test_vectors_under_one_key_have_links_of_their_own(spark):
    def run(rows):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = pq.dedup_embeddings(df, "vec_id", "embedding", "label", 0.93).collect()
        return Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in got)

    # the second vector of key 1 links with nothing
    assert run([(1, [1.0, 0.0, 0.0], 1), (1, [0.0, 1.0, 0.0], 1), (2, [1.0, 0.001, 0.0], 1), (3, [1.0, 0.002, 0.0], 1)]) == Counter(
        [(1, 2, 1, True), (1, 0, 1, True), (2, 2, 1, False), (3, 2, 1, False)]
    )
    # near vectors under the same key link
    assert run([(5, [1.0, 0.0, 0.0], 1), (5, [1.0, 0.001, 0.0], 1)]) == Counter({(5, 1, 5, True): 2})
    # one that joins two groups under different keys
    assert run([(9, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (9, [0.0, 1.0], 1), (3, [1.0, 0.01], 1)]) == Counter(
        [(9, 1, 3, False), (3, 1, 3, True), (4, 1, 4, True), (9, 1, 4, False)]
    )


# --- passages -----------------------------------------------------------------------------------


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(1, 6))
def test_windows_group_all_runs(values, shortest):
    """Every long enough run lies in a window of its own smallest value."""
    h = np.array(values, np.uint64)
    nodes = cw.windows(h, shortest)
    for i in range(len(h)):
        for j in range(i + shortest - 1, len(h)):
            low = h[i : j + 1].min()
            assert any(l <= i and j <= r and h[c] == low and i <= z and j >= c for l, c, z, r in nodes)


def brute_passage(a, b):
    """Most n-grams of the first text in two long enough ranges that reach the threshold and that common n-grams
    begin and end; 0 for none. No n-gram repeats in a text."""
    same = np.pad(np.cumsum(np.cumsum(a[:, None] == b, axis=0), axis=1), ((1, 0), (1, 0)))
    (s, e), (x, y) = (
        np.array([(i, j) for i in np.flatnonzero(c) for j in np.flatnonzero(c) + 1 if j - i >= cw.SHORTEST] or [(0, 0)]).T
        for c in (np.isin(a, b), np.isin(b, a))
    )
    both = same[np.ix_(e, y)] - same[np.ix_(s, y)] - same[np.ix_(e, x)] + same[np.ix_(s, x)]
    good = (9 * both >= 4 * ((e - s)[:, None] + (y - x))) & (both > 0)
    return int(((e - s) * good.any(axis=1)).max())


def inserted(rng, words, places, each):
    """The words with new ones inserted at some places."""
    for at in sorted(places, reverse=True):
        words = [*words[:at], *(f"new{rng.randrange(10**9)}" for _ in range(each)), *words[at:]]
    return words


@pytest.mark.parametrize(("length", "places", "each"), [(58, [29], 3), (88, [44], 7), (120, [30, 70], 5), (70, [20, 50], 1), (52, [26], 2), (60, [30], 14)])
@pytest.mark.parametrize("around", [0, 12])
@pytest.mark.parametrize("twice", [False, True])
def test_insertions_and_deletions_by_brute_force(length, places, each, around, twice):
    """Runs near the threshold with foreign words on one side only, alone or beside each other."""
    rng = random.Random(length)
    a, b, where = [], [], []
    for _ in range(1 + twice):
        base = [f"v{rng.randrange(10**9)}" for _ in range(length)]
        longer = inserted(rng, base, places, each)
        (_, x), (_, y) = cw.sequence_hashes(" ".join(base)), cw.sequence_hashes(" ".join(longer))
        where.append((len(a) + around, len(a) + around + length, brute_passage(x, y)))
        for text, own in ((a, base), (b, longer)):
            text += [f"x{rng.randrange(10**9)}" for _ in range(around)] + own + [f"x{rng.randrange(10**9)}" for _ in range(around)]
    (_, h), (_, g) = cw.sequence_hashes(" ".join(a)), cw.sequence_hashes(" ".join(b))
    for one, other, side in ((h, g, 0), (g, h, 2)):
        got = cw.passages(one, other, (0, len(one) - 1, 0, len(other) - 1))
        assert bool(got) == (any(longest for *_, longest in where) or brute_passage(one, other) > 0)
        for s, e, x, y in got:
            one_set, other_set = set(one[s : e - 4].tolist()), set(other[x : y - 4].tolist())
            assert 5 * len(one_set & other_set) >= 4 * len(one_set | other_set)
        for s, e, longest in where:
            inside = sum(max(0, min(e, p[side + 1]) - max(s, p[side])) for p in got)
            assert inside >= 0.9 * longest


def planted(seed, passage=60, changed=0):
    rng, rows = random.Random(seed), []
    shared = [[rng.choice(WORDS) for _ in range(passage)] for _ in range(4)]
    line = [rng.choice(WORDS) for _ in range(20)]
    where = {}
    for i in range(60):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(20, 200))]
        if i % 3 == 0:
            own = list(shared[i % 4])
            for _ in range(changed if i >= 12 and i % 24 < 12 else 0):  # near the unchanged ones, not each other
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            at = rng.randrange(len(words))
            where[i] = (at, at + passage, i % 4)
            words[at:at] = own
        if i % 2 == 0:
            words += line
        rows.append((i, " ".join(words)))
    return rows, where


@pytest.mark.parametrize("crowded", [False, True])
@pytest.mark.parametrize("changed", [0, 1])
def test_planted_passages(spark, monkeypatch, crowded, changed):
    if crowded:
        monkeypatch.setattr(cw, "ROWS_A_GROUP", 1)
        monkeypatch.setattr(cw, "TEXTS_A_GROUP", 2)
        monkeypatch.setattr(cw, "BROADCAST_IDS", 0)
        monkeypatch.setattr(common, "ROWS_A_TASK", 0)
    rows, where = planted(6, changed=changed)
    got = {r.doc_id: r for r in cw.find_passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert {i for i, r in got.items() if r.n_passages} == set(where)
    for i, (s, e, _) in where.items():
        spans = [tuple(map(int, x.split(":"))) for x in got[i].spans.split(",")]
        inside = sum(max(0, min(e, b) - max(s, a)) for a, b in spans)
        assert inside >= 0.8 * (e - s) and sum(b - a for a, b in spans) <= 1.3 * (e - s)
    groups = defaultdict(list)
    for i, (*_, p) in where.items():
        groups[p].append(i)
    for ids in groups.values():
        assert {got[i].component for i in ids} == {min(ids)}


def agree(x, y):
    """Whether windows of two texts, under enough functions, share a minimum and a range, so that they are compared."""
    rows = []
    for f, seed in enumerate(cw._SEEDS):
        nodes = [{int(h[c]): (l, r) for l, c, _, r in cw.windows(cw.mixed_hash(h ^ seed))} for h in (x, y)]
        rows += [(f, *nodes[0][m], *nodes[1][m]) for m in nodes[0].keys() & nodes[1].keys()]
    return bool(rows) and bool(cw.regions(*np.array(rows).T))


def test_chains_of_near_copies_with_one_hub(spark, monkeypatch):
    """Links that only the last round can find, between texts that are explained and of different roots."""
    monkeypatch.setattr(cw, "STAR_ROUNDS", 1)
    monkeypatch.setattr(cw, "HUBS", 1)
    rng, rows, want = random.Random(8), [], Union()
    for chain in range(12):
        words = [f"v{rng.randrange(10**9)}" for _ in range(56)]
        for step, at in enumerate([None, *range(10, 46, 5)]):  # one word further: near the neighbours, no others
            if step:
                words[at] = f"v{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(words)))
    grams = [cw.sequence_hashes(t)[1] for _, t in rows]
    assert [[brute_passage(x, y) > 0 for y in grams[:9]] for x in grams[:9]] == [[abs(i - j) <= 1 for j in range(9)] for i in range(9)]
    links = [(i, i + 1) for i in range(len(rows) - 1) if i % 9 < 8 and agree(grams[i], grams[i + 1])]
    assert len(links) >= 0.95 * 12 * 8
    for a, b in links:
        want.link(a, b)
    found = cw.find_passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    assert {r.doc_id: r.component for r in found.collect()} == {i: want.top(i) for i, _ in rows}


@pytest.mark.parametrize("at_once", [3, 1 << 20])
def test_meetings_by_brute_force(monkeypatch, at_once):
    """Every two windows of a text under different functions with minima in one shortest run meet, under one name each."""
    monkeypatch.setattr(cw, "PAIRS_AT_ONCE", at_once)
    rng, rows = random.Random(3), []
    for text in range(4):
        for _ in range(60):
            l = rng.randrange(200)
            r = l + rng.randrange(cw.SHORTEST - 1, 3 * cw.SHORTEST)
            rows.append((text, rng.randrange(20), rng.randrange(cw.HASHES), l, rng.randrange(l, r + 1), r, rng.randrange(2)))
    want = defaultdict(set)
    for text, m, f, l, c, r, done in rows:
        for other, n, g, x, d, y, also in rows:
            first, last = max(l, c - cw.SHORTEST + 1, x, d - cw.SHORTEST + 1), min(c, r - cw.SHORTEST + 1, d, y - cw.SHORTEST + 1)
            if text == other and f < g and first <= last:
                want[(f, m), (g, n)].add((text, 1 << f | 1 << g, done & also))
    got = defaultdict(set)
    for text, name, functions, done in zip(*(x.tolist() for x in cw.meetings(*np.array(rows, np.int64).T)), strict=True):
        assert (text, functions, done) not in got[name]
        got[name].add((text, functions, done))
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=130).filter(any))
def test_dense_runs_by_brute_force(held):
    """Every place in a long enough range, perhaps beyond the ends, of which three quarters are held, and no other."""
    padded = np.concatenate([np.zeros(cw.SHORTEST, bool), held[: np.flatnonzero(held)[-1] + 1], np.zeros(cw.SHORTEST, bool)])
    upto, want = np.concatenate([[0], np.cumsum(padded)]), np.zeros(len(padded), bool)
    for i in range(len(padded)):
        for j in range(i + cw.SHORTEST, len(padded) + 1):
            want[i:j] |= 4 * (upto[j] - upto[i]) >= 3 * (j - i)
    got = np.zeros(len(padded), bool)
    for s, e in cw.dense_runs(np.flatnonzero(held)):
        got[s + cw.SHORTEST : e + cw.SHORTEST] = True
    assert (got[cw.SHORTEST :] == want[cw.SHORTEST :]).all()


def last_pairs(spark, monkeypatch, rows):
    """The pairs that the last round ties, and the result."""
    tied, untried = [], cw._untried
    monkeypatch.setattr(cw, "_untried", lambda agreed, tried: tied.append(agreed) or untried(agreed, tried))
    got = {r.doc_id: r for r in cw.find_passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    return [r for r in tied[-1].collect() if r.functions.bit_count() >= cw.ENOUGH], got


def test_a_line_ties_no_texts_in_the_last_round(spark, monkeypatch):
    """Texts that share a line too short for a passage are not all paired, however many there are."""
    rng = random.Random(4)
    line = " ".join(f"v{rng.randrange(10**9)}" for _ in range(30))
    rows = [(i, " ".join(f"x{rng.randrange(10**9)}" for _ in range(60)) + f" {line}") for i in range(60)]
    pairs, got = last_pairs(spark, monkeypatch, rows)
    assert not pairs
    assert all(r.n_passages == 0 and r.component == i for i, r in got.items())


def test_large_component_is_not_paired_in_the_last_round(spark, monkeypatch):
    """Texts of one component that hold more than what links them are compared with some of them, and found all the same."""
    monkeypatch.setattr(cw, "HUBS", 1)
    monkeypatch.setattr(cw, "ALL_PAIRS", 4)
    monkeypatch.setattr(cw, "STAR_ROUNDS", 1)
    rng = random.Random(5)
    passage = " ".join(f"v{rng.randrange(10**9)}" for _ in range(60))
    copies = [(i, f"{passage} " + " ".join(f"x{rng.randrange(10**9)}" for _ in range(20))) for i in range(40)]
    pairs, got = last_pairs(spark, monkeypatch, copies)
    assert len(pairs) <= 4 * len(copies)
    assert {r.component for r in got.values()} == {0}
    assert all(r.spans.startswith("0:6") for r in got.values())


def edited_alike(seed, pairs):
    """Near copies whose two edits are in the same places as those of one other text only: near this one as a whole, in parts the others."""
    rng, rows = random.Random(seed), []
    base = [f"v{rng.randrange(10**9)}" for _ in range(100)]
    places = rng.sample([(p, q) for p in range(33, 49) for q in range(p + 8, 67)], pairs)
    for _ in range(2):
        for p, q in places:
            words = list(base)
            words[p], words[q] = (f"x{rng.randrange(10**9)}" for _ in range(2))
            rows.append((len(rows), " ".join(words)))
    return rows, [cw.sequence_hashes(t)[1] for _, t in rows]


def pair_passages(x, y, order=None):
    """Passages of two texts by the windows that they share, in some order."""
    rows = []
    for f, seed in enumerate(cw._SEEDS):
        nodes = [{int(h[c]): (l, r) for l, c, _, r in cw.windows(cw.mixed_hash(h ^ seed))} for h in (x, y)]
        rows += [(f, *nodes[0][m], *nodes[1][m]) for m in nodes[0].keys() & nodes[1].keys()]
    if order:
        order.shuffle(rows)
    return [p for region in (cw.regions(*np.array(rows).T) if rows else []) for p in cw.passages(x, y, region)]


def test_every_pair_of_a_large_component(spark):
    """A text whose like is one of many is found with it, however many of its component meet in the same places."""
    rows, grams = edited_alike(9, 80)
    order = random.Random(1)
    alike = [(i, i + 80) for i in range(80) if all(pair_passages(grams[i], grams[i + 80], order) == [(0, 100, 0, 100)] for _ in range(20))]
    assert len(alike) >= 60
    got = {r.doc_id: r for r in cw.find_passages(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()}
    assert {got[i].component for pair in alike for i in pair} == {0}
    assert [i for pair in alike for i in pair if got[i].spans != "0:100"] == []


def places_of(spans):
    return {p for s, e in spans for p in range(s, e)}


@pytest.mark.parametrize("halves", [False, True])
@pytest.mark.parametrize("explained", [False, True])
def test_compared_with_all_by_brute_force(halves, explained):
    """What is passed over adds nothing to what all pairs give, but for a word where the direction decides."""
    grams = edited_alike(3, 12)[1] + [cw.sequence_hashes(t)[1] for _, t in planted(2, changed=3)[0]]
    grams = [h for h in grams if len(h) >= cw.SHORTEST]
    before = [[(0, 60)] if explained and i % 2 else [] for i in range(len(grams))]
    sides = np.arange(len(grams)) // 3 % 2 if halves else None
    got, want = ([places_of(x) for x in before] for _ in range(2))
    for x, y, s, e in cw.compared_with_all(grams, before, sides):
        assert sides is None or sides[x] != sides[y]
        got[x].update(range(s, e))
    for x, y in itertools.combinations(range(len(grams)), 2):
        if sides is None or sides[x] != sides[y]:
            for s, e, u, v in pair_passages(grams[x], grams[y]):
                want[x].update(range(s, e))
                want[y].update(range(u, v))
    assert sum(map(len, want)) > 1500 and [i for i, (x, y) in enumerate(zip(want, got, strict=True)) if len(x - y) > 1] == []


def test_pairs_are_tried_once(spark):
    agreed = spark.createDataFrame([(1, 2, 0b1111), (2, 1, 0b11110), (3, 1, 0b111), (4, 1, 0b1111), (5, 4, 0b1111)], "a long, b long, functions int")
    tried = spark.createDataFrame([(4, 5)], "lo long, hi long")
    got = cw._untried(agreed, tried).collect()
    assert sorted((r.lo, r.hi) for r in got) == [(1, 2), (1, 4)]
    assert all({r.a, r.b} == {r.lo, r.hi} for r in got)


def test_repeated_runs_of_the_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in cw.find_passages(docs, "doc_id", "text").collect()}
    words = {r.doc_id: (r.text or "").lower().split() for r in docs.collect()}
    seen = defaultdict(set)
    for k, w in words.items():
        for i in range(len(w) - 49):
            seen[tuple(w[i : i + 50])].add(k)
    runs = missed = 0
    for k, w in words.items():
        spans = [tuple(map(int, x.split(":"))) for x in got[k].spans.split(",") if x]
        for i in range(len(w) - 49):
            if len(seen[tuple(w[i : i + 50])]) > 1:
                runs += 1
                missed += not any(s <= i and i + 50 <= e for s, e in spans)
    assert runs > 100 and missed <= 0.01 * runs


def test_passages_of_odd_rows(spark):
    rows = cw.find_passages(documents(spark), "doc_id", "text").collect()
    assert len(rows) == len(ODD_DOCUMENTS)
    assert all(r.n_passages == 0 and r.component == r.doc_id for r in rows)
    long = " ".join(WORDS[:60])
    twice = documents(spark, [(1, long, "en", "a", 1), (2, long, "en", "a", 1), (None, long, "en", "a", 1), (3, long[:100], "en", "a", 1)])
    got = {r.doc_id: (r.n_words, r.spans, r.component) for r in cw.find_passages(twice, "doc_id", "text").collect()}
    assert got[1] == got[2] == got[None] == (60, "0:60", 1) and got[3][1] == ""
    assert cw.find_passages(documents(spark, []), "doc_id", "text").count() == 0


def test_stored_tables_leave_no_shuffles(spark):
    """What was shuffled for a stored table is off the disk, and the session's settings are as before."""
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled() -> set[str]:
        return {f for folder in folders for _, _, files in os.walk(folder) for f in files if f.startswith("shuffle_")}

    spark.range(10).repartition(3, "id").count()
    before = shuffled()
    kept = common.stored(spark.range(5000).withColumn("x", F.xxhash64("id")).repartition(4, "x").groupBy("x").count())
    assert not shuffled() - before and kept.count() == 5000
    assert spark.conf.get(common._FREE_SHUFFLES, None) is None
