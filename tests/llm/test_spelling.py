"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from surgecast.llm import spelling
from surgecast.llm.common import row_pairs
from surgecast.llm.queries import op13_spelling
from tests.llm.rows import documents, write

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def counted(rows):
    times = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(UPPER)
            h = zlib.crc32(f"{'null' if k is None else k}:{w}".encode())
            at = h % len(w)
            times[w[:at] + w[at + 1 :] if h % 31 == 0 else w] += 1
    return {w: n for w, n in times.items() if n >= 2 and len(w) >= 7}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    n = counted(rows)
    out, forms = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best and n[best] >= 10 * n[w] else None
        out[w] = (w, forms[w], n[w], len(others), n[forms[w]] if forms[w] else None)
    result = []
    for w, form, times, n_near, form_n in out.values():
        root = w
        while forms[root]:
            root = forms[root]
        result.append((w, form, root, times, n_near, form_n))
    return sorted(result)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def vocabulary(rng):
    """Words over few letters, many of them one edit apart; some very long, one with many variants."""
    base = ["".join(rng.choices("abÉé×", k=rng.randrange(6, 12))) for _ in range(150)] + ["abcdefgh", "x" * 3000, "x" * 2999 + "y", "aaaaaaaa", "aaaaaaa"]
    base += [f"abcdefg{c}" for c in "ijklmnopqrst"] + [f"abcd{c}fgh" for c in "ijklmnopqrst"]
    edited = []
    for w in base[:150]:
        at, c = rng.randrange(len(w)), rng.choice("abé")
        edited += [w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :], w[:at] + c + w[at:]]
    return base + edited


@pytest.mark.parametrize("rows_a_tile", [2048, 3])
def test_small_table_by_brute_force(spark, rows_a_tile):
    """Also with tiles so small that all are cut to single places."""
    rng = random.Random(5)
    words = vocabulary(rng)
    rows = [(i if i % 9 else None, " ".join(w if rng.random() < 0.9 else w.upper() for w in rng.choices(words, weights=[1000 // (j + 1) + 1 for j in range(len(words))], k=80))) for i in range(150)]
    rows += [(None, None), (1, ""), (2, "-- 12 _"), (3, "abcdefgh1abcdefgh\nabcdefgh-abcdefgh")]
    df = documents(spark, [(k, t, "en", "s", 1) for k, t in rows])
    assert result(spelling.group_variants(df, "doc_id", "text", rows_a_tile)) == expected(rows)


def test_odd_rows(spark, tmp_path):
    df = documents(spark)
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(op13_spelling(spark, write(df, tmp_path))) == expected(rows)


def test_no_rows(spark, tmp_path):
    assert op13_spelling(spark, write(documents(spark, []), tmp_path)).collect() == []


def test_chains_end(spark):
    """Forms are followed to the last, however the steps are numbered."""
    chain = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb"]
    text = " ".join(w for w, n in zip(chain, (2, 30, 400, 5000), strict=True) for _ in range(n))
    rows = {r.word: r for r in spelling.group_variants(documents(spark, [(1, text, "en", "s", 1)]), "doc_id", "text").collect()}
    assert {rows[w].root for w in chain} == {"aaaaabbb"} and rows["aaaaaaaa"].form == "aaaaaaab" and rows["aaaaabbb"].form is None


@pytest.mark.parametrize("seed", range(3))
def test_pairs_are_all_of_a_tile(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 9, 20)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ends = np.repeat(bounds[1:], sizes)
    got = [(int(a), int(b)) for i, j in row_pairs(np.arange(bounds[-1]), ends, 7) for a, b in zip(i, j, strict=True)]
    assert got == [(a, b) for a in range(bounds[-1]) for b in range(a + 1, ends[a])]
