"""Quality rules against a plain count and numpy's covariance."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgecast.llm import outliers
from surgecast.llm.common import table
from surgecast.llm.queries import op11_outliers
from tests.llm.rows import documents, write


def statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if at[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    failed = n < 20 or 100 * len(repeated) > 30 * n
    return n, sum(map(len, words)), sum(map((text or "").count, "#*$%&|<>")), len(lines) - len(set(lines)), len(repeated), failed


def test_statistics_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = op11_outliers(spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows} == {k: statistics(t) for k, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in rows)


ALPHABET = [" ", "\n", "\t", "\x0b", "a", "b", "#", "|", "é", "🙂", "\x85", "\x00"]


def test_statistics_of_odd_texts(spark):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\n", "a " * 7, "a " * 8, "a " * 9, "a b " * 60, "#|" * 9, "word " * 30_000]
    texts += ["".join(rng.choices(ALPHABET, weights=[6, 1, 1, 1, 4, 2, 1, 1, 1, 1, 1, 1], k=rng.randrange(400))) for _ in range(200)]
    df = documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    rows = outliers.with_statistics(df, "text").collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows} == {i: statistics(t)[:-1] for i, t in enumerate(texts)}
    assert all(r.n == "n" and r.source == "s" for r in rows)


def test_long_text_of_many_repeats_is_not_quadratic(spark):
    words = " ".join(f"w{i % 40_000}" for i in range(80_000))
    row = outliers.with_statistics(documents(spark, [(1, words, "en", "s", 1)]), "text").first()
    assert row.n_repeat_words == 80_000


def clean(rng):
    return " ".join(rng.choice(["tion", "and", "there", "heat", "of", "inside", "able"]) + rng.choice("abcdefg") for _ in range(rng.randrange(40, 400)))


@pytest.fixture(scope="module")
def judged(spark):
    """One source holds most rows, one is too small, one language has too few rows at all."""
    rng = random.Random(11)
    rows = [(i, clean(rng), "en", "big" if i % 4 else f"s{i % 3}", 1) for i in range(600)]
    rows += [(1000 + i, " | ".join(clean(rng).split()), "en", "big", 1) for i in range(40)]
    rows += [(2000 + i, clean(rng), "en", f"tiny{i}", 1) for i in range(40)]
    rows += [(3000, " ### ".join(clean(rng).split()), "en", None, 1), (3001, clean(rng), "xx", None, 1), (3002, " ### ".join(clean(rng).split()), None, None, 1)]
    df = documents(spark, rows)
    found = outliers.judge_documents(df, "doc_id", "text", "lang", "source")
    return {r.doc_id: r for r in found.collect()}


def test_clean_rows_stay_and_symbol_tables_go(judged):
    assert len(judged) == 683
    assert all(judged[i].kept for i in [*range(600), *range(2000, 2040)])
    assert not any(judged[1000 + i].kept for i in range(40))


def test_small_sources_are_pooled(judged):
    assert judged[2000].square is not None and judged[3000].square > outliers.CUTOFF and not judged[3000].kept
    # a language of one row has no estimate: only the fixed rules decide
    assert judged[3001].square is None and judged[3001].kept and judged[3002].kept


def test_estimate_is_that_of_the_best_subset(spark):
    """Factors of the final covariance give the distances that numpy gives."""
    rng = np.random.default_rng(4)
    x = np.floor(rng.multivariate_normal([5, 1.6, 0.5, 0.2, 0.1], np.diag([0.5, 0.01, 0.2, 0.1, 0.1]) + 0.02, 400) * 1024)
    x[:60] += [0, 3000, 5000, 0, 0]
    df = spark.createDataFrame([("=en", "=s", *map(int, r)) for r in x], ["lang_key", "source_key", *outliers._X])
    final = outliers.estimates(df)
    got = outliers._with_distance(df.join(final, ["lang_key", "source_key"]), "square", lambda d: d)
    squares = {tuple(r[c] for c in outliers._X): r.square for r in got.collect()}
    far = np.array([squares[tuple(map(int, r))] for r in x])
    assert (far[:60] > outliers.CUTOFF).all() and (far[60:] < outliers.CUTOFF).all()
    row = final.first()
    near = np.array([r for r in x[60:]])
    # all rows within the reweighting distance of some estimate: those of the best core
    mean = np.array([row[f"m{i}"] for i in range(5)])
    lower = np.array([[1.0 if i == j else row[f"l{i}{j}"] if j < i else 0.0 for j in range(5)] for i in range(5)])
    cov = lower @ np.diag([row[f"d{i}"] for i in range(5)]) @ lower.T
    y = near - mean
    assert np.allclose(np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y), far[60:])
    assert np.abs(mean / 1024 - [5, 1.6, 0.5, 0.2, 0.1]).max() < 0.1


def test_labelled_documents(spark):
    """Of labelled documents nearly all good ones stay, and most bad ones go."""
    sf = "/root/testdata/sf0.1"
    marked = op11_outliers(spark, sf).join(table(spark, sf, "labels"), "doc_id").filter(~F.col("base_failed"))
    rate = {r.quality: (r.n, r.kept) for r in marked.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("kept").cast("double")).alias("kept")).collect()}
    assert rate[1][1] > 0.995 and rate[0][1] < 0.1


def test_odd_rows(spark, tmp_path):
    df = documents(spark)
    rows = op11_outliers(spark, write(df, tmp_path)).collect()
    texts = Counter((r.doc_id, *statistics(r.text)) for r in df.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows) == texts


def test_no_rows(spark, tmp_path):
    assert op11_outliers(spark, write(documents(spark, []), tmp_path)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = op11_outliers(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
