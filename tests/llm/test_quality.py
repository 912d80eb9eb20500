"""The byte-level network: held-out accuracy and what a score may depend on."""

import numpy as np
import pytest

from surgecast.llm import quality_cnn as q
from surgecast.llm.common import table
from surgecast.llm.queries import op9_quality
from tests.llm.rows import ODD_DOCUMENTS, documents

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def network(spark):
    return q.train(table(spark, SF, "documents"), table(spark, SF, "labels"))


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    rows = [(r.score, labels[r.doc_id], r.predicted) for r in op9_quality(spark, SF).collect() if r.held_out and labels.get(r.doc_id) is not None]
    good = np.array([s for s, y, _ in rows if y == 1])
    bad = np.array([s for s, y, _ in rows if y == 0])
    assert len(good) > 100 and len(bad) > 30
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert np.mean([p == y for _, y, p in rows]) > 0.97
    assert (good >= 0.3).mean() > 0.99


def test_the_whole_text_counts(network):
    clean = "The thing was and the other there. Then they went in, and it was of the one.\n" * 400
    junk = "X$$$ y%%% z&&& " * 100
    assert network.score(clean) - network.score(clean + junk) > 0.2
    assert network.score(junk + clean) == pytest.approx(network.score(clean + junk), abs=0.2)


def test_pieces_make_no_difference(network, monkeypatch):
    text = "Some words, again and again; none the same % twice. " * 3000
    whole = network.score(text)
    monkeypatch.setattr(q, "PIECE", q.BLOCK * 3)
    assert network.score(text) == pytest.approx(whole, abs=1e-6)


def test_odd_rows(spark, network):
    rows = q.scored(documents(spark), "text", network, "result").collect()
    assert len(rows) == len(ODD_DOCUMENTS) and all(0 <= r.result <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.result) == r.result
    assert q.scored(documents(spark, []), "text", network, "result").count() == 0


def test_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert q.train(documents(spark), empty).score("x") == 0.5
    one = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    assert 0.5 < q.train(documents(spark), one).score(None) < 1
    assert q.train(documents(spark, []), one).score("") <= 1
