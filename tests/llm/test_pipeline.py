"""The pipeline's stages, each on its own input, against brute force."""

from collections import Counter

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from surgecast.llm import quality_cnn
from surgecast.llm.common import table
from surgecast.llm.queries import QUERIES, TOKENIZER
from tests.llm.rows import CLASHING, ODD_DOCUMENTS, documents, write
from tests.llm.test_joins import brute_join
from tests.llm.test_native import base_spans

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before the first stage and after each."""
    docs, out = table(spark, SF, "documents"), []
    out.append(docs.collect())
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs.collect())
    return out


def test_registered():
    assert entry.queries().keys() >= {*QUERIES, "pipeline"}
    assert [n for n, _ in pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "encode"]


def test_quality_rejects_what_the_network_rejects(spark, steps):
    network = quality_cnn.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    assert Counter(steps[1]) == Counter(r for r in steps[0] if network.score(r.text) >= 0.3)
    assert 0 < len(steps[1]) < len(steps[0])


def test_one_document_of_each_group_stays(steps):
    parts = brute_join([(r.doc_id, r.text) for r in steps[1]])
    assert Counter(steps[2]) == Counter(r for r in steps[1] if parts[r.doc_id][1] == r.doc_id)
    assert len(steps[2]) < len(steps[1])


def test_personal_data_is_masked(steps):
    before = {r.doc_id: r for r in steps[2]}
    assert len(steps[3]) == len(before)
    for r in steps[3]:
        old = before[r.doc_id]
        assert base_spans(r.text) == [] and r.n_chars == len(r.text) and (r.lang, r.source) == (old.lang, old.source)
        assert r.text == old.text or "[" in r.text


def test_mix_takes_whole_documents(steps):
    assert set(steps[4]) < set(steps[3])
    words = sum(len(r.text.split()) for r in steps[3])
    assert 0.8 * words < sum(len(r.text.split()) for r in steps[4]) < 0.95 * words


def test_encoding(steps):
    library = Tokenizer.from_file(TOKENIZER)
    texts = {r.doc_id: r.text for r in steps[4]}
    assert sorted(texts) == sorted(r.doc_id for r in steps[5])
    for r in steps[5]:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_run(spark, steps):
    assert Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in pipeline.run(spark, SF).collect()) == Counter((r.doc_id, r.n_tokens, r.decoded_sha256) for r in steps[5])


def test_stages_on_odd_and_no_rows(spark, tmp_path):
    labels = [(i, q, 0) for i, q in enumerate([1, 0] * 6)] + [(None, None, None), (3, 1, 1)]
    write(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    for rows in (None, []):
        docs = documents(spark, rows)
        for name, stage in pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            got = out.collect()
            assert len(got) <= len(ODD_DOCUMENTS if rows is None else [])
            assert all(tuple(r)[5:] == tuple(CLASHING) for r in got)
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
    kept = [r.doc_id for r in pipeline.near_duplicates(spark, documents(spark), str(tmp_path)).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, 4, 5, 6, 8, None, None], key=str)


def test_rows_of_a_repeated_id_are_judged_by_their_own_texts(spark, tmp_path):
    """A clean text under a repeated id stays, though another row of that id is a copy."""
    texts = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abc"}
    rows = [(1, texts["a"]), (2, texts["a"]), (2, texts["b"]), (3, texts["b"] + " more"), (2, texts["c"]), (2, texts["c"]), (4, None), (4, None), (None, texts["a"])]
    docs = documents(spark, [(k, t, "en", "s", 1) for k, t in rows])
    got = Counter((r.doc_id, r.text) for r in pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())
    assert got == Counter([(1, texts["a"]), (2, texts["b"]), (2, texts["c"]), (4, None), (4, None), (None, texts["a"])])
