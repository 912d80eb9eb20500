"""Encoding against the tokenizers library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from surgecast.llm import bpe
from surgecast.llm.common import table
from surgecast.llm.queries import TOKENIZER, op6_bpe
from tests.llm.rows import ODD_DOCUMENTS, documents


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def _texts():
    rng = random.Random(5)
    signs = "abcdefghijklmnopqrstuvwxyz" * 3 + "ABCÉèßñ 'İΣσς\n\t\x85\xa0\x1c​0123!?<>|/w,.;-_ẞǅ漢字カ🙂éﬁ²½Ⅷ"
    for alphabet, length, count in ((signs, 60, 3000), ("aehnst", 40, 1000), ("!?.-*=#$%~", 40, 500)):
        for _ in range(count):
            yield "".join(rng.choice(alphabet) for _ in range(rng.randrange(length)))
    yield from ("", "<|endoftext|>abc<|startoftext|> x <|endoftext", "a" * 5000, "ab" * 999, "!" * 3000, "</w> x</w>", "'S 'll don't I'VE")


def test_words_as_the_library(library):
    ours = bpe.WordBpe(TOKENIZER)
    texts = list(_texts())
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ours.encode(text) == want.ids, text
        assert ours.decode(want.ids) == library.decode(want.ids, skip_special_tokens=False)


def test_kept_words_may_be_dropped(monkeypatch):
    ours, other = bpe.WordBpe(TOKENIZER), bpe.WordBpe(TOKENIZER)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    text = "one two three four five six one two three"
    want = other.encode(text)
    assert ours.encode(text) == want and len(ours.kept) <= 3


def test_query_as_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = op6_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_odd_rows(spark, library):
    rows = bpe.encode_documents(documents(spark), "doc_id", "text", TOKENIZER).collect()
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in ODD_DOCUMENTS)
    assert bpe.encode_documents(documents(spark, []), "doc_id", "text", TOKENIZER).count() == 0
