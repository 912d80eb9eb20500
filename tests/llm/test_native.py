"""Sharding, mixing and personal data."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import compare, duck
from surgecast.llm import mixing, pii, sharding
from surgecast.llm.common import table
from surgecast.llm.oracle import ORACLE
from surgecast.llm.queries import QUERIES, levels
from tests.llm.rows import ODD_DOCUMENTS, documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    con = duck(SF)
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    diff, n = compare(spark, con, SF, QUERIES[name], ORACLE[name])
    assert diff == "" and n > 0


# --- sharding ---------------------------------------------------------------------------------


def test_shards_of_odd_rows(spark):
    rows = sharding.assign_shards(documents(spark), "doc_id", "text", [1.0] * 4).collect()
    assert len(rows) == len(ODD_DOCUMENTS)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 4)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = defaultdict(set)
    for r in rows:
        by_key[r.doc_id].add(r.shard)
    assert all(len(s) == 1 for s in by_key.values())
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in ODD_DOCUMENTS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def test_shards_follow_weights_and_move_little(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    rows = sharding.assign_shards(keys, "doc_id", "text", [1.0, 2.0, 5.0], grown_weight=2.0).collect()
    share = Counter(r.shard for r in rows)
    assert abs(share[2] / 20_000 - 5 / 8) < 0.02 and abs(share[0] / 20_000 - 1 / 8) < 0.02
    moved = sum(r.grown_shard == 3 for r in rows)
    assert abs(moved / 20_000 - 2 / 10) < 0.02


def test_no_rows_no_shards(spark):
    assert sharding.assign_shards(documents(spark, []), "doc_id", "text", [1.0] * 8).count() == 0


# --- mixing -----------------------------------------------------------------------------------


def _fill(children, budget):
    """{name: given}: children are (name, weight, room), filled to a common level."""
    given, left, open_ = {}, budget, sorted(children, key=lambda c: (c[2] / c[1], c[0]))
    while open_:
        name, weight, room = open_[0]
        if left * weight < room * sum(c[1] for c in open_):
            break
        given[name], left, open_ = room, left - room, open_[1:]
    total = sum(c[1] for c in open_)
    return given | {n: int(left * w // total) for n, w, _ in open_}


@settings(max_examples=8, deadline=None)
@given(
    st.dictionaries(st.tuples(st.sampled_from("ab"), st.sampled_from("xyz"), st.sampled_from("123")), st.integers(0, 500), min_size=1),
    st.sampled_from([0.2, 0.7, 1.0, 1.6]),
)
def test_budgets_by_brute_force(spark, leaves, share):
    mix = mixing.Mix(share=share, weights={"a": 3, "a/x": 2, "b/y/1": 4}, epochs=2)
    frame = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "d string, l string, s string, tokens long")
    got = {(r.d, r.l, r.s): r.budget for r in mixing.budgets(frame, ["d", "l", "s"], mix).collect()}

    def below(prefix, budget):
        if len(prefix) == 3:
            return {prefix: budget}
        names = sorted({k[len(prefix)] for k in leaves if k[: len(prefix)] == prefix})
        kids = [(n, float(mix.weights.get("/".join((*prefix, n)), 1)), 2 * sum(t for k, t in leaves.items() if k[: len(prefix) + 1] == (*prefix, n))) for n in names]
        out = {}
        for n, b in _fill(kids, budget).items():
            out |= below((*prefix, n), b)
        return out

    want = below((), int(sum(leaves.values()) * share))
    assert got == want
    assert all(b <= 2 * leaves[k] for k, b in got.items())


def test_copies_meet_budgets(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = mixing.mix_sources(docs, "doc_id", "text", levels(), mixing.Mix(share=0.6, epochs=2)).collect()
    assert len(rows) == docs.count()
    budget, taken, largest = {}, Counter(), Counter()
    for r in rows:
        leaf = (r.domain, r.lang, r.source)
        budget[leaf] = r.leaf_budget
        taken[leaf] += r.tokens * r.copies
        largest[leaf] = max(largest[leaf], r.tokens)
    assert all(abs(taken[x] - b) <= largest[x] / 2 + 1 for x, b in budget.items())


def test_no_task_orders_a_whole_leaf(spark):
    """Documents are dealt by leaf and part, also where budgets are joined by shuffle."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    plan = mixing.mix_sources(docs, "doc_id", "text", levels(), mixing.Mix())._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_COL" in plan
    dealt = next(line for line in plan.splitlines() if "REPARTITION_BY_COL" in line)
    assert "part#" in dealt and "source#" in dealt
    window = plan.index("sum(tokens")
    assert window < plan.index("REPARTITION_BY_COL")


def test_mix_of_odd_rows(spark):
    rows = mixing.mix_sources(documents(spark), "doc_id", "text", levels(), mixing.Mix()).collect()
    assert len(rows) == len(ODD_DOCUMENTS)
    assert sum(r.tokens for r in rows if r.doc_id == 5) == 30_001
    assert {r.tokens for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert mixing.mix_sources(documents(spark, []), "doc_id", "text", levels(), mixing.Mix()).count() == 0


# --- personal data ----------------------------------------------------------------------------


def _digits(m):
    return re.sub("[^0-9]", "", m)


def _luhn(s):
    return sum(int(c) * 2 - 9 * (int(c) > 4) if i % 2 else int(c) for i, c in enumerate(reversed(s))) % 10 == 0


BASE = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(_digits(m)) <= 19 and _luhn(_digits(m))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(_digits(m)) <= 15),
}


def base_spans(text):
    return [(k, m.start(), m.end()) for k, (p, ok) in BASE.items() for m in re.finditer(p, text or "") if ok(m.group())]


def test_base_spans_by_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = pii.find_spans(docs, "doc_id", "text").collect()
    assert len(rows) == len(texts) and sum(len(r.spans) for r in rows) > 50
    for r in rows:
        assert [(s.kind, s.s, s.e) for s in r.spans if s.base] == base_spans(texts[r.doc_id])


TRICKY = [
    "a@b.c_d@e.f x@y x@y.z. ..@-.-", "1.2.3.4.5.6.7.8 256.1.1.1 0255.000.1.2 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112",
    "+1 (523) 555-1055 ++49 30 123456 +1 2 +123456789012345678", "9" * 5000, "a" * 5000 + "@", "+" + "1 " * 4000, "🙂 é@x.y é 🙂a@x.yz",
    "mail bob (at) example (dot) com", "call 523-555-1055 now", "4111 1111 1111 1112", "", None, "1" * 13 + " " + "0" * 16,
]


def test_base_spans_of_tricky_texts(spark):
    rows = pii.find_spans(spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string"), "doc_id", "text").collect()
    for r in rows:
        assert [(s.kind, s.s, s.e) for s in r.spans if s.base] == base_spans(TRICKY[r.doc_id]), TRICKY[r.doc_id]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("a@.+-( )019é🙂%_", max_size=60), min_size=20, max_size=60))
def test_base_spans_of_random_texts(spark, texts):
    rows = pii.find_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").collect()
    for r in rows:
        assert [(s.kind, s.s, s.e) for s in r.spans if s.base] == base_spans(texts[r.doc_id]), texts[r.doc_id]


def test_added_spans_keep_off_base_ones_and_masking_removes_them(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = pii.find_spans(docs, "doc_id", "text").collect()
    for r in rows:
        for s in r.spans:
            assert s.base or all(s.e <= b.s or b.e <= s.s for b in r.spans if b.base)
    masked = {r.doc_id: r.text for r in pii.mask_spans(docs, "text").select("doc_id", "text").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows:
        assert base_spans(masked[r.doc_id]) == []
        if not r.spans:
            assert masked[r.doc_id] == texts[r.doc_id]


def test_reliable_labelers_win(spark):
    """Candidates whose shape, checksum and context agree with the base spans are taken, others are not."""
    texts = [f"call {200 + i} now: mail me a{i}@b.com or card 4111 1111 1111 1111" for i in range(200)]
    texts += ["write to bob[at]example[dot]com today"] * 20 + ["order 1234 5678 9012 3456"] * 20
    rows = pii.find_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "doc_id", "text").collect()
    added = Counter(s.kind for r in rows for s in r.spans if not s.base)
    assert added["card"] == 0
    assert added["email"] in (0, 20)


def test_personal_data_of_odd_rows(spark):
    rows = pii.find_spans(documents(spark), "doc_id", "text").collect()
    assert len(rows) == len(ODD_DOCUMENTS) and not any(r.spans for r in rows)
    assert pii.find_spans(documents(spark, []), "doc_id", "text").count() == 0
    masked = pii.mask_spans(documents(spark), "text")
    assert masked.columns == documents(spark).columns
    assert Counter(r.text for r in masked.collect()) == Counter(r[1] for r in ODD_DOCUMENTS)
