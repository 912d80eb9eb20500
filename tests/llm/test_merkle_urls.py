"""Document fingerprints and URL filters."""

import hashlib
import random
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surgecast.llm import merkle, urls
from surgecast.llm.common import table
from surgecast.llm.queries import URL_RULES, op2_merkle, op7_url_rules
from tests.llm.rows import ODD_DOCUMENTS, documents

# --- fingerprints -------------------------------------------------------------------------------


@given(st.text("ab \n", max_size=30), st.text("ab \n", max_size=30))
def test_roots_are_equal_for_equal_texts_only(a, b):
    assert (merkle.tree(a).digest == merkle.tree(b).digest) == (a == b)
    near, spans = merkle.compare(merkle.tree(a), merkle.tree(b))
    assert 0 <= near <= 1 and (near == 1) == (a == b) and (spans == []) == (a == b or near == 1 or not spans)
    assert near == merkle.compare(merkle.tree(b), merkle.tree(a))[0]


def test_differences_are_located():
    rng = random.Random(2)
    lines = [" ".join(str(rng.randrange(1000)) for _ in range(30)) for _ in range(200)]
    text = "\n".join(lines)
    at = text.index(lines[120]) + 40
    other = text[:at] + "CHANGED" + text[at + 3 :]
    near, spans = merkle.compare(merkle.tree(text), merkle.tree(other))
    assert near > 0.99
    assert len(spans) == 1 and spans[0][0] <= at < spans[0][1] and spans[0][1] - spans[0][0] < 200


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op2_merkle(spark, sf).collect()}
    texts = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    ids = sorted(texts)
    assert sorted(rows) == ids
    prints = {}
    close = 0
    for i, k in enumerate(ids):
        text, following = texts[k], texts[ids[(i + 1) % len(ids)]]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        r = rows[k]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert r.edited_fingerprint == merkle.tree(edited).digest.hex()
        assert r.near_edited == merkle.compare(merkle.tree(text), merkle.tree(edited))[0]
        assert r.near_next == merkle.compare(merkle.tree(text), merkle.tree(following))[0]
        close += 0.65 <= r.near_edited <= 1
    assert len(set(prints.values())) == len(prints)
    assert close >= 0.9 * len(ids)


def test_next_text_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "ROWS_A_BLOCK", 3)
    rng = random.Random(9)
    keys = sorted({rng.randrange(-(2**40), 2**40) for _ in range(40)} | set(range(100)) | {2**62, -(2**62)})
    for broadcast in (100, 0):
        monkeypatch.setattr(merkle, "BROADCAST_KEYS", broadcast)
        rows = merkle.with_next(spark.createDataFrame([(k, f"text {k}") for k in keys], "doc_id long, text string"), "doc_id", "text").collect()
        assert {r.k: r.next for r in rows} == {k: f"text {n}" for k, n in zip(keys, keys[1:] + keys[:1], strict=True)}


def test_fingerprints_of_odd_rows(spark):
    rows = merkle.fingerprint_documents(documents(spark), "doc_id", "text").collect()
    assert len(rows) == len(ODD_DOCUMENTS)
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by[2].fingerprint == by[3].fingerprint == by[2].edited_fingerprint and by[2].near_edited == by[2].near_next == 1
    assert by[1].fingerprint == by[7].fingerprint != by[6].fingerprint
    assert by[8].edited_sha256 == hashlib.sha256((ODD_DOCUMENTS[-1][1][:-3] + "a p").encode()).hexdigest()
    assert all(r.near_next == 0 for r in rows if r.doc_id is None)
    assert merkle.fingerprint_documents(documents(spark, []), "doc_id", "text").count() == 0
    alone = merkle.fingerprint_documents(documents(spark, [(5, "abcdefgh", "en", "s", 8)]), "doc_id", "text").collect()
    assert alone[0].near_next == 1 and alone[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


# --- urls -----------------------------------------------------------------------------------------


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[end:]
    stop = min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), tail[:stop]


def ruled(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


ODD_URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.COM", "http://x.com/", "http://com/", "http://Example.com/en/1", "http://www.example.com/en/", "http://a.www.example.com/en/x",
    "http://wwwexample.com/en/", "https://q.net/es/?a=/x#y", "https://q.net?x=/es/", "ftp://é.NET/fr/#://z", "a://b://c.com/d", "http://x.org/\n/y?z", "://.net/es/", "http://x.org/" + "a/" * 9000,
]


def test_rules_and_parts_of_urls(spark):
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(ODD_URLS)] + [(0, None), (None, "http://x.com/")], "page_id long, url string")
    frame = frame.withColumns({"host": F.lit("x"), "path": F.lit(1), "rule": F.lit(2), "k": F.lit(3), "bad": F.lit(True), "token": F.lit("t")})
    none = spark.createDataFrame([], "url string, blocked boolean")
    rows = urls.judge_urls(frame, "page_id", "url", URL_RULES, none).collect()
    assert len(rows) == len(ODD_URLS) + 2
    for r in rows:
        if r.page_id is not None:
            host, path = parsed(ODD_URLS[r.page_id])
            rule, verdict = ruled(host, path)
            assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow"), ODD_URLS[r.page_id]
    assert urls.judge_urls(frame.limit(0), "page_id", "url", URL_RULES, none).count() == 0


def test_rules_are_mined_and_pruned(spark):
    rows = [(f"http://www.pills{i % 2}.org/buy/{i}", True) for i in range(40)] + [(f"http://www.shop.org/buy/{i}", False) for i in range(40)]
    rows += [(f"http://blog.site{i}.org/read/{i}?ref=spam", i % 5 != 0) for i in range(50)] + [(f"http://ok{i}.org/read/{i}", False) for i in range(60)]
    rows += [(None, True), ("http://x.org/", None)]
    how = urls.Mining(support=0.05, confidence=0.7, lift=1.2, least=1, held_out=0)
    labelled = spark.createDataFrame(rows, "url string, blocked boolean")
    index = urls.mine(labelled, how)
    found = {}
    for r in index.collect():
        found.setdefault(r.rule, (set(), r.size, r.confidence))[0].add(r.token)
    assert all(len(tokens) == size for tokens, size, _ in found.values())
    sets = [tokens for tokens, *_ in found.values()]
    assert {"h:pills0"} in sets and {"h:pills1"} in sets and {"q:ref"} in sets
    assert not any(a < b for a in sets for b in sets)
    # Every rule's confidence and support, and every verdict, by brute force.
    clean = [(u, b) for u, b in rows if u is not None and b is not None]
    tokens = {r.url: set(r.t) for r in spark.createDataFrame(clean, "url string, blocked boolean").select("url", urls.tokens_of(F.col("url")).alias("t")).collect()}
    for need, _, sure in found.values():
        hit = [b for u, b in clean if need <= tokens[u]]
        assert abs(sum(hit) / len(hit) - sure) < 1e-9 and sure >= 0.7 and sum(hit) >= 0.05 * len(clean)
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(clean)], "page_id long, url string")
    got = {r.page_id: r.verdict for r in urls.judge_urls(pages, "page_id", "url", [], labelled, how).collect()}
    assert got == {i: "block" if any(s <= tokens[u] for s in sets) else "allow" for i, (u, _) in enumerate(clean)}
    assert set(got.values()) == {"block", "allow"}


def test_all_tokens_of_a_url_are_mined(spark):
    """A token counts beside any number of better ones, tokens that come together take no combinations, and rules are those of brute force."""
    many = "/".join(f"part{c}" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMN")
    rows = [(f"http://x{i}.org/{many}?ref={i}", True) for i in range(30)] + [(f"http://x{i}.org/q?ref={i}", i % 2 == 0) for i in range(20)]
    rows += [(f"http://y{i}.org/z", False) for i in range(100)]
    how = urls.Mining(support=0.05, confidence=0.7, lift=1.2, least=5, held_out=0)
    found = {}
    for r in urls.mine(spark.createDataFrame(rows, "url string, blocked boolean"), how).collect():
        found.setdefault(r.rule, (set(), r.confidence))[0].add(r.token)
    assert sorted((sorted(t), c) for t, c in found.values()) == sorted([([f"p:{x}"], 1.0) for x in many.split("/")] + [(["q:ref"], 0.8)])

    rng = random.Random(7)
    sets = [frozenset(t for t in "abcdefg" if rng.random() < 0.6) for _ in range(400)]
    marks = [rng.random() < (0.9 if {"a", "c"} <= t else 0.7 if "b" in t and "d" not in t else 0.1) for t in sets]
    rows = [(f"http://h/{'/'.join(sorted(t))}", m) for t, m in zip(sets, marks, strict=True)]
    index = urls.mine(spark.createDataFrame(rows, "url string, blocked boolean"), urls.Mining(support=0.0, confidence=0.6, lift=1.1, least=5, held_out=0))
    found = {}
    for r in index.collect():
        found.setdefault(r.rule, (set(), r.confidence))[0].add(r.token[2:])
    sure = {}
    for mask in range(1, 1 << 8):  # the label of the host, which all hold, is one of the tokens
        part = frozenset(t for i, t in enumerate("abcdefgh") if mask >> i & 1)
        hit = [m for t, m in zip(sets, marks, strict=True) if part - {"h"} <= t]
        if sum(hit) >= 5 and sum(hit) / len(hit) >= max(0.6, 1.1 * sum(marks) / len(marks)):
            sure[part] = sum(hit) / len(hit)
    want = {t: c for t, c in sure.items() if not any(s < t and sure[s] >= c for s in sure)}
    assert any(len(t) >= 4 for t in want) and {frozenset(t): c for t, c in found.values()} == want


def test_rules_beat_chance_on_urls_held_out_or_go(spark):
    """Labels that follow a token give rules whose precision on other URLs exceeds the base rate; random ones give none."""
    rng = random.Random(4)
    hosts = ["shop", "blog", "news", "casino", "mail"]

    def table_of(n, blocked):
        rows = [f"http://{rng.choice(hosts)}.site{rng.randrange(40)}.org/{rng.choice('abc')}/{i}" for i in range(n)]
        return [(u, blocked(u)) for u in rows]

    def follows(u):
        return rng.random() < (0.9 if "casino" in u else 0.15)

    labelled = spark.createDataFrame(table_of(1500, follows), "url string, blocked boolean")
    index = urls.mine(labelled, urls.Mining())
    assert "h:casino" in {r.token for r in index.collect()}
    others = table_of(600, follows)
    bad = {r.url for r in urls.blocked_urls(spark.createDataFrame(others, "url string, blocked boolean").select("url"), index).collect()}
    hit = [b for u, b in others if u in bad]
    assert len(hit) > 60 and sum(hit) / len(hit) > 0.7 > sum(b for _, b in others) / len(others)
    random_labels = spark.createDataFrame(table_of(1500, lambda u: rng.random() < 0.25), "url string, blocked boolean")
    assert urls.mine(random_labels, urls.Mining()).count() == 0


def test_query_by_brute_force(spark):
    """Every verdict, that of mined rules by the tokens of the URL."""
    sf = "/root/testdata/sf0.1"
    pages = table(spark, sf, "pages")
    texts = {r.page_id: r.url for r in pages.collect()}
    rows = op7_url_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    marks = {r.doc_id: r.quality == 0 or r.toxic == 1 for r in table(spark, sf, "labels").collect()}
    labelled = spark.createDataFrame([(u, marks[k]) for k, u in texts.items() if k in marks], "url string, blocked boolean")
    found = {}
    for r in urls.mine(labelled, urls.Mining()).collect():
        found.setdefault(r.rule, set()).add(r.token)
    tokens = {r.url: set(r.t) for r in pages.select("url", urls.tokens_of(F.col("url")).alias("t")).collect()}
    for r in rows:
        host, path = parsed(texts[r.page_id])
        rule, verdict = ruled(host, path)
        mined = "block" if any(t <= tokens[texts[r.page_id]] for t in found.values()) else "allow"
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or mined)
