"""Merkle manifest against a plain tree."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from surgecast.llm import manifest
from surgecast.llm.common import table
from surgecast.llm.queries import check_documents, op12_manifest
from tests.llm.rows import documents, write

NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """The root, and for each leaf what stands left and right of it on each level."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            run = nodes[at[i] // 3 * 3 : at[i] // 3 * 3 + 3]
            path.append(("".join(run[: at[i] % 3]), "".join(run[at[i] % 3 + 1 :])))
        nodes = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        at = [i // 3 for i in at]
    return nodes[0], paths


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf(r) for r in sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(r))))]) for s in sources}
    root, tops = plain_tree([trees[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops, strict=True):
        ordered = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, bytes.fromhex(leaf(r))))
        for r, path in zip(ordered, trees[s][1], strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            d = leaf((*r[:4], r[4].replace("\n", ""))) if tampered else leaf(r)
            for left, right in [*path, *top]:
                d = h(left, d, right)
            proof = h(*(x for pair in [*path, *top] for x in pair))
            out.append((r[0], leaf(r), trees[s][0], root, proof, d, d == root))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def test_query_by_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "documents").select(*NAMES).collect()]
    got = result(op12_manifest(spark, sf))
    assert got == expected(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_odd_rows(spark, tmp_path):
    df = documents(spark)
    rows = [tuple(r) for r in df.select(*NAMES).collect()]
    assert result(op12_manifest(spark, write(df, tmp_path))) == expected(rows)


def test_no_rows(spark, tmp_path):
    assert op12_manifest(spark, write(documents(spark, []), tmp_path)).collect() == []


@pytest.mark.parametrize("n", [1, 3, 28, 500])
def test_small_blocks_span_partitions(spark, n):
    """Trees of many blocks and runs, one group with most rows, repeated rows."""
    rows = [(i // 2, f"line\n{i // 2 % 7}", "en", "big" if i % 5 else f"s{i % 15}", 5) for i in range(n)]
    got = result(check_documents(documents(spark, rows), depth=2, run=2))
    assert got == expected([(k, s, lang, c, t) for k, t, lang, s, c in rows])


def test_missing_nodes_are_few():
    """Neighbouring blocks share their paths; a whole tree lacks nothing."""
    leaves = 3**manifest.DEPTH * 81
    assert manifest.missing(set(range(81)), leaves, manifest.DEPTH) == []
    assert manifest.missing({0, 1, 2}, leaves, manifest.DEPTH) == [(7, 1), (7, 2), (8, 1), (8, 2), (9, 1), (9, 2)]
    alone = [x for b in range(8) for x in manifest.missing({b}, leaves, manifest.DEPTH)]
    assert len(manifest.missing(set(range(8)), leaves, manifest.DEPTH)) == 5 < len(set(alone)) < len(alone)


def test_fields_count_bytes(spark):
    df = spark.createDataFrame([("é", None, 3)], "a string, b string, c long")
    got = df.select(F.concat(*(manifest.field(F.col(c)) for c in "abc"))).first()[0]
    assert got == "2:é-1:3"
