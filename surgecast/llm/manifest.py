"""Merkle manifest of a dataset: proofs of all rows from one multiproof for each leaf partition.

Rows are leaves of a tree for each group; group roots are leaves of a last tree. Three consecutive
nodes make their parent (the last run may be shorter) until one node remains.

1. Leaves are sorted into ranges and numbered within their group.
2. A power of ARITY consecutive leaves (a block) are a whole subtree. Runs of blocks are dealt to leaf partitions of a
   bounded size, which compute the roots of their blocks; only these go further up.
3. A leaf partition lists the coordinates of the nodes that the proofs of all its leaves need and that
   it can't compute itself: siblings of its known nodes, level by level, where parents of known nodes
   count as known. Each coordinate is fetched once for the whole partition.
4. From its leaves and what it fetched it derives all shared nodes up to the root, and expands the
   proof of each leaf without any further exchange.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.llm.common import cut

#: Nodes that make a parent.
ARITY = 3
#: Levels of a block's subtree; ARITY to this power leaves are a block.
DEPTH = 6
#: Consecutive blocks that stay in one leaf partition.
RUN = 8

_NODE = "g string, level int, place long, d binary"


def field(column: Column) -> Column:
    """A value as it is hashed: its UTF-8 byte count, a colon, the value; a hyphen for null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the fields of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def joined(digests: Sequence[bytes]) -> bytes:
    """Digest of digests, which are hashed as their lowercase hex text."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def height(leaves: int) -> int:
    """Levels above the leaves."""
    level = 0
    while leaves > 1:
        leaves, level = -(-leaves // ARITY), level + 1
    return level


def width(leaves: int, level: int) -> int:
    """Nodes of a level."""
    return -(-leaves // ARITY**level)


def missing(known: set[int], leaves: int, level: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes without which the root can't be derived from the known ones."""
    wanted = []
    for at in range(level, height(leaves)):
        most = width(leaves, at)
        above = {i // ARITY for i in known}
        wanted += [(at, i) for p in sorted(above) for i in range(p * ARITY, min((p + 1) * ARITY, most)) if i not in known]
        known = above
    return wanted


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``pos``, their place in the order (g, k, d, o) within g.

    Rows are sorted into ranges, so a group may span many tasks; the driver sees two groups and two
    counts of each task.
    """
    order = ["g", "k", "d", "o", "tie"]
    # Equal rows can only be dealt to several ranges if something tells them apart.
    told = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = cut(cut(told).repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")).withColumn("task", F.spark_partition_id())
    of = ranged.groupBy("task", "g").agg(F.count(F.lit(1)).alias("n"))
    ends = of.groupBy("task").agg(F.min("g").alias("first"), F.max("g").alias("last"), F.max_by("n", "g").alias("n")).orderBy("task").collect()
    starts, last, n = {}, None, 0
    for r in ends:
        before = n if r["first"] == last else 0
        starts[r["task"]] = before
        n = r["n"] + (before if r["last"] == r["first"] else 0)
        last = r["last"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, at = None, -1
        for batch in batches:
            places = []
            for g in batch.column("g").to_pylist():
                if g != group:
                    at = starts[batch.column("task")[0].as_py()] if group is None else 0
                    group = g
                places.append(at)
                at += 1
            columns = {c: batch.column(c) for c in batch.schema.names if c != "task"}
            yield pa.RecordBatch.from_pydict(columns | {"pos": pa.array(places, pa.int64())})

    schema = ranged.drop("task").schema.add("pos", "long", False)
    return ranged.mapInArrow(place, schema)


def _subtree(digests: dict[int, bytes], levels: int) -> list[dict[int, bytes]]:
    """The levels above consecutive nodes, all children of which are known."""
    out = [digests]
    for _ in range(levels):
        below, above = out[-1], {}
        for i in sorted({i // ARITY for i in below}):
            above[i] = joined([below[c] for c in range(i * ARITY, (i + 1) * ARITY) if c in below])
        out.append(above)
    return out


def _nodes_table(rows: list[tuple]) -> pa.Table:
    g, level, place, d = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.table({"g": pa.array(g, pa.string()), "level": pa.array(level, pa.int32()), "place": pa.array(place, pa.int64()), "d": pa.array(d, pa.binary())})


def _block_roots(part: pa.Table, depth: int) -> pa.Table:
    """(part, g, block, n, level, d): the blocks of a leaf partition; a group of fewer leaves than a block ends below."""
    blocks: dict[tuple[str, int], dict[int, bytes]] = {}
    for g, pos, d in zip(*(part.column(c).to_pylist() for c in ("g", "pos", "d")), strict=True):
        blocks.setdefault((g, pos // ARITY**depth), {})[pos] = d
    out = []
    for (g, block), leaves in blocks.items():
        level = height(len(leaves)) if block == 0 and len(leaves) < ARITY**depth else depth
        out.append((part.column("part")[0].as_py(), g, block, len(leaves), level, next(iter(_subtree(leaves, level)[level].values()))))
    names = {"part": pa.int64(), "g": pa.string(), "block": pa.int64(), "n": pa.int64(), "level": pa.int32(), "d": pa.binary()}
    return pa.table({c: pa.array(v, t) for (c, t), v in zip(names.items(), zip(*out, strict=True), strict=True)})


def _climb(part: pa.Table, depth: int) -> pa.Table:
    """The next ``depth`` levels above sibling blocks, up to their group's root."""
    level, n, g = (part.column(c)[0].as_py() for c in ("level", "n", "g"))
    found = _subtree(dict(zip(part.column("place").to_pylist(), part.column("d").to_pylist(), strict=True)), min(depth, height(n) - level))
    return _nodes_table([(g, level + i, place, d) for i, nodes in enumerate(found) if i for place, d in nodes.items()])


def _wanted(part: pa.Table, depth: int) -> pa.Table:
    """Coordinates that a leaf partition has to fetch; level -1 stands for what is known of the whole group."""
    groups: dict[str, tuple[int, set[int]]] = {}
    for g, block, n in zip(*(part.column(c).to_pylist() for c in ("g", "block", "size")), strict=True):
        groups.setdefault(g, (n, set()))[1].add(block)
    rows = [(g, level, i) for g, (n, blocks) in groups.items() for level, i in [(-1, 0), *missing(blocks, n, depth)]]
    g, level, place = zip(*rows, strict=True)
    p = part.column("part")[0].as_py()
    return pa.table({"part": pa.array([p] * len(g), pa.int64()), "g": pa.array(g, pa.string()), "level": pa.array(level, pa.int32()), "place": pa.array(place, pa.int64())})


def _sides(nodes: dict[int, bytes], i: int, most: int) -> tuple[str, str]:
    run = range(i // ARITY * ARITY, min((i // ARITY + 1) * ARITY, most))
    return "".join(nodes[c].hex() for c in run if c < i), "".join(nodes[c].hex() for c in run if c > i)


def _expanded(leaves: list[tuple[int, bytes, bytes | None]], fetched: dict[int, dict[int, bytes]], n: int, top: Sequence[str]) -> Iterator[tuple[str, list[tuple[str, str]]]]:
    """The proof of every leaf, as the concatenated siblings and as what stands left and right of it on each level."""
    levels = [{pos: d for pos, d, _ in leaves}]
    for at in range(height(n)):
        children = levels[at] | fetched.get(at, {})
        levels[at] = children
        most = width(n, at)
        levels.append({p: joined([children[c] for c in range(p * ARITY, min((p + 1) * ARITY, most))]) for p in {i // ARITY for i in children}})
    above = [tuple(x.split(",")) for x in top]
    # What stands above a node is shared by all leaves below.
    paths: dict[int, tuple[str, list[tuple[str, str]]]] = {0: ("".join(a + b for a, b in above), above)}
    for at in range(len(levels) - 2, -1, -1):
        most, upper = width(n, at), paths
        own = levels[at] if at else [pos for pos, *_ in leaves]
        paths = {}
        for i in own:
            left, right = _sides(levels[at], i, most)
            text, path = upper[i // ARITY]
            paths[i] = (left + right + text, [(left, right), *path])
    for pos, *_ in leaves:
        yield paths[pos]


def _folded(d: bytes, path: list[tuple[str, str]]) -> bytes:
    for left, right in path:
        d = sha256((left + d.hex() + right).encode()).digest()
    return d


_META = "n long, top array<string>, root binary"


def _expand(keep: Sequence[str], with_path: bool):
    def expand(part: pa.Table, fetched: pa.Table) -> pa.Table:
        nodes: dict[str, dict[int, dict[int, bytes]]] = {}
        meta = {}
        for g, level, place, d, n, top, root in zip(*(fetched.column(c).to_pylist() for c in ("g", "level", "place", "d", "n", "top", "root")), strict=True):
            if level < 0:
                meta[g] = (d, n, top, root)
            else:
                nodes.setdefault(g, {}).setdefault(level, {})[place] = d
        part = part.sort_by([("g", "ascending"), ("pos", "ascending")])
        groups = part.column("g").to_pylist()
        rows = list(zip(*(part.column(c).to_pylist() for c in ("pos", "d", "o")), strict=True))
        subroots, roots, paths, proofs, folds = [], [], [], [], []
        start = 0
        while start < len(rows):
            end = start
            while end < len(rows) and groups[end] == groups[start]:
                end += 1
            subroot, n, top, root = meta[groups[start]]
            for (_, d, o), (text, path) in zip(rows[start:end], _expanded(rows[start:end], nodes.get(groups[start], {}), n, top), strict=True):
                subroots.append(subroot)
                roots.append(root)
                if with_path:
                    paths.append([",".join(x) for x in path])
                else:
                    proofs.append(sha256(text.encode()).hexdigest())
                    folds.append(_folded(o or d, path))
            start = end
        columns = {c: part.column(c) for c in keep} | {"subroot": pa.array(subroots, pa.binary()), "root": pa.array(roots, pa.binary())}
        if with_path:
            return pa.table(columns | {"path": pa.array(paths, pa.list_(pa.string()))})
        return pa.table(columns | {"proof_sha256": pa.array(proofs, pa.string()), "folded": pa.array(folds, pa.binary())})

    return expand


def prove(rows: DataFrame, *, with_path: bool = False, above: bool = True, depth: int = DEPTH, run: int = RUN) -> DataFrame:
    """``rows`` with the proof of each.

    ``rows``: g (group, not null, groups in text order), k (order within the group), d (digest of 32
    bytes), o (digest that is folded instead, or null). The result has k, d and subroot (root of the
    group's tree) and root; with ``with_path`` also path (from below, what stands left and right of
    the node on each level, hex digests with a comma between), else proof_sha256 (of all siblings, level
    by level, left to right) and folded (root recomputed from o, else d, and the siblings). With
    ``above`` the roots of the groups are leaves of a last tree; otherwise root is subroot. Rows of
    equal k are ordered by their digests.
    """
    placed = _numbered(rows)
    block = ARITY**depth
    parts = max(1, placed.count() // (block * run))
    arranged = cut(placed.withColumn("part", F.pmod(F.xxhash64("g", F.expr(f"pos div {block * run}")), F.lit(parts))).repartition("part"))
    roots = cut(arranged.select("part", "g", "pos", "d").groupBy("part").applyInArrow(lambda t: _block_roots(t, depth), "part long, g string, block long, n long, level int, d binary"))
    sizes = roots.groupBy("g").agg(F.sum("n").alias("size"))
    sized_roots = cut(roots.drop("n").join(sizes, "g"))

    # All nodes from the blocks up; a round climbs ``depth`` levels, so there are few.
    known = sized_roots.select("g", "level", F.col("block").alias("place"), "d")
    nodes, top = known, sized_roots.select("g", "level", F.col("block").alias("place"), F.col("size").alias("n"), "d")
    open_at = depth
    while True:
        many = top.filter((F.col("level") == open_at) & (F.col("n") > ARITY**open_at))
        if many.isEmpty():
            break
        climbed = cut(many.groupBy("g", F.expr(f"place div {block}").alias("over")).applyInArrow(lambda t: _climb(t, depth), _NODE))
        nodes = nodes.union(climbed)
        open_at += depth
        top = climbed.join(sizes.select("g", F.col("size").alias("n")), "g").select("g", "level", "place", "n", "d")
    nodes = cut(nodes)
    at_top = (F.pow(F.lit(ARITY), "level") >= F.col("size")) & ((F.col("level") == 0) | (F.pow(F.lit(ARITY), F.col("level") - 1) < F.col("size")))
    subroots = nodes.filter("place = 0").join(sizes, "g").filter(at_top).select("g", F.col("d").alias("subroot"), F.col("size").alias("n"))
    if above:
        leaves = subroots.select(F.lit("").alias("g"), F.col("g").alias("k"), F.col("subroot").alias("d"), F.lit(None).cast("binary").alias("o"))
        last = prove(leaves, with_path=True, above=False).select(F.col("k").alias("g"), F.col("path").alias("top"), "root")
        subroots = subroots.join(last, "g")
    else:
        subroots = subroots.withColumns({"top": F.array().cast("array<string>"), "root": F.col("subroot")})

    asked = sized_roots.select("part", "g", "block", "size").groupBy("part").applyInArrow(lambda t: _wanted(t, depth), "part long, g string, level int, place long")
    whole = subroots.select("g", F.lit(-1).alias("level"), F.lit(0).cast("long").alias("place"), F.col("subroot").alias("d"), "n", "top", "root")
    none = [F.lit(None).cast(t).alias(c) for c, t in (x.split(" ", 1) for x in _META.split(", "))]
    fetched = cut(asked.join(nodes.select("g", "level", "place", "d", *none).union(whole), ["g", "level", "place"]))
    kind = rows.schema["k"].dataType.simpleString()
    out = "path array<string>" if with_path else "proof_sha256 string, folded binary"
    each = arranged.groupBy("part").cogroup(fetched.groupBy("part"))
    return each.applyInArrow(_expand(["k", "d"], with_path), f"k {kind}, d binary, subroot binary, root binary, {out}")


def verify_rows(df: DataFrame, key: str, group: str, columns: Sequence[str], tampered: Column, changed: dict[str, Column], **shape: int) -> DataFrame:
    """Manifest of ``df`` and a check of each row against it.

    A row's leaf is the digest of ``columns``; trees are built for each value of ``group`` (null first,
    then by UTF-8 bytes), leaves in ascending order of ``key`` (null first; rows that repeat a key by
    leaf). Where ``tampered``, the row is checked as it is with the columns ``changed``.

    Columns: the key, leaf, subroot, root, proof_sha256, folded_root (hex) and verified (folded_root is
    root); ``shape`` goes to :func:`prove`. Equal rows are leaves of their own. Columns that are not named are not read; an empty table
    gives no rows.
    """
    own = leaf_digest([F.col(c) for c in columns])
    other = leaf_digest([changed.get(c, F.col(c)) for c in columns])
    rows = df.select(
        F.when(F.col(group).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group).cast("string"))).alias("g"),
        F.col(key).alias("k"),
        own.alias("d"),
        F.when(F.coalesce(tampered, F.lit(False)), other).alias("o"),
    )
    proved = prove(rows, **shape)
    text = {c: F.lower(F.hex(c)) for c in ("d", "subroot", "root", "folded")}
    return proved.select(
        F.col("k").alias(key),
        text["d"].alias("leaf"),
        text["subroot"].alias("subroot"),
        text["root"].alias("root"),
        "proof_sha256",
        text["folded"].alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )
