"""Near-duplicate embeddings by product quantisation with inverted lists.

Unit vectors are dealt to the nearest of some coarse centroids; an inverted list stores, for each of
its members, the residual to the centroid as one code per subspace, and how far the decoded vector
lies from the true one. A query vector looks its asymmetric distances to all members up in tables
and compares exactly, by cosine, those that may be near.

- A vector of another list lies beyond the bisector of the two centroids. A list is probed if its
  bisector is nearer than half the farthest that a linked vector can be: of two linked vectors on
  different sides of a bisector one is that near to it and probes the other's list, so no pair is lost. A
  pair that only one of them finds counts for both.
- The true distance is at least the table distance less the member's own error, so within the lists
  probed nothing is lost.

Centroids and codes are fitted on a bounded sample; every vector is indexed. Recall is measured in
the tests against all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.llm.common import cut, stored
from surgecast.llm.components import components

#: Vectors that centroids and codes are fitted on.
SAMPLE = 20_000
SUBSPACES, CODES, ROUNDS = 8, 256, 8
#: Members of a list and queries to it that one task compares.
MEMBERS, QUERIES = 1024, 16_384


def _nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (x @ centers.T - 0.5 * (centers * centers).sum(axis=1)).argmax(axis=1)


def kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """At most k centres; distinct rows where there are no more than that."""
    rng = np.random.default_rng(seed)
    unique = np.unique(x, axis=0)
    if len(unique) <= k:
        return unique
    centers = unique[rng.choice(len(unique), k, replace=False)]
    for _ in range(ROUNDS):
        near = _nearest(x, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centers))
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
    return centers


#: Two vectors of different lists lie on different sides of the bisector, so one of them is within half of their
#: distance of it and probes the other's list.
MARGIN = 0.5


@dataclass
class Index:
    """Coarse centroids and, for each subspace, the code words of residuals."""

    coarse: np.ndarray
    words: list[np.ndarray]
    reach: float  # the farthest that linked unit vectors lie apart
    margin: float

    @property
    def width(self) -> int:
        return self.coarse.shape[1]

    @property
    def step(self) -> int:
        return self.width // SUBSPACES

    def unit(self, raw: list[np.ndarray]) -> np.ndarray:
        """Unit vectors in double precision, padded with zeros to the index's width."""
        out = np.zeros((len(raw), self.width))
        for i, v in enumerate(raw):
            out[i, : len(v)] = v
        out /= np.abs(out).max(axis=1, keepdims=True)
        return out / np.linalg.norm(out, axis=1, keepdims=True)

    def homes(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x, self.coarse)

    def probes(self, x: np.ndarray, homes: np.ndarray) -> list[np.ndarray]:
        """For each vector the lists that may hold a near one, its own among them."""
        squares = (self.coarse * self.coarse).sum(axis=1)
        lead = x @ self.coarse.T - 0.5 * squares  # half the negative squared distance, up to a constant
        gaps = np.sqrt(np.maximum(squares[homes][:, None] + squares - 2 * self.coarse[homes] @ self.coarse.T, 0))
        beyond = lead[np.arange(len(x)), homes][:, None] - lead  # distance to the bisector times the gap
        return [np.flatnonzero(row) for row in beyond <= (self.margin * self.reach + 1e-9) * gaps + 1e-12]

    def encode(self, x: np.ndarray, homes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the residuals, and the distance between each vector and what its codes decode to."""
        rest = x - self.coarse[homes]
        codes = np.empty((len(x), SUBSPACES), np.uint8)
        for m, words in enumerate(self.words):
            part = rest[:, m * self.step : (m + 1) * self.step]
            codes[:, m] = _nearest(part, words)
            rest[:, m * self.step : (m + 1) * self.step] -= words[codes[:, m]]
        return codes, np.linalg.norm(rest, axis=1)

    def table_distances(self, x: np.ndarray, home: int, codes: np.ndarray) -> np.ndarray:
        """Distances of queries (rows) to decoded members of one list (columns), by table lookup."""
        rest = x - self.coarse[home]
        total = np.zeros((len(x), len(codes)))
        for m, words in enumerate(self.words):
            part = rest[:, m * self.step : (m + 1) * self.step]
            table = (part * part).sum(axis=1)[:, None] + (words * words).sum(axis=1) - 2 * part @ words.T
            total += table[:, codes[:, m]]
        return np.sqrt(np.maximum(total, 0))


def fit(raw: list[np.ndarray], vectors: int, longest: int, cosine: float) -> Index:
    """Index fitted on a sample. The number of lists grows with the root of the number of vectors."""
    width = -(-max(longest, 1) // SUBSPACES) * SUBSPACES
    index = Index(np.zeros((1, width)), [np.zeros((1, width // SUBSPACES))] * SUBSPACES, math.sqrt(2 - 2 * cosine), MARGIN)
    if raw:
        x = index.unit(raw)
        index.coarse = kmeans(x, max(1, min(int(math.sqrt(vectors) / 2), len(x) // 16)), 1)
        rest = x - index.coarse[index.homes(x)]
        index.words = [kmeans(rest[:, m * index.step : (m + 1) * index.step], CODES, 2 + m) for m in range(SUBSPACES)]
    return index


def usable(vector: Column) -> Column:
    """Not null, with only finite components, not all of them zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


_LISTED = "label string, length int, list int, role int, spread long, id long, copies long, raw binary, codes binary, error double, lists binary"


def _listed(classes: DataFrame, index: Index) -> DataFrame:
    """A member row for each vector's own list and a query row for each list that it probes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 512):
                batch = whole.slice(start, 512)
                ids, labels, copies, vectors = (c.to_pylist() for c in batch.columns)
                raw = [np.array(v, np.float64) for v in vectors]
                x = index.unit(raw)
                homes = index.homes(x)
                codes, errors = index.encode(x, homes)
                rows = []
                for i, lists in enumerate(index.probes(x, homes)):
                    blob = raw[i].tobytes()
                    rows.append((labels[i], len(raw[i]), int(homes[i]), 0, ids[i], ids[i], copies[i], blob, codes[i].tobytes(), float(errors[i]), lists.tobytes()))
                    rows += [(labels[i], len(raw[i]), int(home), 1, ids[i], ids[i], copies[i], blob, None, None, homes[i].tobytes()) for home in lists]
                names = ["label", "length", "list", "role", "spread", "id", "copies", "raw", "codes", "error", "lists"]
                kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.float64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return classes.select("id", "label", "copies", "vector").mapInArrow(deal, _LISTED)


def _blocked(listed: DataFrame) -> DataFrame:
    """Lists cut into blocks of members by blocks of queries, each a task's work of bounded size."""
    sizes = listed.groupBy("label", "length", "list").agg(
        F.sum(F.when(F.col("role") == 0, 1)).alias("members"), F.sum(F.when(F.col("role") == 1, 1)).alias("queries")
    )
    sizes = cut(sizes.filter("members > 0").select("label", "length", "list", F.ceil(F.col("members") / MEMBERS).alias("mb"), F.ceil(F.col("queries") / QUERIES).alias("qb")))
    rows = listed.join(sizes, ["label", "length", "list"])
    own = F.pmod(F.xxhash64("spread"), F.when(F.col("role") == 0, F.col("mb")).otherwise(F.col("qb")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("role") == 0, F.col("qb")).otherwise(F.col("mb")) - 1))
    rows = rows.withColumn("own", own).withColumn("other", other)
    m = F.when(F.col("role") == 0, F.col("own")).otherwise(F.col("other"))
    q = F.when(F.col("role") == 0, F.col("other")).otherwise(F.col("own"))
    rows = rows.withColumn("m", m).withColumn("q", q)
    keys = ["label", "length", "list", "m", "q"]
    return rows.select(*keys, "role", "id", "copies", "raw", "codes", "error", "lists").repartition(*keys).sortWithinPartitions(*keys, "role")


def _compared(rows: DataFrame, index: Index, cosine: float) -> DataFrame:
    """(node, root, links): vectors linked in a block under one of them, and copies of linked ones per query, and per member that does not ask back."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple | None = None
        members: list[tuple] = []
        queries: list[tuple] = []
        state: dict = {}
        out: list[tuple[int, int, int]] = []

        def flush() -> None:
            if not queries or not members:
                queries.clear()
                return
            if "ids" not in state:
                state["ids"] = np.array([m[0] for m in members], np.int64)
                state["copies"] = np.array([m[1] for m in members], np.int64)
                state["unit"] = index.unit([np.frombuffer(m[2]) for m in members])
                state["codes"] = np.stack([np.frombuffer(m[3], np.uint8) for m in members])
                state["errors"] = np.array([m[4] for m in members])
                state["lists"] = [set(np.frombuffer(m[5], np.int64).tolist()) for m in members]
                state["root"] = {}
            ids = np.array([q[0] for q in queries], np.int64)
            x = index.unit([np.frombuffer(q[2]) for q in queries])
            near = index.table_distances(x, group[2], state["codes"]) - state["errors"] <= index.reach + 1e-9
            i, j = np.nonzero(near & (ids[:, None] != state["ids"]))
            exact = np.einsum("nd,nd->n", x[i], state["unit"][j]) >= cosine
            i, j = i[exact], j[exact]
            links = np.bincount(i, state["copies"][j], len(ids)).astype(np.int64)
            # A member that does not probe the query's list never sees the query.
            homes = [int(np.frombuffer(q[5], np.int64)[0]) for q in queries]
            for a, b in zip(i.tolist(), j.tolist(), strict=True):
                if homes[a] not in state["lists"][b]:
                    out.append((members[b][0], members[b][0], queries[a][1]))
            root = state["root"]

            def top(a: int) -> int:
                while root.setdefault(a, a) != a:
                    root[a] = a = root[root[a]]
                return a

            for a, b in zip(ids[i].tolist(), state["ids"][j].tolist(), strict=True):
                a, b = top(a), top(b)
                if a != b:
                    root[max(a, b)] = min(a, b)
            out.extend((int(a), int(a), int(n)) for a, n in zip(ids, links, strict=True) if n)
            queries.clear()

        def close() -> None:
            flush()
            root = state.get("root", {})
            for a in root:
                b = a
                while root[b] != b:
                    b = root[b]
                if a != b:
                    out.append((a, b, 0))
            members.clear()
            state.clear()

        def batch_out() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "root", "links"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns, strict=True):
                if row[:5] != group:
                    close()
                    group = row[:5]
                if row[5] == 0:
                    members.append(row[6:])
                else:
                    queries.append(row[6:])
                    if len(queries) >= 256:
                        flush()
            if out:
                yield batch_out()
        close()
        yield batch_out()

    return rows.mapInArrow(compare, "node long, root long, links long")


def dedup_embeddings(df: DataFrame, key: str, vector: str, label: str, cosine: float) -> DataFrame:
    """Key, n_links, component_id and kept of every row.

    Vectors of equal labels and lengths link if their cosine, in double precision, is at least
    ``cosine``. Null, empty and zero vectors, those with null or non-finite components, and rows
    without label link with nothing: no links, their own key as component, kept. Equal vectors link;
    they are compared as one and counted as many, so copies cost nothing. Rows that repeat a key
    count as vectors of their own under that key, each with its own links and component. A row with a null key counts as a link, names no
    component and is not kept. Keys are integers; other columns are not read; an empty table gives no rows.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    good = F.col("label").isNotNull() & usable(F.col("vector"))
    named = F.struct(F.xxhash64("label", "vector").alias("x"), F.xxhash64(F.lit(1), "vector", "label").alias("y"))
    marked = rows.withColumn("name", F.when(good, named))
    grouped = marked.filter("name is not null").groupBy("name").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    # Links are between classes, known by their number in the stored table: several may have the same key, or none.
    classes = stored(grouped.withColumn("id", F.monotonically_increasing_id()))
    about = classes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("longest")).first()
    sample = classes.select("vector", "name").orderBy(F.xxhash64("name"), "name").limit(SAMPLE).select("vector")
    raw = [np.array(v, np.float64) for v in sample.toArrow().column(0).to_pylist()]
    index = fit(raw, about["n"], about["longest"] or 1, cosine)
    found = cut(_compared(_blocked(_listed(classes, index)), index, cosine))
    roots = components(found.filter("node <> root"), "node", "root")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    described = classes.join(links, F.col("id") == F.col("node"), "left").drop("node").join(roots, F.col("id") == F.col("node"), "left")
    described = described.select("name", "copies", "least", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("root"))
    smallest = described.groupBy("root").agg(F.min("least").alias("component"))
    described = described.join(smallest, "root").select("name", "copies", "links", "component")
    joined = marked.select("id", "name").join(described, "name", "left")
    component = F.when(F.col("copies").isNull(), F.col("id")).otherwise(F.col("component"))
    return joined.select(
        F.col("id").alias(key),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
