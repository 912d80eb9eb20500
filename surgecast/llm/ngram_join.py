"""Jaccard self-join of documents on word n-grams, by prefix filter and prefix trees.

1. Every text becomes the set of its distinct n-gram hashes. Equal sets are one class, named by a
   hash of the set. One pass also counts n-grams by the first 16 bits of their hash, and gives each
   set a sketch: the parity of how many of its n-grams fall on each of some bits. Sketches differ in at
   most as many bits as the sets in n-grams, so they rule pairs out and never a link.
2. Sets are put in one global order, rare n-grams first (by the count of their 16 bits, then by
   hash). Two sets can only reach the threshold if the first ``n - ceil(t * n) + 1`` of both share an
   n-gram, and what lies behind a shared one bounds their overlap.
3. Only links between different components matter. Of the classes behind a shared n-gram, all are
   first compared with one of them. Then, while some n-gram joins several components, each set is
   compared with the likeliest sets of other components behind its n-grams: those of the nearest sketches that
   no bound rules out, up to LIKELIEST at first, four times as many in each further round, which only looks
   at the n-grams where a set had more. The search ends where none had. Pairs are looked at in the task that
   holds an n-gram (large ones in blocks of rows against blocks of rows), and only those chosen leave it.
4. Pairs are compared exactly: the sets compared with one document form prefix trees, which its own
   set traverses once, sharing the overlap of common beginnings and leaving subtrees whose remaining
   lengths cannot reach the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.llm.common import ROWS_A_TASK, cut, row_pairs, sized, stored
from surgecast.llm.components import components

WORDS = 5
#: The threshold as a fraction: intersection / union >= NUM / DEN.
NUM, DEN = 4, 5
#: Rows behind one n-gram that one task may see; more are spread by salt.
ROWS_A_GROUP = 100_000
#: Sets in one prefix tree.
SETS_A_TREE = 64
#: Rows that may be broadcast to fetch texts; more are joined by shuffle.
BROADCAST_IDS = 100_000
#: Rows of an n-gram that are looked at against each other in one block; further ones make further blocks.
ROWS_A_BLOCK = 1024
#: Rows whose pairs are looked at together, and pairs at once.
ROWS_A_CHUNK, PAIRS_AT_ONCE = 4096, 1 << 20
#: Bits of a sketch as powers of two; a set has about one bit for each n-gram.
LEAST_BITS, MOST_BITS = 8, 13
#: Sets that each set is compared with at most in the first round of the search, and how many times as many in the next.
LIKELIEST, MORE = 2, 4
_PRIME = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_PRIME, i + 1, 1 << 64) for i in range(WORDS)], np.uint64)


def mixed_hash(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sequence_hashes(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words and hashes of the n-grams of a text, in order: words are what ASCII white space
    separates, A-Z lower-cased; fewer than WORDS words are one n-gram; none have none."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0, np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(len(words), WORDS)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        total += h[j : j + len(total)] * _POWERS[j]
    return len(words), mixed_hash(total)


def ngrams(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of a text."""
    return np.unique(sequence_hashes(text)[1])


def set_name(grams: np.ndarray) -> int:
    """A hash of the set as a signed 64-bit integer."""
    total = int(mixed_hash(grams).sum(dtype=np.uint64)) + len(grams) * _PRIME
    both = total ^ int(np.bitwise_xor.reduce(grams)) * 0x94D049BB133111EB
    return int(mixed_hash(np.array([both & 0xFFFFFFFFFFFFFFFF], np.uint64)).view(np.int64)[0])


def ordered(grams: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set in the global order: by rank of the first 16 bits, then by hash."""
    return grams[np.lexsort((grams, rank[(grams >> np.uint64(48)).astype(np.intp)]))]


def reaches(overlap, n, m):
    """Whether an overlap of sets of n and m elements meets the threshold."""
    return overlap * (NUM + DEN) >= NUM * (n + m)


# --- prefix tree ------------------------------------------------------------------------------


@dataclass
class Node:
    part: np.ndarray  # positions in the global order that all sets below share
    below: dict[int, Node] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # (size, name) of sets that end here
    least: int = 1 << 62  # smallest and largest size below
    most: int = 0


class Trie:
    """Sets of keys in increasing order, common beginnings stored once."""

    def __init__(self) -> None:
        self.root = Node(np.empty(0, np.uint64))

    def add(self, keys: np.ndarray, name: int) -> None:
        node, at, n = self.root, 0, len(keys)
        while True:
            node.least, node.most = min(node.least, n), max(node.most, n)
            if at == n:
                node.ends.append((n, name))
                return
            child = node.below.get(int(keys[at]))
            if child is None:
                node.below[int(keys[at])] = Node(keys[at:], ends=[(n, name)], least=n, most=n)
                return
            size = min(len(child.part), n - at)
            differs = np.flatnonzero(child.part[:size] != keys[at : at + size])
            same = int(differs[0]) if len(differs) else size
            if same < len(child.part):
                rest = Node(child.part[same:], child.below, child.ends, child.least, child.most)
                child.part, child.below, child.ends = child.part[:same], {int(rest.part[0]): rest}, []
            node, at = child, at + same

    def search(self, keys: np.ndarray) -> list[int]:
        """Names of the sets that reach the threshold with ``keys``, which are in the same order."""
        found, n = [], len(keys)
        todo = [(c, 0, 0) for c in self.root.below.values()]
        while todo:
            node, depth, overlap = todo.pop()
            depth += len(node.part)
            places = np.minimum(np.searchsorted(keys, node.part), n - 1)
            overlap += int((keys[places] == node.part).sum())
            passed = int(np.searchsorted(keys, node.part[-1], side="right"))
            found += [name for size, name in node.ends if reaches(overlap, n, size)]
            # What is left of the longest set below and of the keys must still reach the shortest one's need.
            if node.below and reaches(overlap + min(n - passed, node.most - depth), n, node.least):
                todo += [(c, depth, overlap) for c in node.below.values()]
        return found


def ordinal(grams: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set as integers that sort in the global order: rank in the first 16 bits, then the hash's rest.

    Each rank stands for one value of the first 16 bits, so nothing is lost.
    """
    top = rank[(grams >> np.uint64(48)).astype(np.intp)].astype(np.uint64)
    return np.sort((top << np.uint64(48)) | (grams & np.uint64((1 << 48) - 1)))


# --- the join ---------------------------------------------------------------------------------


def sketch(grams: np.ndarray) -> bytes:
    """On each bit, whether an odd number of n-grams falls on it."""
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (len(grams) - 1).bit_length()))
    odd = np.bincount((grams & np.uint64(bits - 1)).astype(np.intp), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(one: bytes, words: int) -> np.ndarray:
    """A sketch as so many 64-bit words, as if it had been made with fewer bits."""
    out = np.frombuffer(one, np.uint64)
    while len(out) > words:
        out = out[: len(out) // 2] ^ out[len(out) // 2 :]
    return out


def distances(sketches: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits in which sketches a and b differ, the longer one folded: at most the n-grams that only one set has."""
    words = np.fromiter((len(x) // 8 for x in sketches), np.int64, len(sketches))
    out = np.zeros(len(a), np.int64)
    shorter = np.minimum(words[a], words[b])
    for w in np.unique(shorter):
        own = np.flatnonzero(words >= w)
        row = np.full(len(sketches), -1)
        row[own] = np.arange(len(own))
        matrix = np.stack([folded(sketches[i], int(w)) for i in own])
        these = np.flatnonzero(shorter == w)
        step = max(1, (1 << 20) // int(w))
        for at in range(0, len(these), step):
            some = these[at : at + step]
            out[some] = np.bitwise_count(matrix[row[a[some]]] ^ matrix[row[b[some]]]).sum(axis=1)
    return out


def most_apart(n, m):
    """The n-grams that only one of two linked sets of n and m elements can have at most."""
    need = -(-NUM * (n + m) // (NUM + DEN))
    return n + m - 2 * need


def _described(docs: DataFrame) -> DataFrame:
    """(k, n, name, mark, sketch) of every document, and per task (bits, times): n-grams by the first bits of their hash.

    The sketch comes once per task and set, with a key.
    """
    kinds = {"k": pa.int64(), "n": pa.int64(), "name": pa.int64(), "mark": pa.int64(), "sketch": pa.binary(), "bits": pa.int32(), "times": pa.int64()}

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(1 << 16, np.int64)
        seen: set[int] = set()
        for batch in batches:
            n, names, sketches = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams = ngrams(text)
                n.append(len(grams))
                names.append(set_name(grams) if len(grams) else 0)
                sketches.append(None)
                if len(grams) and key is not None and names[-1] not in seen:
                    seen.add(names[-1])
                    sketches[-1] = sketch(grams)
                    times += np.bincount((grams >> np.uint64(48)).astype(np.intp), minlength=1 << 16)
            columns = {"k": batch.column(0), "n": n, "name": names, "mark": batch.column(2), "sketch": sketches, "bits": [None] * len(n), "times": [None] * len(n)}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds[c]) if isinstance(v, list) else v for c, v in columns.items()], list(columns))
        bits = np.flatnonzero(times)
        none = [pa.nulls(len(bits), kinds[c]) for c in ("k", "n", "name", "mark", "sketch")]
        yield pa.RecordBatch.from_arrays([*none, pa.array(bits, pa.int32()), pa.array(times[bits])], list(kinds))

    return docs.mapInArrow(describe, "k long, n long, name long, mark long, sketch binary, bits int, times long")


def _prefixes(docs: DataFrame, rank: np.ndarray, salts: np.ndarray) -> DataFrame:
    """(gram, salt, name, n, at): the first n-grams of every set, once per task and set.

    The salt is -1 where all rows of an n-gram stay together.
    """

    def cut_prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                columns: list[list[np.ndarray]] = [[], [], [], [], []]
                for text in whole.column(1).slice(start, 500).to_pylist():
                    grams = ngrams(text)
                    name = set_name(grams) if len(grams) else 0
                    if not len(grams) or name in seen:
                        continue
                    seen.add(name)
                    n = len(grams)
                    first = ordered(grams, rank)[: n - -(-NUM * n // DEN) + 1]
                    spread = salts[(first >> np.uint64(48)).astype(np.intp)]
                    size = len(first)
                    for c, v in zip(columns, (first.view(np.int64), np.where(spread > 1, name % spread, -1), np.full(size, name), np.full(size, n), np.arange(size)), strict=True):
                        c.append(v)
                if columns[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in columns], ["gram", "salt", "name", "n", "at"])

    return docs.mapInArrow(cut_prefixes, "gram long, salt long, name long, n long, at long")


def _possible(a: str, b: str) -> Column:
    """Whether two sets that share an n-gram at known places can reach the threshold."""
    n, m, i, j = (F.col(f"{x}.{c}") for c in ("n", "at") for x in (a, b))
    bound = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return bound * (NUM + DEN) >= NUM * (n + m)


def _compared(docs: DataFrame, pairs: DataFrame, ids: DataFrame, rank: np.ndarray) -> DataFrame:
    """The pairs (a, b) of set names that reach the threshold."""
    sides = pairs.join(ids.select(F.col("name").alias("a"), F.col("k").alias("ka")), "a").join(ids.select(F.col("name").alias("b"), F.col("k").alias("kb")), "b")
    sides = sized(sides)
    hubs = sides.groupBy("b", "kb").agg(F.ceil(F.count(F.lit(1)) / SETS_A_TREE).cast("long").alias("trees"))
    blocked = sides.join(hubs.select("b", "trees"), "b").withColumn("tree", F.pmod(F.xxhash64("a"), "trees"))
    compared = blocked.select("b", "tree", F.lit(1).alias("role"), F.col("a").alias("name"), F.col("ka").alias("k"))
    trees = hubs.withColumn("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1)))
    asked = sized(compared.union(trees.select("b", "tree", F.lit(0).alias("role"), F.col("b").alias("name"), F.col("kb").alias("k"))))
    few = asked.count() <= BROADCAST_IDS
    rows = docs.join(F.broadcast(asked) if few else asked, "k").select("b", "tree", "role", "name", "t")
    rows = rows.repartition("b", "tree").sortWithinPartitions("b", "tree", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, keys, trie = None, None, Trie()
        a, b = [], []

        def close() -> None:
            if keys is not None:
                for name in trie.search(keys):
                    a.append(name)
                    b.append(group[0])

        for batch in batches:
            for hub, tree, role, name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (hub, tree) != group:
                    close()
                    group, keys, trie = (hub, tree), None, Trie()
                grams = ngrams(text)
                if set_name(grams) != name:  # another text under the same key
                    continue
                if role == 0:
                    keys = ordinal(grams, rank)
                else:
                    trie.add(ordinal(grams, rank), name)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return sized(rows.mapInArrow(compare, "a long, b long"))


def _not_ruled_out(pairs: DataFrame, about: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sketches are not too far apart."""
    sides = pairs
    for x in "ab":
        sides = sides.join(about.select(F.col("name").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"sketch_{x}")), x)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("sketch_a", "sketch_b"))
            n, m = (batch.column(c).to_numpy() for c in ("na", "nb"))
            places = np.arange(len(a))
            near = distances([*a, *b], places, places + len(a)) <= most_apart(n, m) if len(a) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(near)) for c in "ab"], ["a", "b"])

    return sides.select("a", "b", "na", "nb", "sketch_a", "sketch_b").mapInArrow(keep, "a long, b long")


def likeliest(rows: pa.Table, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each set in whole groups (gram, lo, hi), up to ``most`` sets of other roots that no bound rules out,
    nearest sketches first, as pairs of names; and the n-grams that hold a pair that was left out."""
    gram, lo, hi, own, name, root, n, at = (rows.column(c).to_numpy() for c in ("gram", "lo", "hi", "own", "name", "root", "n", "at"))
    new = np.flatnonzero((gram[1:] != gram[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
    bounds = np.concatenate([[0], new, [len(gram)]])
    ends = np.repeat(bounds[1:], np.diff(bounds))
    names, first, which = np.unique(name, return_index=True, return_inverse=True)
    codes, behind = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in row_pairs(np.arange(len(gram)), ends, PAIRS_AT_ONCE):
        open_ = (root[i] != root[j]) & ((lo[i] == hi[i]) | (own[i] != own[j]))
        i, j = i[open_], j[open_]
        bound = np.minimum(at[i], at[j]) + 1 + np.minimum(n[i] - at[i], n[j] - at[j]) - 1
        possible = reaches(bound, n[i], n[j])
        a, b = which[i[possible]], which[j[possible]]
        own_codes, places = np.unique(np.minimum(a, b) * len(names) + np.maximum(a, b), return_index=True)
        codes.append(own_codes)
        behind.append(gram[i[possible]][places])  # one n-gram of each pair
    code, places = np.unique(np.concatenate(codes), return_index=True)
    shared = np.concatenate(behind)[places]
    tried = []
    for u, others in enumerate(rows.column("failed").take(pa.array(first)).to_pylist()):
        if others:
            places = np.minimum(np.searchsorted(names, others), len(names) - 1)
            places = places[names[places] == np.array(others)]
            tried.append(np.minimum(u, places) * len(names) + np.maximum(u, places))
    if tried:
        untried = ~np.isin(code, np.concatenate(tried))
        code, shared = code[untried], shared[untried]
    a, b = np.divmod(code, len(names))
    sizes = n[first]
    far = distances(rows.column("sketch").take(pa.array(first)).to_pylist(), a, b)
    near = far <= most_apart(sizes[a], sizes[b])
    a, b, far, shared = a[near], b[near], far[near], shared[near]
    x, y, pair = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((y, np.tile(far, 2), x))
    x, pair = x[order], pair[order]
    starts = np.searchsorted(x, x, side="left")
    chosen = np.unique(pair[np.arange(len(x)) - starts < most])
    return names[a[chosen]], names[b[chosen]], np.unique(np.delete(shared, chosen))


def _likeliest(members: DataFrame, most: int) -> DataFrame:
    """(a, b): the pairs chosen in each task; and n-grams with pairs left out, as a, without b."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chosen(rows: pa.Table) -> pa.RecordBatch:
            a, b, more = likeliest(rows, most)
            sides = [pa.array(np.concatenate([a, more]), pa.int64()), pa.concat_arrays([pa.array(b, pa.int64()), pa.nulls(len(more), pa.int64())])]
            return pa.RecordBatch.from_arrays(sides, ["a", "b"])

        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(x.num_rows for x in waiting) < ROWS_A_CHUNK:
                continue
            rows = pa.Table.from_batches(waiting)
            last = np.ones(rows.num_rows, bool)  # the group that the batch ends in may go on
            for c in ("gram", "lo", "hi"):
                values = rows.column(c).to_numpy()
                last &= values == values[-1]
            cut_at = int(np.argmax(last))
            if cut_at:
                yield chosen(rows.slice(0, cut_at))
            waiting = rows.slice(cut_at).to_batches()
        if waiting and (rows := pa.Table.from_batches(waiting)).num_rows:
            yield chosen(rows)

    keys = ["gram", "lo", "hi"]
    dealt = members.select(*keys, "own", "name", "root", "n", "at", "sketch", "failed").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(search, "a long, b long").distinct()


def join_ngrams(df: DataFrame, key: str, text: str, mark: str | None = None) -> DataFrame:
    """Key, ``n_ngrams`` (size of the set) and ``component`` (smallest key reachable by links) of every row.

    With ``mark``, the name of an integer column, also that column and ``class``, a name of the row's
    component: rows that repeat a key are told apart by it. The class is null without words.

    Documents link when their sets reach the threshold. Texts without words (null, empty, only white
    space) have the empty set and link with nothing: their component is their own key. Rows that
    repeat a key are listed as often as they occur, each with its own text's component. A row with a
    null key gets the component of an equal set under another key, else null. Keys are integers. Columns that are not named are not read; an empty
    table gives no rows.
    """
    docs = df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    own = F.col(mark).cast("long") if mark else F.lit(None).cast("long")
    described = cut(_described(df.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"), own.alias("mark"))))
    sets = described.filter("bits is null").select("k", "n", "name", "mark")
    sketches = described.filter("sketch is not null").select("name", "n", "sketch").dropDuplicates(["name"])
    # At most 65536 counts, whatever the corpus.
    times = np.zeros(1 << 16, np.int64)
    for r in described.filter("bits is not null").groupBy("bits").agg(F.sum("times").alias("times")).collect():
        times[r["bits"]] = r["times"]
    rank = np.empty(1 << 16, np.uint32)
    rank[np.argsort(times, kind="stable")] = np.arange(1 << 16, dtype=np.uint32)
    salts = 1 + times // ROWS_A_GROUP
    ids = sized(sets.filter("n > 0 and k is not null").groupBy("name").agg(F.min("k").alias("k")))

    # One exchange by n-gram; it holds no set twice within a task and is read once.
    rows = _prefixes(docs.filter("k is not null"), rank, salts).repartition("gram", "salt")
    group = Window.partitionBy("gram", "salt")
    rows = rows.withColumns({"lo": F.min("name").over(group), "hi": F.max("name").over(group)})
    shared = stored(rows.filter("lo <> hi or salt >= 0").select("gram", "salt", "name", "n", "at").distinct().drop("salt"))
    roots = _linked(docs, shared, ids, sketches, rank)

    whole = ids.join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    smallest = whole.groupBy("root").agg(F.min("k").alias("component"))
    named = whole.select("name", "root").join(smallest, "root").select("name", "root", "component")
    return sets.join(named, "name", "left").select(
        F.col("k").alias(key),
        F.col("n").alias("n_ngrams"),
        F.when(F.col("n") == 0, F.col("k")).otherwise(F.col("component")).alias("component"),
        *([F.col("mark").alias(mark), F.when(F.col("n") > 0, F.col("root")).alias("class")] if mark else []),
    )


def _linked(docs: DataFrame, shared: DataFrame, ids: DataFrame, sketches: DataFrame, rank: np.ndarray) -> DataFrame:
    """(name, root) of all sets that link with another one."""
    spark = docs.sparkSession
    found = failed = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "name long, root long")
    if shared.count() <= ROWS_A_TASK:
        shared = shared.coalesce(1)
    about = stored(shared.select("name").distinct().join(sketches, "name"))
    # One set behind each n-gram explains most others.
    hub = F.min_by(F.struct("name", "n", "at"), F.xxhash64("name")).alias("hub")
    hubs = shared.groupBy("gram").agg(hub).select("gram", "hub.*")
    met = shared.alias("x").join(hubs.alias("y"), "gram").filter((F.col("x.name") != F.col("y.name")) & _possible("x", "y"))
    pairs = met.select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct()
    pairs = sized(_not_ruled_out(pairs, about))
    most, more = LIKELIEST, None
    while True:
        if not pairs.isEmpty():
            linked = _compared(docs, pairs, ids, rank)
            found, failed = found.union(linked), failed.union(pairs.join(linked, ["a", "b"], "left_anti"))
            roots = components(found).select(F.col("node").alias("name"), F.col("component").alias("root"))
        if more is not None:
            if more.isEmpty():
                return roots
            shared = stored(shared.join(more, "gram", "left_semi"))
        rooted = shared.join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
        # N-grams behind which all sets are linked already need no further look.
        mixed = rooted.groupBy("gram").agg(F.min("root").alias("least"), F.max("root").alias("greatest"), F.count(F.lit(1)).alias("rows"))
        mixed = cut(mixed.filter("least <> greatest").select("gram", F.ceil(F.col("rows") / ROWS_A_BLOCK).cast("int").alias("blocks")))
        both = failed.union(failed.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tried = both.groupBy(F.col("a").alias("name")).agg(F.collect_set("b").alias("failed"))
        members = rooted.join(mixed, "gram").join(about.select("name", "sketch"), "name").join(tried, "name", "left")
        own = F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        blocked = members.withColumn("own", own).withColumn("other", other)
        chosen = sized(_likeliest(blocked.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")}), most))
        pairs, more = chosen.filter("b is not null"), chosen.filter("b is null").select(F.col("a").alias("gram"))
        most *= MORE
