"""Spelling variants: words one edit apart, found in dense tiles by common prefix and suffix.

1. Two words are one edit apart exactly if their common prefix and common suffix together reach the
   longer length minus one. The edit then stands at the end of the common prefix.
2. The places of the longer word are cut into SEGMENTS segments. In the segment that holds the edit,
   both words agree on all that stands before and behind it, so they meet in the tile of (longer
   length, segment, what stands around the segment), and a pair is found in no other tile.
3. A tile's words are rows of two padded code-point matrices, aligned left and right. Blocks of row
   pairs are compared at once.
4. Tiles of more than ``rows_a_tile`` words are cut into tiles of single places, each of which holds no
   more words than there are letters, and one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.llm.common import cut, row_pairs, stored

#: Letters of words; only A-Z are lower-cased.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_TIMES = 2
#: A word's form is at least so many times as frequent.
FORM_TIMES = 10
#: One word in so many, by checksum, is taken without one of its letters.
DROP_EVERY = 31
SEGMENTS = 3
ROWS_A_TILE = 2048
#: Cells of the matrices that are compared at once.
CELLS_AT_ONCE = 4_000_000
#: Tiles that may be broadcast to be cut further; more are joined by shuffle.
BROADCAST_TILES = 100_000


def words(df: DataFrame, key: str, text: str) -> DataFrame:
    """(word, n): the words of all texts and how often they occur.

    A run whose checksum with the key is divisible by DROP_EVERY loses one letter. Runs too short to
    give a word are left out by the search itself.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))
    run = F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    each = df.select(F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("k"), F.explode(runs).alias("run")).select("k", run.alias("run"))
    hashed = each.select("run", F.crc32(F.encode(F.concat("k", F.lit(":"), "run"), "UTF-8")).alias("h"))
    place = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    word = F.when(F.col("h") % DROP_EVERY == 0, shorter).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") >= LEAST_TIMES) & (F.length("word") >= LEAST_LENGTH))


def _around(b: Column, lo: Column, hi: Column) -> Column:
    """What stands before place ``lo`` and, counted from the end, behind place ``hi`` of a word in tiles of length ``b``."""
    behind = b - hi
    end = F.substring(F.col("word"), F.length("word") - behind + 1, behind)
    return F.concat(F.substring(F.col("word"), F.lit(1), lo), F.lit("|"), F.when(behind > 0, end).otherwise(""))


def _tiles(counted: DataFrame, rows_a_tile: int) -> DataFrame:
    """(b, lo, hi, key, word, n): every word in its tiles, as one of length b or one shorter."""
    size = F.length("word")
    segments = []
    for b in (size, size + 1):
        for j in range(SEGMENTS):
            lo, hi = (F.floor(b * x / SEGMENTS).cast("int") for x in (j, j + 1))
            segments.append(F.struct(b.alias("b"), lo.alias("lo"), hi.alias("hi")))
    each = counted.select("word", "n", F.explode(F.array(*segments)).alias("x")).select("x.*", "word", "n")
    tiled = each.withColumn("key", _around(F.col("b"), F.col("lo"), F.col("hi")))
    tile = ["b", "lo", "hi", "key"]
    large = cut(tiled.groupBy(*tile).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > rows_a_tile).select(*tile))
    n_large = large.count()
    if not n_large:
        return tiled
    large = F.broadcast(large) if n_large <= BROADCAST_TILES else large
    places = F.explode(F.sequence(F.col("lo"), F.col("hi") - 1))
    single = tiled.join(large, tile, "left_semi").withColumn("lo", places).withColumn("hi", F.col("lo") + 1)
    single = single.withColumn("key", _around(F.col("b"), F.col("lo"), F.col("hi")))
    return tiled.join(large, tile, "left_anti").unionByName(single)


def _matrices(rows: list[bytes], b: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Places lo to hi - 1 of words of length b or b - 1, aligned left and right, padded with zeros."""
    left = b"".join(w[lo:hi].ljust(hi - lo, b"\0") for w in rows)
    right = b"".join(w.rjust(b, b"\0")[lo:hi] for w in rows)
    return tuple(np.frombuffer(x, np.uint8).reshape(len(rows), hi - lo) for x in (left, right))


def _near(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j, which agree around the segment, differ by one edit inside it.

    The common prefix must end inside the segment, and prefix and suffix together cover all its
    places but one.
    """
    width = left.shape[1]
    same = left[i] == left[j]
    prefix = np.where(same.all(axis=1), width, same.argmin(axis=1))
    same = (right[i] == right[j])[:, ::-1]
    suffix = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return (prefix < width) & (prefix + suffix >= width - 1)


def compare(tile: tuple[int, int, int], keys: list[str], rows: list[bytes], n: np.ndarray) -> list[tuple[str, int, int, str]]:
    """(word, near words, n and name of the most frequent one) from whole tiles of one length and segment, sorted by key."""
    b, lo, hi = tile
    left, right = _matrices(rows, b, lo, hi)
    longer = np.fromiter((len(w) == b for w in rows), bool, len(rows))
    change = np.flatnonzero([x != y for x, y in zip(keys, keys[1:], strict=False)]) + 1
    bounds = np.concatenate([[0], change, [len(rows)]]).astype(np.int64)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    found = []
    for i, j in row_pairs(np.arange(len(rows)), ends, max(1, CELLS_AT_ONCE // (hi - lo))):
        near = _near(left, right, i, j) & (longer[i] | longer[j])
        found.append((i[near], j[near]))
    if not found:
        return []
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    a, other = np.concatenate([i, j]), np.concatenate([j, i])
    if not len(a):
        return []
    place = np.empty(len(rows), np.int64)
    place[sorted(range(len(rows)), key=rows.__getitem__)] = np.arange(len(rows))
    best = np.lexsort((place[other], -n[other], a))
    a, other = a[best], other[best]
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    times = np.diff(np.concatenate([first, [len(a)]]))
    return [(rows[x].decode("latin-1"), int(c), int(n[y]), rows[y].decode("latin-1")) for x, y, c in zip(a[first], other[first], times, strict=True)]


_FOUND = "word string, n_near long, best_n long, best string"


def _found(tiled: DataFrame, rows_a_tile: int) -> DataFrame:
    """What each tile says about its words."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, keys, rows, n = None, [], [], []

        def table(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found, strict=True) if found else ([], [], [], [])
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "n_near", "best_n", "best"])

        for batch in batches:
            # Compare what came before; the tile that the last batch ended in may go on.
            if len(rows) >= rows_a_tile:
                cut_at = len(keys)
                while cut_at and keys[cut_at - 1] == keys[-1]:
                    cut_at -= 1
                if cut_at:
                    yield table(compare(tile, keys[:cut_at], rows[:cut_at], np.array(n[:cut_at], np.int64)))
                    keys, rows, n = keys[cut_at:], rows[cut_at:], n[cut_at:]
            for b, lo, hi, key, word, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (b, lo, hi) != tile:
                    if rows:
                        yield table(compare(tile, keys, rows, np.array(n, np.int64)))
                    tile, keys, rows, n = (b, lo, hi), [], [], []
                keys.append(key)
                rows.append(word.encode("latin-1"))
                n.append(times)
        if rows:
            yield table(compare(tile, keys, rows, np.array(n, np.int64)))

    order = ["b", "lo", "hi", "key"]
    dealt = tiled.select(*order, "word", "n").repartition(*order).sortWithinPartitions(*order)
    return dealt.mapInArrow(search, _FOUND)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms ends; pointers double, and a chain grows tenfold with each step."""
    roots = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = cut(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        roots = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return roots


def group_variants(df: DataFrame, key: str, text: str, rows_a_tile: int = ROWS_A_TILE) -> DataFrame:
    """Every word with its frequency, its number of near words, its form and its root.

    A word's form is its most frequent near word (of equal ones the smallest) if that is FORM_TIMES as
    frequent, else null with a null ``form_n``. The root is where the chain of forms ends, the word
    itself if it has no form. Null texts have no words; a null key counts as the word null; repeated
    rows count each; words may have any length. Other columns are not read; a table without words
    gives no rows.
    """
    counted = stored(words(df, key, text))
    near = _found(_tiles(counted, rows_a_tile), rows_a_tile).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best"))).alias("best"))
    joined = counted.join(near, "word", "left").withColumn("form_n", -F.col("best.n"))
    is_form = F.col("form_n") >= FORM_TIMES * F.col("n")
    formed = stored(
        joined.select(
            "word",
            F.when(is_form, F.col("best.best")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(is_form, F.col("form_n")).alias("form_n"),
        )
    )
    roots = _roots(formed.filter("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
