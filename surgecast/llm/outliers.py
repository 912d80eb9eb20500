"""Quality rules by robust multivariate outliers, in column expressions.

1. Every text gives counts of words, symbols, repeated lines and repeated passages. Fixed rules reject
   on them first.
2. The counts become a vector of five logarithms in whole steps of 1 / SCALE, so that sums are exact
   whatever the order of rows.
3. Vectors of a language and source are one cell (small sources of a language are pooled). In each
   cell the minimum covariance determinant is sought: from several starts, a part CORE of the rows with
   the least distances gives mean and covariance, which give new distances, STEPS times; the start
   that ends with the least determinant stays. One more step takes all rows within REWEIGHT.
4. Rows are rejected whose squared Mahalanobis distance exceeds CUTOFF.

Rows are never ordered: distances fall into classes, whose counts and sums are aggregated before any
shuffle, and a subset is all classes up to one. A cell with a third of all rows is no group of any task.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgecast.llm.common import cut, stored

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
#: More repeated words than this percentage are rejected.
MOST_REPEATED = 30

FEATURES = 5
SCALE = 1024
#: Least standard deviation of each feature in a cell, in natural logarithms.
FLOORS = (0.1, 0.03, 0.3, 0.35, 0.35)
#: Part of a cell that the estimate is made of, and what its covariance is multiplied by (for normal data in five dimensions).
CORE, CONSISTENCY = 0.75, 1.41
STEPS = 4
#: 97.5 % quantile of chi-square with five degrees of freedom.
REWEIGHT = 12.83
CUTOFF = 50.0
#: Rows below which a source is pooled, and a pool has no verdict.
LEAST_ROWS = 30
#: Distance classes a unit, and classes in all.
CLASSES, MOST_CLASSES = 32, 2048
#: Cells whose estimates may be broadcast; more are joined by shuffle.
BROADCAST_CELLS = 50_000

_X = [f"x{i}" for i in range(FEATURES)]
_CELL = ["lang_key", "source_key"]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_words(text: Column) -> Column:
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE + "+", -1))


def repeated_words(words: Column) -> Column:
    """Words in windows of WINDOW words that the text has at least twice, windows compared by 64-bit hash.

    Hashes are sorted with their places, so the cost is that of sorting, whatever repeats.
    """
    last = F.size(words) - (WINDOW - 1)

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, i: F.least(F.coalesce(F.get(starts, i + 1) - s, F.lit(WINDOW)), F.lit(WINDOW)).cast("long"))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)

    def again(pairs: Column) -> Column:
        twice = F.transform(pairs, lambda x, i: F.when((F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]), x["i"]))
        return _let(F.sort_array(F.array_compact(twice)), covered)

    def counted(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(_let(pairs, again))

    windows = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(last >= 2, _let(windows, counted)).otherwise(F.lit(0).cast("long"))


def with_statistics(df: DataFrame, text: str) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_lines (those with a word)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    whole = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    of_words = _let(split_words(body), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words")))
    symbols = F.length(body) - F.length(F.translate(body, SYMBOLS, ""))
    word_chars = F.length(F.translate(body, " \t\n\x0b\x0c\r", ""))
    found = df.withColumns({"__words": of_words, "__lines": whole, "n_symbols": symbols.cast("long"), "word_chars": word_chars.cast("long")})
    return found.withColumns({n: F.col(f"{s}.{n}") for s, n in (("__words", "n_words"), ("__words", "n_repeat_words"), ("__lines", "n_lines"), ("__lines", "n_dup_lines"))}).drop("__words", "__lines")


def vector() -> dict[str, Column]:
    """The features, as whole numbers, of a row with statistics and at least one word."""
    n = F.col("n_words")
    logs = [
        F.log(n.cast("double")),
        F.log(F.col("word_chars") / n),
        F.log(1 + 100 * F.col("n_symbols") / n),
        F.log(1 + 10 * F.col("n_dup_lines") / F.col("n_lines")),
        F.log(1 + 10 * F.col("n_repeat_words") / n),
    ]
    return {x: F.floor(v * SCALE + 0.5).cast("long") for x, v in zip(_X, logs, strict=True)}


# --- estimates --------------------------------------------------------------------------------


def _small(df: DataFrame) -> DataFrame:
    """``df`` computed once, marked for broadcast if its counted rows are few."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_CELLS else kept


def _median(counts: DataFrame, value: str, name: str) -> DataFrame:
    """The smallest value up to which half of the rows of each cell and feature lie; ``counts`` has one row a value."""
    by = [*_CELL, "feature"]
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("n").over(Window.partitionBy(*by))
    return counts.withColumn("enough", 2 * upto >= whole).filter("enough").groupBy(*by).agg(F.min(value).alias(name))


def _centres(rows: DataFrame) -> DataFrame:
    """(cell.., m0.., s0..): median and scale of every feature; at most one row a value is gathered, not one a row."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("feature"), F.col(x).alias("value")) for i, x in enumerate(_X)))).alias("f")
    counts = cut(rows.select(*_CELL, each).select(*_CELL, "f.*").groupBy(*_CELL, "feature", "value").agg(F.count(F.lit(1)).alias("n")))
    middle = _median(counts, "value", "m")
    off = counts.join(middle, [*_CELL, "feature"]).withColumn("off", F.abs(F.col("value") - F.col("m")))
    spread = _median(off.groupBy(*_CELL, "feature", "off").agg(F.sum("n").alias("n")), "off", "off")
    floors = F.array(*(F.lit(x * SCALE) for x in FLOORS))
    both = middle.join(spread, [*_CELL, "feature"]).withColumn("s", F.greatest(F.col("off") * 1.4826, F.get(floors, F.col("feature"))))
    return both.groupBy(*_CELL).agg(*(F.max(F.when(F.col("feature") == i, F.col(c).cast("double"))).alias(f"{c}{i}") for c in "ms" for i in range(FEATURES)))


def _class(distance: Column) -> Column:
    return F.least(F.floor(distance * CLASSES), F.lit(MOST_CLASSES - 1)).cast("int")


def _starts(rows: DataFrame, centres: DataFrame) -> DataFrame:
    """(cell.., x.., start, class): each row once a start, by its distance from the medians in three norms."""
    joined = rows.join(centres, _CELL)
    z = [F.abs(F.col(x).cast("double") - F.col(f"m{i}")) / F.col(f"s{i}") for i, x in enumerate(_X)]
    total = reduce(lambda a, b: a + b, z)
    square = reduce(lambda a, b: a + b, (x * x for x in z))
    norms = F.array(*(F.struct(F.lit(i).alias("start"), _class(d).alias("class")) for i, d in enumerate((F.sqrt(square), F.greatest(*z), total))))
    return joined.select(*_CELL, *_X, F.explode(norms).alias("s")).select(*_CELL, *_X, "s.*")


def _with_distance(rows: DataFrame, name: str, use: Callable[[Column], Column]) -> DataFrame:
    """``rows``, joined with estimates, with ``use`` of the squared distance; its parts are columns, computed once each."""
    kept = rows.columns
    for i, x in enumerate(_X):
        v = F.col(x).cast("double") - F.col(f"m{i}")
        for j in range(i):
            v = v - F.col(f"l{i}{j}") * F.col(f"__y{j}")
        rows = rows.withColumn(f"__y{i}", v)
    total = F.lit(0.0)
    for i in range(FEATURES):
        total = total + F.col(f"__y{i}") * F.col(f"__y{i}") / F.col(f"d{i}")
    return rows.select(*kept, use(total).alias(name))


def _sums() -> list[Column]:
    pairs = [(i, j) for i in range(FEATURES) for j in range(i + 1)]
    return [F.sum(x).alias(f"t{i}") for i, x in enumerate(_X)] + [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"t{i}{j}") for i, j in pairs]


def _added() -> list[Column]:
    names = [f"t{i}" for i in range(FEATURES)] + [f"t{i}{j}" for i in range(FEATURES) for j in range(i + 1)]
    return [F.sum(c).alias(c) for c in ("n", *names)]


def _estimate(sums: DataFrame, by: list[str], factor: float) -> DataFrame:
    """(by.., m.., l.., d.., det): mean and the factors of covariance = L D L', from counts and sums."""
    out = sums.withColumns({f"m{i}": F.col(f"t{i}") / F.col("n") for i in range(FEATURES)})
    less = F.greatest(F.col("n") - 1, F.lit(1)).cast("double")
    covariance = {}
    for i in range(FEATURES):
        for j in range(i + 1):
            c = (F.col(f"t{i}{j}").cast("double") - F.col(f"m{i}") * F.col(f"t{j}").cast("double")) / less * factor
            covariance[f"c{i}{j}"] = c + (FLOORS[i] * SCALE) ** 2 if i == j else c
    out = out.withColumns(covariance)
    for j in range(FEATURES):
        d = F.col(f"c{j}{j}")
        for k in range(j):
            d = d - F.col(f"l{j}{k}") * F.col(f"l{j}{k}") * F.col(f"d{k}")
        # Rounding can leave less than the floor of a feature that others explain.
        out = out.withColumn(f"d{j}", F.greatest(d, F.lit(1.0)))
        for i in range(j + 1, FEATURES):
            v = F.col(f"c{i}{j}")
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}") * F.col(f"d{k}")
            out = out.withColumn(f"l{i}{j}", v / F.col(f"d{j}"))
    det = reduce(lambda a, b: a * b, (F.col(f"d{i}") for i in range(FEATURES)))
    kept = [f"m{i}" for i in range(FEATURES)] + [f"d{i}" for i in range(FEATURES)] + [f"l{i}{j}" for i in range(FEATURES) for j in range(i)]
    return out.select(*by, *kept, det.alias("det"))


def _core(classed: DataFrame) -> DataFrame:
    """The estimate of each cell and start from the classes up to the one in which the CORE is complete."""
    by = [*_CELL, "start"]
    sums = classed.groupBy(*by, "class").agg(F.count(F.lit(1)).alias("n"), *_sums())
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy("class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = sums.withColumns({"before": before, "whole": F.sum("n").over(Window.partitionBy(*by))}).filter(F.col("before") < F.col("whole") * CORE)
    return _small(_estimate(within.groupBy(*by).agg(*_added()), by, CONSISTENCY))


def estimates(rows: DataFrame) -> DataFrame:
    """Mean and covariance factors of every cell. ``rows``: lang_key, source_key and the features."""
    of_start = _core(_starts(rows, _small(_centres(rows))))
    for _ in range(STEPS):
        classed = _with_distance(rows.join(of_start, _CELL), "class", lambda d: _class(F.sqrt(d)))
        of_start = _core(classed)
    least = Window.partitionBy(*_CELL).orderBy("det", "start")
    best = _small(of_start.withColumn("rank", F.row_number().over(least)).filter("rank = 1").drop("rank", "start"))
    near = _with_distance(rows.join(best, _CELL), "square", lambda d: d).filter(F.col("square") <= REWEIGHT)
    sums = near.groupBy(*_CELL).agg(F.count(F.lit(1)).alias("n"), *_sums())
    return _small(_estimate(sums, _CELL, 1.0))


def judge_documents(df: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """The statistics of every row's text, base_failed and kept.

    Columns: the key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
    kept, and square (the squared distance; null where base_failed or without estimate). A null text
    is empty and fails; null languages and sources are values like any other; rows of pools of fewer
    than LEAST_ROWS rows are kept unless they fail; repeated rows count each. Other columns are not
    read; an empty table gives no rows. Texts are read once; what follows works on their statistics.
    """

    def part(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))

    found = with_statistics(df.select(F.col(key).alias("k"), F.col(text).alias("t"), part(lang).alias("lang_key"), part(source).alias("own_source")), "t").drop("t")
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    found = stored(found.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeated))
    good = found.filter(~F.col("base_failed"))
    of_source = good.groupBy("lang_key", "own_source").agg(F.count(F.lit(1)).alias("rows"))
    keys = of_source.withColumn("source_key", F.when(F.col("rows") >= LEAST_ROWS, F.col("own_source")).otherwise("*"))
    enough = F.sum("rows").over(Window.partitionBy("lang_key", "source_key")) >= LEAST_ROWS
    keys = _small(keys.withColumn("enough", enough).select("lang_key", "own_source", "source_key", "enough"))
    celled = found.join(keys, ["lang_key", "own_source"], "left")
    judged = ~F.col("base_failed") & F.coalesce(F.col("enough"), F.lit(False))
    rows = cut(celled.filter(judged).select(*_CELL, *(c.alias(x) for x, c in vector().items())))
    final = estimates(rows)
    placed = celled.withColumns({x: F.when(judged, c) for x, c in vector().items()})
    placed = placed.withColumn("source_key", F.when(judged, F.col("source_key")))
    measured = _with_distance(placed.join(final, _CELL, "left"), "square", lambda d: d)
    return measured.select(
        F.col("k").alias(key),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "n_lines",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("square") <= CUTOFF, F.lit(True))).alias("kept"),
        "square",
    )
