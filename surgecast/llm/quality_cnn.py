"""Quality classifier: a convolutional network over the bytes of the whole text, in numpy.

Learned filters of WIDTH bytes slide over the text. Each filter is max-pooled over overlapping chunks
of two blocks, chunks become hidden units, and the strongest chunk of each unit decides: their
weighted sum is one probability. Training needs a bounded sample of labelled windows on the driver;
scoring runs where the rows are and holds a bounded piece of a text at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.llm.common import unit_bits

WIDTH, FILTERS, HIDDEN = 4, 16, 12
#: Bytes of a block; a chunk is two neighbouring blocks, so chunks overlap by half.
BLOCK = 64
#: Bytes convolved at once, a multiple of BLOCK.
PIECE = BLOCK * 2048


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and of the fit. ``rows``: labelled documents of each class,
    those with the smallest hashed keys; ``windows`` of ``WINDOW`` characters of each."""

    rows: int = 900
    windows: int = 3
    epochs: int = 10
    batch: int = 64
    rate: float = 0.01
    seed: int = 11


WINDOW = 1024


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    mix: np.ndarray  # FILTERS x HIDDEN
    mix_bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0  # the bias of the sum, with the classes' true shares
    constant: float | None = field(default=None)  # used where the labels hold no two classes

    def score(self, text: str | None) -> float:
        """P(label 1) of a whole text; null is scored as the empty text."""
        if self.constant is not None:
            return self.constant
        data = np.frombuffer((text or "").encode("utf-8").ljust(WIDTH, b"\0"), np.uint8)
        places = len(data) - WIDTH + 1
        top = None
        carry = None  # the last block of the piece before
        for at in range(0, places, PIECE):
            n = min(PIECE, places - at)
            sums = self.filters[0][data[at : at + n]]
            for j in range(1, WIDTH):
                sums += self.filters[j][data[at + j : at + j + n]]
            blocks = np.maximum.reduceat(sums, np.arange(0, n, BLOCK), axis=0)
            if carry is not None:
                blocks = np.concatenate([carry, blocks])
            carry = blocks[-1:]
            chunks = np.maximum(blocks[1:], blocks[:-1]) if len(blocks) > 1 else blocks
            hidden = (np.maximum(chunks + self.bias, 0) @ self.mix + self.mix_bias).max(axis=0)
            top = hidden if top is None else np.maximum(top, hidden)
        logit = float(np.maximum(top, 0) @ self.out) + self.shift
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def _constant(value: float) -> Network:
    z = np.zeros
    return Network(z((WIDTH, 256, FILTERS), np.float32), z(FILTERS), z((FILTERS, HIDDEN)), z(HIDDEN), z(HIDDEN), 0.0, value)


def fit(windows: list[str], labels: list[int], counts: tuple[int, int], how: Training) -> Network:
    """Adam on the log loss. ``counts``: labelled rows of class 0 and 1 in all, to which the
    probability is shifted from the sample's shares."""
    if not counts[0] or not counts[1] or len(set(labels)) < 2:
        return _constant(0.5 if not sum(counts) else (counts[1] + 1) / (sum(counts) + 2))
    rng = np.random.default_rng(how.seed)
    limit = WINDOW + WIDTH - 1
    raw = [w.encode("utf-8")[:limit] for w in windows]
    lengths = np.array([max(1, len(r) - WIDTH + 1) for r in raw])
    data = np.frombuffer(b"".join(r.ljust(limit, b"\0") for r in raw), np.uint8).reshape(-1, limit).astype(np.intp)
    y = np.array(labels, np.float32)
    share = y.mean()
    net = {
        "filters": rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "mix": rng.normal(0, FILTERS**-0.5, (FILTERS, HIDDEN)).astype(np.float32),
        "mix_bias": np.full(HIDDEN, 0.1, np.float32),
        "out": rng.normal(0, 0.5, HIDDEN).astype(np.float32),
        "shift": np.zeros(1, np.float32),
    }
    first, second = ({k: np.zeros_like(v) for k, v in net.items()} for _ in range(2))
    blocks = WINDOW // BLOCK
    step = 0
    for _ in range(how.epochs):
        order = rng.permutation(len(y))
        for start in range(0, len(y), how.batch):
            rows = order[start : start + how.batch]
            x, m = data[rows], len(rows)
            sums = net["filters"][0][x[:, :WINDOW]]
            for j in range(1, WIDTH):
                sums += net["filters"][j][x[:, j : j + WINDOW]]
            sums[np.arange(WINDOW)[None, :] >= lengths[rows][:, None]] = -1e9
            parts = sums.reshape(m, blocks, BLOCK, FILTERS)
            where = parts.argmax(axis=2) + (np.arange(blocks) * BLOCK)[None, :, None]
            high = parts.max(axis=2)
            later = high[:, 1:] > high[:, :-1]
            chunk = np.maximum(high[:, 1:], high[:, :-1])
            where = np.where(later, where[:, 1:], where[:, :-1])
            pooled = np.maximum(chunk + net["bias"], 0)
            hidden = pooled @ net["mix"] + net["mix_bias"]
            hidden[(chunk <= -1e8).all(axis=2)] = -1e9
            best = hidden.argmax(axis=1)  # m x HIDDEN
            top = np.maximum(hidden.max(axis=1), 0)
            miss = 1 / (1 + np.exp(-(top @ net["out"] + net["shift"][0]))) - y[rows]
            grad = {"out": top.T @ miss / m, "shift": np.array([miss.mean()])}
            down = (miss[:, None] * net["out"] * (top > 0)) / m  # m x HIDDEN
            doc = np.arange(m)[:, None]
            used = pooled[doc, best]  # m x HIDDEN x FILTERS
            grad["mix"] = np.einsum("mh,mhf->fh", down, used)
            grad["mix_bias"] = down.sum(axis=0)
            to_pool = down[:, :, None] * net["mix"].T[None] * (used > 0)
            grad["bias"] = to_pool.sum(axis=(0, 1))
            at = where[doc, best]  # m x HIDDEN x FILTERS
            grad["filters"] = np.zeros_like(net["filters"])
            for j in range(WIDTH):
                byte = x[np.arange(m)[:, None, None], np.minimum(at + j, limit - 1)]
                cell = byte * FILTERS + np.arange(FILTERS)
                grad["filters"][j] = np.bincount(cell.ravel(), to_pool.ravel(), 256 * FILTERS).reshape(256, FILTERS)
            step += 1
            for k, g in grad.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                net[k] -= (how.rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    prior = math.log(counts[1] / counts[0]) - math.log(share / (1 - share))
    return Network(net["filters"], net["bias"], net["mix"], net["mix_bias"], net["out"], float(net["shift"][0]) + prior)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from: one in five, by checksum of the key."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, how: Training = Training(), key: str = "doc_id", text: str = "text", label: str = "quality") -> Network:
    """Network fitted on the labelled rows that are not held out.

    Keys with contradicting labels count as the higher one; null keys, labels and texts are left out.
    Without labels every score is 0.5, with one class its smoothed share.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("y"))
    found = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    counts = (found.get(0, 0), found.get(1, 0))
    sample = known.filter("y = 0").orderBy(unit_bits(F.col("k")), "k").limit(how.rows)
    sample = sample.union(known.filter("y = 1").orderBy(unit_bits(F.col("k")), "k").limit(how.rows))
    # At most 2 * rows pairs of integers, so the texts need not be shuffled.
    picked = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(sample), "k").filter("t is not null")
    room = F.greatest(F.length("t") - WINDOW, F.lit(0)) + 1
    starts = F.array_distinct(F.array(*(F.pmod(unit_bits(F.col("k"), F.lit(f"window{i}")), room) for i in range(how.windows))))
    cut = picked.select("k", "y", F.explode(F.transform(starts, lambda s: F.substring(F.col("t"), s.cast("int") + 1, F.lit(WINDOW)))).alias("w"))
    rows = sorted((r["k"], r["w"], r["y"]) for r in cut.collect())
    return fit([r[1] for r in rows], [r[2] for r in rows], counts, how)


def scored(df: DataFrame, text: str, network: Network, to: str) -> DataFrame:
    """``df`` with the probability of label 1 in ``to``.

    The text is the only input: nulls score as empty texts, equal texts equally, texts of any length
    as a whole. All other columns pass through untouched; nothing is shuffled.
    """

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([network.score(t) for t in batch], dtype="float64")

    return df.withColumn(to, probability(F.col(text)))
