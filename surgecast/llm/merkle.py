"""Document fingerprints: Merkle trees over sections, paragraphs and pieces.

A paragraph is a line. A section is a run of paragraphs and a piece a run of words within one; both
end where the content says so (a hash of the last paragraph or word), so an edit moves no boundary
beyond its own neighbourhood. The root names the whole text: it is equal exactly for equal texts.
Two trees are compared from the top: equal nodes are alike with all below them, and only what is left
is opened, which locates the differences and weighs them by characters.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgecast.llm.common import cut

#: One in so many words ends a piece, and one in so many paragraphs a section.
WORDS_A_PIECE, PARAGRAPHS_A_SECTION = 4, 4
#: Rows whose order is worked out in one group, on average.
ROWS_A_BLOCK = 512
#: Keys that may be broadcast.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True, slots=True)
class Branch:
    digest: bytes
    size: int  # code points, with those that end the part
    below: tuple[Branch, ...] = ()


def _digest(kind: bytes, data: bytes) -> bytes:
    return blake2b(data, digest_size=16, person=kind).digest()


def _join(kind: bytes, below: list[Branch]) -> Branch:
    return Branch(_digest(kind, b"".join([b.digest for b in below])), sum([b.size for b in below]), tuple(below))


def _paragraph(line: str) -> Branch:
    pieces, start, words = [], 0, line.split(" ")
    for i, w in enumerate(words, 1):
        if zlib.crc32(w.encode()) % WORDS_A_PIECE == 0 or i == len(words):
            piece = " ".join(words[start:i])
            pieces.append(Branch(_digest(b"piece", piece.encode()), len(piece) + 1))
            start = i
    return _join(b"paragraph", pieces)


def tree(text: str, known: dict[str, Branch] | None = None) -> Branch:
    """The tree of a text. ``known``: paragraphs already built, which are added to."""
    known = {} if known is None else known
    sections, paragraphs = [], []
    for line in text.split("\n"):
        node = known.get(line)
        if node is None:
            node = known[line] = _paragraph(line)
        paragraphs.append(node)
        if node.digest[0] % PARAGRAPHS_A_SECTION == 0:
            sections.append(_join(b"section", paragraphs))
            paragraphs = []
    if paragraphs:
        sections.append(_join(b"section", paragraphs))
    return _join(b"document", sections)


def _unmatched(a: list[tuple[int, Branch]], b: list[Branch]) -> tuple[int, list[tuple[int, Branch]], list[Branch]]:
    """Size of the nodes that both lists hold, and what is left of either."""
    have = Counter([n.digest for n in b])
    common, left = 0, []
    for at, n in a:
        if have[n.digest] > 0:
            have[n.digest] -= 1
            common += n.size
        else:
            left.append((at, n))
    rest = []
    for n in reversed(b):
        if have[n.digest] > 0:
            have[n.digest] -= 1
            rest.append(n)
    return common, left, rest


def _open(nodes: list[tuple[int, Branch]]) -> list[tuple[int, Branch]]:
    out = []
    for at, n in nodes:
        for b in n.below:
            out.append((at, b))
            at += b.size
    return out


def compare(a: Branch, b: Branch) -> tuple[float, list[tuple[int, int]]]:
    """Likeness of two trees, 0 to 1, and where the first differs: ranges of code points.

    Likeness is the share of characters, of both texts, in nodes that both hold at the same level. Texts whose
    pieces are all alike but end otherwise, as a blank and a line end, differ in one character at least.
    """
    if a.digest == b.digest:
        return 1.0, []
    common, left, rest = 0, [(0, a)], [b]
    for _ in range(3):
        found, left, rest = _unmatched(_open(left), [n for _, n in _open([(0, r) for r in rest])])
        common += found
    spans: list[tuple[int, int]] = []
    for at, n in left:
        if spans and spans[-1][1] >= at:
            spans[-1] = (spans[-1][0], at + n.size)
        else:
            spans.append((at, at + n.size))
    return min(2 * common, a.size + b.size - 1) / (a.size + b.size), spans


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, next): every row with the text of the next one by ascending key, after the last the first.

    Null texts are empty. Rows that repeat a key follow each other by text. Rows with a null key
    have no next text and are none. The texts are shuffled once, into blocks of neighbouring keys;
    the first text of each block is carried to the one before.
    """
    rows = df.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    about = rows.agg(F.count("k").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")).first()
    width = max(1, math.ceil((about["hi"] - about["lo"] + 1) / about["n"] * ROWS_A_BLOCK)) if about["n"] else 1
    width = min(width, 2**62)
    block, wider = F.expr(f"k div {width}L"), F.expr("block div 4096L")
    keyed = rows.filter("k is not null").withColumn("block", block)
    firsts = keyed.groupBy("block").agg(F.min("k").alias("first")).withColumn("wider", wider)
    # The next block's first key: within 4096 blocks, else that of the next 4096, else the very first.
    inner = firsts.withColumn("after", F.lead("first").over(Window.partitionBy("wider").orderBy("block")))
    outer = firsts.groupBy("wider").agg(F.min("first").alias("opening"))
    outer = outer.select("wider", F.lead("opening").over(Window.partitionBy(F.lit(0)).orderBy("wider")).alias("later"))
    follow = cut(inner.join(outer, "wider").select("block", "first", F.coalesce("after", "later", F.lit(about["lo"])).alias("after")))
    heads = follow.select(F.col("first").alias("k"))
    heads = keyed.join(F.broadcast(heads) if follow.count() <= BROADCAST_KEYS else heads, "k", "left_semi")
    heads = heads.groupBy(F.col("k").alias("after")).agg(F.min("t").alias("head"))
    follow = follow.join(heads, "after").select("block", "head")
    order = Window.partitionBy("block").orderBy("k", "t")
    inside = keyed.withColumn("inside", F.lead("t").over(order)).join(follow, "block")
    inside = inside.select("k", "t", F.coalesce("inside", "head").alias("next"))
    return inside.unionByName(rows.filter("k is null").withColumn("next", F.lit(None).cast("string")))


def edited(text: str, following: str | None) -> str:
    """The text with its last quarter (rounded down) replaced by as much of the next text's beginning."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + (following or "")[:quarter]


_RESULT = "k long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edit_spans string"


def fingerprint_documents(df: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprint of every row's text and of its edited text, and how alike they are.

    Columns: key, n_chars, edited_sha256, fingerprint, edited_fingerprint (roots, hex), near_edited,
    near_next (likeness to the edited and the next text), edit_spans (start:end ranges of the text that the
    edited one lacks). Null texts are empty; an empty text's edited text is empty and like itself. A
    row without key has no next text: its edited text only loses its end, near_next is 0. The only
    row is its own next. Keys are integers; other columns are not read; an empty table gives no rows.
    """

    def fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_text, last_tree = None, None
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                rows = []
                for k, t, n in zip(*(c.to_pylist() for c in whole.slice(start, 500).columns), strict=True):
                    known: dict[str, Branch] = {}
                    own = last_tree if t == last_text else tree(t, known)
                    other = edited(t, n)
                    changed = tree(other, known)
                    following = tree(n, known) if n is not None else None
                    near, spans = compare(own, changed)
                    rows.append((
                        k, len(t), sha256(other.encode()).hexdigest(), own.digest.hex(), changed.digest.hex(), near,
                        compare(own, following)[0] if following else 0.0, ",".join([f"{a}:{min(b, len(t))}" for a, b in spans]),
                    ))
                    last_text, last_tree = n, following
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]
                columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
                names = [x.split(" ")[0] for x in _RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

    return with_next(df, key, text).mapInArrow(fingerprints, _RESULT).withColumnRenamed("k", key)
