"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

Every prefix of a word has one encoding, and so one last token. A token that ends at a position is
that last token exactly if it is compatible with the last token of the prefix before it: the two
would stand next to each other unmerged. One automaton pass finds all tokens ending at each
position; back-pointers from the end of the word give the ids. The cost is linear in the length of
the word times the number of tokens ending at a position, whatever the number of merges.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A task keeps the encodings of so many words last met, and of as many before them; and the longest such word.
KEPT_WORDS = 100_000
KEPT_LENGTH = 64
#: Rows turned into ids at once.
ROWS_AT_ONCE = 500

_END = "￿"  # stands for the end-of-word mark in the automaton
# Fixed pattern of the vocabulary: contractions, letters, single digits, other signs.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return [chr(b) if b not in others else chr(256 + others.index(b)) for b in range(256)]


class WordBpe:
    """A word-end BPE vocabulary: lower case, white space dropped."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.ids: dict[str, int] = dict(model["vocab"])
        self.mark: str = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = byte_letters()
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        self.parts: dict[int, tuple[int, int, int] | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.kept: dict[str, tuple[int, ...]] = {}
        self.before: dict[str, tuple[int, ...]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            ends = token.endswith(self.mark) and len(token) > len(self.mark)
            body = token[: -len(self.mark)] if ends else token
            self.automaton.add_word(body + _END * ends, (i, len(body), ends))
        self.automaton.make_automaton()

    def symbols(self, token: str) -> list[int]:
        ends = token.endswith(self.mark) and len(token) > len(self.mark)
        body = list(token[: -len(self.mark)] if ends else token)
        if ends:
            body[-1] += self.mark
        return [self.ids[s] for s in body]

    def origin(self, token: int) -> tuple[int, int, int] | None:
        """(rank, left, right) of the merge that makes the token out of its own text; rank -1 for a
        single letter; None if its text is encoded otherwise, so that it never occurs."""
        if token not in self.parts:
            row, last = self.symbols(self.names[token]), (-1, token, token)
            while len(row) > 1:
                ranked = [(self.merges[p][0], i) for i, p in enumerate(zip(row, row[1:], strict=False)) if p in self.merges]
                if not ranked:
                    break
                rank, i = min(ranked)
                last = (rank, row[i], row[i + 1])
                row[i : i + 2] = [self.merges[row[i], row[i + 1]][1]]
            self.parts[token] = last if row == [token] else None
        return self.parts[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of both texts together is exactly these two tokens.

        Goes back in time: whichever of the two at the boundary was made last is taken apart. Their
        pair must not have been merged before that; of equal ranks the left pair goes first.
        """
        if (a, b) not in self.fits:
            x, y, until = a, b, len(self.merges)  # the pair may not merge at a rank below `until`
            while True:
                joined = self.merges.get((x, y))
                if joined and joined[0] < until:
                    self.fits[a, b] = False
                    break
                (made_x, _, right), (made_y, left, _) = self.origin(x), self.origin(y)
                if made_x < 0 and made_y < 0:
                    self.fits[a, b] = True
                    break
                if made_y >= made_x:
                    y, until = left, made_y + 1
                else:
                    x, until = right, made_x
        return self.fits[a, b]

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of one word of the pattern."""
        known = self.kept.get(word) or self.before.get(word)
        if known is not None:
            return self._keep(word, known)
        text = "".join([self.letters[b] for b in word.encode("utf-8")])
        n = len(text)
        last, back = [0] * (n + 1), [-1] * (n + 1)
        for end, (token, length, ends) in self.automaton.iter(text + _END):
            at = n if ends else end + 1
            if back[at] >= 0 or (at == n and not ends):
                continue
            before = at - length
            if self.origin(token) is not None and (before == 0 or (back[before] >= 0 and self.compatible(last[before], token))):
                last[at], back[at] = token, before
        ids, at = [], n
        while at > 0:
            ids.append(last[at])
            at = back[at]
        found = tuple(reversed(ids))
        return self._keep(word, found) if n <= KEPT_LENGTH else found

    def _keep(self, word: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(self.kept) >= KEPT_WORDS:
            self.before, self.kept = self.kept, {}
        self.kept[word] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a text. Special tokens in it become their ids; the rest is composed (NFC), lower-cased
        letter by letter and cut into words."""
        ids: list[int] = []
        for i, part in enumerate(self.specials.split(text) if self.specials else [text]):
            if i % 2:
                ids.append(self.special[part])
            elif part:
                lower = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                kept, add = self.kept.get, ids.extend
                for w in _WORDS.findall(lower):
                    add(kept(w) or self.word(w))
        return ids

    def decode(self, ids) -> str:
        """The tokens' names, joined by spaces: the vocabulary names no other decoder."""
        names = self.names
        return " ".join([names[i] for i in ids])


_MODELS: dict[str, WordBpe] = {}


def model(path: str) -> WordBpe:
    """The vocabulary, loaded once a process."""
    if path not in _MODELS:
        _MODELS[path] = WordBpe(path)
    return _MODELS[path]


def encode_documents(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """Key, ``ids`` (array of int) and ``decoded`` of every row, in the tasks that read the rows.

    A null text is encoded as the empty one: no ids, decoded to the empty text. Null and repeated
    keys, repeated rows and texts of any length are rows like others; an empty table gives no rows;
    other columns are not read. Nothing is shuffled.
    """
    kind = dict(df.dtypes)[key]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model(path)
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                rows = [bpe.encode(t) if t else [] for t in batch.column(1).to_pylist()]
                offsets = np.zeros(len(rows) + 1, np.int32)
                np.cumsum([len(r) for r in rows], out=offsets[1:])
                flat = np.fromiter((i for r in rows for i in r), np.int32, offsets[-1])
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array([bpe.decode(r) for r in rows], pa.string())], ["k", "ids", "decoded"])

    coded = df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(encode, f"k {kind}, ids array<int>, decoded string")
    return coded.withColumnRenamed("k", key)
