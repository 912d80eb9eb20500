"""Rows that every operator must cope with."""

from pyspark.sql import types as T

LONG = "word " * 30_000 + "end"

ODD_DOCUMENTS = [
    (1, "a plain text of a few words", "en", "src1", 27),
    (2, None, "en", "src1", None),
    (3, "", None, "src12", 0),
    (4, " \t\n\x0b ", "de", None, 5),
    (5, LONG, "en", "src1", len(LONG)),
    (6, "one", "fr", "other", 3),
    (6, "one", "fr", "other", 3),
    (7, "a plain text of a few words", "en", "src2", 27),
    (None, "a plain text of a few words", "en", "src2", 27),
    (None, None, None, None, None),
    (8, "Ünï🙂 cödé\u0000 'S\u0085x", "es", "src3", 16),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHING = ["k", "t", "name", "n", "shard", "slot", "tokens", "copies", "score", "spans", "__score", "component", "url", "label", "next"]


def documents(spark, rows=None):
    """A documents table with further columns of clashing names."""
    base = T.StructType.fromJson(spark.createDataFrame([], SCHEMA).schema.jsonValue())
    for c in CLASHING:
        base = base.add(c, "string")
    data = ODD_DOCUMENTS if rows is None else rows
    return spark.createDataFrame([(*r, *CLASHING) for r in data], base)


def write(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


class Union:
    """Union-find that keeps the smallest member on top."""

    def __init__(self):
        self.up = {}

    def top(self, a):
        self.up.setdefault(a, a)
        while self.up[a] != a:
            self.up[a] = a = self.up[self.up[a]]
        return a

    def link(self, a, b):
        a, b = sorted((self.top(a), self.top(b)))
        self.up[b] = a
