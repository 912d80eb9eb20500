"""A corpus pipeline over ``documents``: quality, near duplicates, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir); ``docs`` is what the stage before returned, written as
Parquet and read again. All but the last return the columns of ``documents``. Further columns of
``docs`` pass through unchanged, whatever their names; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surgecast.llm import bpe, mixing, ngram_join, pii, quality_cnn
from surgecast.llm.common import bounded_batches, cut, stored, table
from surgecast.llm.queries import LEAST_QUALITY, TOKENIZER, levels

#: Documents are taken once at most, since the stages before have removed copies.
MIX = mixing.Mix(share=0.9, weights={"d0": 2, "d0/en": 2, "d1/en": 2}, epochs=1, seed=7)
#: Keys that may be broadcast to drop documents; more are joined by shuffle.
BROADCAST_KEYS = 100_000


def _row(docs: DataFrame) -> Column:
    """All columns in one, so that no name of theirs can clash with a stage's own."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")


def _few(keys: DataFrame) -> DataFrame:
    """Keys, marked for broadcast if their counted rows are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` less the rows whose doc_id is in ``dropped`` (column id). Null ids stay."""
    rows = docs.select(_row(docs), F.col("doc_id").alias("own"))
    return rows.join(_few(cut(dropped.distinct())), F.col("own") == F.col("id"), "left_anti").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. Null texts are judged as empty ones."""
    bounded_batches(spark)
    network = quality_cnn.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_cnn.scored(docs.select(_row(docs), "text"), "text", network, "score")
    return scored.filter(F.col("score") >= LEAST_QUALITY).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by n-gram overlap.

    Rows that repeat an id are judged each by its own text: of a group the row with the smallest id
    stays, of several such ones that with the smallest hash of its text, and of rows equal in both the first in
    order of their other columns. Documents without words, and rows without id, belong to no group and stay.
    """
    bounded_batches(spark)
    marked = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("t"), F.xxhash64("text").alias("mark"))
    joined = cut(ngram_join.join_ngrams(marked, "id", "t", "mark").filter("class is not null and id is not null"))
    same = ["id", "mark"]
    first = joined.groupBy("class").agg(F.min(F.struct(*same)).alias("first"))
    dropped = cut(joined.join(first, "class").filter(F.struct(*same) != F.col("first")).select(*same).distinct())
    repeats = cut(joined.groupBy(*same).count().filter("count > 1").select(*same))
    rows = docs.select(_row(docs), F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))
    kept = rows.join(_few(dropped), same, "left_anti")
    if repeats.isEmpty():
        return kept.select("row.*")
    order = Window.partitionBy(*same).orderBy(*(F.col(f"row.`{c}`").cast("string") for c in docs.columns if c != "text"))
    again = kept.join(_few(repeats), same, "left_semi").withColumn("place", F.row_number().over(order)).filter("place = 1")
    return kept.join(_few(repeats), same, "left_anti").select("row.*").unionByName(again.select("row.*"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets; n_chars follows the text."""
    masked = pii.mask_spans(docs.select(_row(docs), "text"), "text")
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return masked.select(*(changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the sources' target weights take. Rows without id stay."""
    mixed = mixing.mix_sources(docs, "doc_id", "text", levels(), MIX)
    return _without(docs, mixed.filter("copies = 0 and doc_id is not null").select(F.col("doc_id").alias("id")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the hash of the decoded text of every document."""
    bounded_batches(spark)
    coded = bpe.encode_documents(docs, "doc_id", "text", TOKENIZER)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over ``documents``; what lies between is kept in the checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Network, EM and tokenizer cannot be said in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None
