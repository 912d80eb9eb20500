"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgecast.llm import bpe, compact_windows, manifest, merkle, mixing, ngram_join, outliers, pii, pq_dedup, quality_cnn, sharding, spelling, urls
from surgecast.llm.common import bounded_batches, table

SHARDS = (1.0,) * 8
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
URL_RULES = (
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
)
#: From this score on a document counts as of quality 1.
LEAST_QUALITY = 0.3
#: Sources belong to domains of ten; a domain's web pages weigh twice as much in English.
MIX = mixing.Mix(share=0.75, weights={"d0": 2, "d0/en": 2, "d1/en": 2}, epochs=2, seed=7)


def levels() -> dict:
    """Domain, language, source: sources are numbered, ten to a domain."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,9})$", 1)
    domain = F.when(number == "", "other").otherwise(F.concat(F.lit("d"), F.floor(number.try_cast("long") / 10).cast("string")))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op1_pq_dedup(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    return pq_dedup.dedup_embeddings(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.93)


def op2_merkle(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    return merkle.fingerprint_documents(table(spark, sf, "documents"), "doc_id", "text")


def op3_rendezvous(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf, "documents"), "doc_id", "text", SHARDS)


def op4_compact_windows(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    found = compact_windows.find_passages(table(spark, sf, "documents"), "doc_id", "text")
    return found.withColumnRenamed("component", "component_id")


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents"), "doc_id", "text", levels(), MIX)


def op6_bpe(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    coded = bpe.encode_documents(table(spark, sf, "documents"), "doc_id", "text", TOKENIZER)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op7_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Pages are labelled by the document of their number: of low quality or toxic means block.

    The tables tie a page to a label by nothing else, and the texts differ; where the labels follow no
    token of the URLs, no mined rule beats chance on those held out, and what no fixed rule fits is allowed.
    """
    pages, labels = table(spark, sf, "pages"), table(spark, sf, "labels")
    marked = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked"))
    labelled = pages.select("page_id", "url").join(marked, F.col("page_id") == F.col("doc_id")).select("url", "blocked")
    return urls.judge_urls(pages, "page_id", "url", URL_RULES, labelled)


def op8_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    joined = ngram_join.join_ngrams(table(spark, sf, "documents"), "doc_id", "text")
    return joined.select("doc_id", F.col("n_ngrams").alias("n_shingles"), F.col("component").alias("component_id"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    bounded_batches(spark)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    network = quality_cnn.train(docs, table(spark, sf, "labels"))
    scored = quality_cnn.scored(docs, "text", network, "score")
    return scored.select(
        "doc_id",
        quality_cnn.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


def op10_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf, "documents"), "doc_id", "text")
    base = F.filter("spans", lambda x: x["base"])

    def number(kind: str):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(number, pii.KINDS), F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op11_outliers(spark: SparkSession, sf: str) -> DataFrame:
    judged = outliers.judge_documents(table(spark, sf, "documents"), "doc_id", "text", "lang", "source")
    return judged.drop("n_lines", "square")


def check_documents(docs: DataFrame, **shape: int) -> DataFrame:
    """Rows with an even checksum of their number are checked after their text has lost its line ends."""
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    without = {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}
    return manifest.verify_rows(docs, "doc_id", "source", ["doc_id", "source", "lang", "n_chars", "text"], even, without, **shape)


def op12_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return check_documents(table(spark, sf, "documents"))


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf, "documents"), "doc_id", "text")


QUERIES = {
    f.__name__: f
    for f in (
        op1_pq_dedup,
        op2_merkle,
        op3_rendezvous,
        op4_compact_windows,
        op5_mixing,
        op6_bpe,
        op7_url_rules,
        op8_ngram_join,
        op9_quality,
        op10_pii,
        op11_outliers,
        op12_manifest,
        op13_spelling,
    )
}
