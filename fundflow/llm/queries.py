"""Registered queries of the training-data operators.

Each query applies its operator, with the parameters meant for production, to
its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.llm import (
    bottomk,
    bwt_dedup,
    collocations,
    cotraining,
    language_id,
    packing,
    pii,
    revisits,
    secret_scan,
    sentencepiece_codec,
    topk,
    vptree,
    whitening,
)
from fundflow.llm.common import read, tokenizer_path

#: Key of the surrogates; a deployment has its own.
SURROGATE_KEY = "fundflow-surrogates"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pii.pseudonymise(docs, SURROGATE_KEY).select("doc_id", "text", "n_replaced")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op3_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, factor=1.0)


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.near_duplicates(read(spark, sf_dir, "documents"), words=2, percent=80)


def op5_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisits.digest(revisits.resolve(revisits.records_of_pages(read(spark, sf_dir, "pages"))))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = cotraining.train(docs, read(spark, sf_dir, "labels"))
    return cotraining.score(docs, model).select("doc_id", *cotraining.RESULT)


def op7_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.remove_repeats(read(spark, sf_dir, "documents"), keep=["doc_id"])


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    weights = secret_scan.train(secret_scan.labelled_samples(docs))
    return secret_scan.digest(secret_scan.scan(docs, weights))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), longest=5, least=100, top=2000)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    whitened = whitening.whiten(read(spark, sf_dir, "embeddings"), components=16)
    return whitened.withColumn("deviation", F.expr("try_cast(deviation as long)"))


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


LLM_QUERIES = {f.__name__: f for f in (
    op1_pii, op2_sentencepiece, op3_vptree, op4_near_dedup, op5_revisits, op6_quality, op7_top_products, op8_packing,
    op9_repeats, op10_secrets, op11_collocations, op12_whitening, op13_language)}
