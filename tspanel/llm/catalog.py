"""Queries of this subpackage: ``opN_<name>`` applies operator N to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tspanel.llm import ann, bpe, conversations, fingerprint, flatgraph, fptree, jaccard, langid, licenses, mixing, suffix_dedup, token_counts, toxicity
from tspanel.llm.common import held_out, read_table
from tspanel.llm.oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

BYTE_BPE = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    return langid.identify(docs.select("doc_id", "text"), profiles) \
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, public_tokenizers.path(BYTE_BPE), ids=False, digests=True)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(BYTE_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(read_table(spark, sf_dir, "documents"))


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_threshold_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(read_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    model = toxicity.fit(toxicity.with_labels(docs, labels))
    return toxicity.score_documents(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths: they are laid out as source/id div 10000/id div 100/id."""
    docs = read_table(spark, sf_dir, "documents")
    part = [F.floor(F.col("doc_id") / n).cast("string") for n in (10_000, 100, 1)]
    files = docs.select("doc_id", "text", F.concat_ws("/", F.coalesce("source", F.lit("")), *part).alias("path"))
    return licenses.scan_tree(files, keep=("doc_id",)).select("doc_id", "path", "own_license", F.round("own_score", 9).alias("own_score"), "license", "inherited_from")


def op11_fptree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damage(read_table(spark, sf_dir, "conversations")))


def op13_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_links(read_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_bpe, op3_token_counts, op4_suffix_dedup, op5_nn_descent, op6_threshold_sketch, op7_toxicity, op8_jaccard_rtree, op9_mixing, op10_license_scan,
                                  op11_fptree_search, op12_conversation_repair, op13_flat_graph)}
