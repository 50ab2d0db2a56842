"""Corpus pipeline: five document operators, one after the other.

1. language_id: documents without a recognised language go.
2. jaccard: of each group of near-duplicates the smallest document stays.
3. suffix_dedup: passages that stand more than once in the corpus go.
4. mixing: documents are repeated or left out until sources weigh as wanted.
5. encode: token ids of every text.

Each stage reads what the one before it wrote as Parquet and works on all of it;
what it wrote for itself goes once its result is written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tspanel.llm import bpe, jaccard, langid, mixing, suffix_dedup
from tspanel.llm.common import Scratch, held_out, released

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: A text is rejected if fewer of its n-grams than this fit any profile (or if it has no letter).
MIN_SCORE = 0.25

#: Bytes of a passage that is removed where it repeats: 50 words and more of the corpus have 270 at least.
PASSAGE = 200

#: Bytes of the record batches that tasks exchange with Python: 10,000 rows, Spark's own bound, are tens of MB of
#: texts or shingles, held several times over by either side.
BATCH_BYTES = 2 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: No SQL can express ranking against learned profiles, nor the stages behind it; tests hold each stage against brute force.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; null languages are filled in by the prediction."""
    docs = docs.select(*COLUMNS)
    profiles = langid.fit_profiles(docs.where(~held_out(F.col("doc_id"))))
    found = langid.identify(docs, profiles).where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def jaccard_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that are linked, directly or through others, the one of smallest id."""
    return jaccard.keep_representatives(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without bytes of repeated strings of ``PASSAGE`` bytes; what is left of a cut character goes too."""
    kept = suffix_dedup.remove_repeats(docs.select(*COLUMNS), carry=("lang", "source"), length=PASSAGE)
    return kept.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the schedule takes all of it, to the nearest whole number (0 to 2 times)."""
    mixed = mixing.mix(docs.select(*COLUMNS), carry=("text", "lang", "n_chars"))
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the digest of the text that decodes from them."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=("doc_id", "source", "lang"), ids=True, digests=True)


STAGES = [
    ("language_id", language_id),
    ("jaccard", jaccard_groups),
    ("suffix_dedup", repeated_passages),
    ("mixing", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        for name, stage in STAGES:
            with released():
                docs = scratch.keep(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set(BATCH_CONF, before)
    return docs
