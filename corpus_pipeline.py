"""The corpus pipeline: five operators in a row, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens.llm import bpe, decontamination, language_id, line_dedup, simhash
from wardlens.llm.common import documents, small_batches, without
from wardlens.sources.materialize import written

VOCABULARY = "word_bpe_49k.json"
MIN_LANGUAGE_SCORE = 0.2  # a script that was not learned scores 0, or little where a few words of a learned one are among it


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``MIN_LANGUAGE_SCORE`` or more in a language learned from the labelled ones; others go."""
    profiles = language_id.fit_profiles(docs)
    found = language_id.predict_language(docs, profiles)
    return docs.filter(found["score"] >= MIN_LANGUAGE_SCORE)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat in other documents."""
    found = line_dedup.dedup_lines(docs)
    text = F.when(F.col("text").isNotNull(), F.col("_lines.kept"))
    return found.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.one_per_component(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window.

    The verdict depends on the text alone and goes by a digest of it, so rows that share an id
    or have none are each judged by their own text.
    """
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))  # 16 bytes, so the list of them stays small
    texts = docs.select(digest.alias("digest"), "text")
    found = decontamination.contamination(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="digest")
    hit = written(found.filter("n_hit > 0").select("digest").distinct(), "contaminated")
    return without(docs.withColumn("_text_digest", digest), hit, "_text_digest").select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and digests of ids and decoded text."""
    small_batches(spark)
    packed = bpe.digest_column(docs["text"], public_tokenizers.path(VOCABULARY), keep_ids=True)
    tokens = docs.select("doc_id", "lang", "source", packed.alias("t"))
    return tokens.select("doc_id", "lang", "source", "t.n_tokens", "t.ids", "t.ids_sha256", "t.decoded_sha256")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

# fitted profiles, fingerprints and merges have no SQL form; tests/llm holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every stage's rows are written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
