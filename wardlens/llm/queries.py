"""One registered query per operator, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe, chat, collocations, decontamination, language_id, licenses, line_dedup, pq_dedup, sharding, simhash, substring_dedup, token_alignment, token_counts
from .common import documents, small_batches

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
QUERIES: dict = {}
ORACLES: dict = {}


def register(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return add


@register("op1_language_id")
def op1(spark, sf_dir):
    """Predicted language of every document, learned from the rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    profiles = language_id.fit_profiles(docs.filter(~language_id.is_held_out("doc_id")))
    found = docs.select(
        "doc_id",
        language_id.is_held_out("doc_id").alias("held_out"),
        language_id.predict_language(docs, profiles).alias("p"),
    )
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


@register("op2_chat_rotation", chat.oracle())
def op2(spark, sf_dir):
    """Every conversation from every participant's side, masks as text."""
    found = chat.rotate_perspectives(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string"))), ",")
    return found.withColumn("mask", mask)


@register("op3_simhash_dedup")
def op3(spark, sf_dir):
    """Fingerprint and near-duplicate component of every document."""
    return simhash.simhash_components(documents(spark, sf_dir))


@register("op4_decontamination")
def op4(spark, sf_dir):
    """Words of every document that lie inside benchmark windows."""
    found = decontamination.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@register("op5_license_scan", licenses.oracle())
def op5(spark, sf_dir):
    """Known licence sentences and matched licences of every document."""
    found = licenses.scan_licenses(documents(spark, sf_dir))
    return found.withColumns({c: F.array_join(c, ",") for c in ("sentence_ids", "licenses")})


@register("op6_sharding")
def op6(spark, sf_dir):
    """Shard and slot of every document; counts are at most one apart."""
    found = sharding.shard_documents(documents(spark, sf_dir))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@register("op7_token_counts")
def op7(spark, sf_dir):
    """Token counts of every document."""
    small_batches(spark)
    docs = documents(spark, sf_dir).select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        token_counts.token_count("text", public_tokenizers.path(VOCABULARY)).alias("n_tokens"),
    )
    return docs.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register("op8_line_dedup")
def op8(spark, sf_dir):
    """Lines of every document that repeat elsewhere, and what stays."""
    found = line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "_lines.n_lines", "_lines.n_dropped", F.sha2(F.col("_lines.kept").cast("binary"), 256).alias("kept_sha256"))


@register("op9_bpe")
def op9(spark, sf_dir):
    """Token ids and decoded text of every document, as digests."""
    small_batches(spark)
    docs = documents(spark, sf_dir).select("doc_id", bpe.digest_column("text", public_tokenizers.path(VOCABULARY)).alias("t"))
    return docs.select("doc_id", "t.n_tokens", "t.ids_sha256", "t.decoded_sha256")


@register("op10_pq_dedup")
def op10(spark, sf_dir):
    """Links and near-duplicate component of every embedding."""
    return pq_dedup.cosine_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@register("op11_collocations", collocations.oracle())
def op11(spark, sf_dir):
    """Each language's best phrases of two and three words."""
    return collocations.collocations(documents(spark, sf_dir))


@register("op12_substring_dedup")
def op12(spark, sf_dir):
    """What stays of every document without the 100-byte strings that start earlier."""
    found = substring_dedup.dedup_substrings(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op13_token_alignment")
def op13(spark, sf_dir):
    """How the byte-level and the piece vocabulary cut every document, and how common its links are."""
    paths = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.token_alignment(documents(spark, sf_dir), *paths)
