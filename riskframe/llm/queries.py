"""The registered queries of this subpackage: thin, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import captures, centroids, decontam, language, packing, quality_model, quality_rules, shards, simhash
from riskframe.llm import token_counts, token_frames, toxicity, whitening
from riskframe.llm.common import table

#: Folder of the public tokenizers' vocabulary files.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build

    return add


@query("op1_token_frames")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_frames.round_trip(spark, docs, f"{TOKENIZERS}/byte_bpe_50k.json").withColumnRenamed("doc", "doc_id")


@query("op2_quality_rules", quality_rules.SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.judge(docs, carry=["doc_id"])


@query("op3_quality_classifier")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return quality_model.classify(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))


@query("op4_toxicity_grades")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.grade(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))


@query("op5_simhash_components")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op6_language_id")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))


@query("op7_shuffled_shards")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    body = F.coalesce("text", F.lit(""))
    return shards.shuffle_to_shards(docs).select(
        "doc_id",
        (F.octet_length(body) + shards.OVERHEAD).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {10 * part + 1}, 10))::BIGINT >> {35 - 5 * i}) & 31), 1)"
    for part in range(4)
    for i in range(8)
)


@query(
    "op8_warc_captures",
    f"""
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first FROM payloads)
    SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
      CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN first < page_id THEN first END AS refers_to
    FROM firsts
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return captures.round_trip(spark, pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op9_packed_sequences")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents").select("doc_id", "text"), f"{TOKENIZERS}/word_bpe_49k.json")


@query("op10_benchmark_leaks")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontam.matches(docs, table(spark, folder, "benchmark").select("item_id", "text"))


@query("op11_token_counts")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, f"{TOKENIZERS}/word_bpe_49k.json").select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op12_embedding_whitening")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    done = whitening.whiten(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of")
    found = done.select("vec_id", "n", "deviation", "identity_error", each)
    return found.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error"
    )


@query("op13_centroid_clusters", centroids.sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings").select("vec_id", "embedding"))
