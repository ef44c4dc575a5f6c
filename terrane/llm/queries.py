"""The registered queries of the training-data operators."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, collocations, decontaminate, divergence, kd_shards, packing, pii, quality, simhash, suffix_dedup, toxicity, url_rules, warc_revisit
from .common import table
from .oracle import ORACLE_SQL  # noqa: F401


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["n_words"])), F.lit(0).cast("long")).alias("longest_match"))


def warc_records(pages: DataFrame) -> DataFrame:
    """Two records per page: its full response, and a later revisit of the URL in another spelling.

    Fixed rules on page_id vary validators, dates and headers, so that every outcome occurs.
    """
    p = F.col("page_id")
    at = F.lit(1700000000) + p * 60
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    stamp = F.concat(F.lit("t"), p.cast("string"))
    no_headers = F.lit(None).cast("string")
    answer = F.map_filter(F.create_map(
        F.lit("ETag"), F.when(p % 7 == 0, no_headers).when(p % 5 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag),
        F.lit("Last-Modified"), F.when(p % 3 == 0, no_headers).otherwise(stamp),
        F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.octet_length("html").cast("string"),
        F.lit("Cache-Control"), F.lit("max-age=60")), lambda _, v: v.isNotNull())
    not_modified = F.map_filter(F.create_map(
        F.lit("etag"), F.when(p % 13 == 0, F.lit('"stale"')).otherwise(tag),
        F.lit("LAST-MODIFIED"), F.when(p % 2 == 0, no_headers).otherwise(stamp),
        F.lit("Content-Length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=3600"),
        F.lit("Date"), F.concat(F.lit("d"), p.cast("string"))), lambda _, v: v.isNotNull())
    spelt = (F.when(p % 4 == 0, F.regexp_replace("url", "^https?://", "http://www."))
             .when(p % 4 == 1, F.concat("url", F.lit("#again")))
             .when(p % 4 == 2, F.regexp_replace("url", "^https:", "http:")).otherwise(F.col("url")))
    later = at + F.when(p % 11 == 0, -3600).otherwise(86400)
    responses = pages.select((p * 2).alias("record_id"), F.lit("response").alias("warc_type"), F.col("url").alias("uri"),
                             F.timestamp_seconds(at).alias("date"), answer.alias("headers"), F.col("html").alias("payload"))
    revisits = pages.select((p * 2 + 1).alias("record_id"), F.lit("revisit").alias("warc_type"), spelt.alias("uri"),
                            F.timestamp_seconds(later).alias("date"), not_modified.alias("headers"), F.lit(None).cast("string").alias("payload"))
    return responses.unionByName(revisits)


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisit.resolve_revisits(warc_records(table(spark, sf_dir, "pages")))
    listed = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return found.select(
        ((F.col("record_id") - 1) / 2).cast("long").alias("page_id"), "canonical_url", "outcome",
        (F.col("response_id") / 2).cast("long").alias("response_page_id"), "status", listed.alias("headers"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.md5("payload").alias("payload_md5"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.train(documents, table(spark, sf_dir, "labels"))
    return quality.judge(quality.describe(documents, model))


URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = url_rules.mine(url_rules.page_labels(pages, URL_RULES))
    return url_rules.judge(pages.select("page_id", "url"), rules, URL_RULES)


SHARDS = 16


def op6_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1
    dimensions = {"source": kd_shards.text_position(F.col("source")), "lang": kd_shards.text_position(F.col("lang")),
                  "size": F.log2(size), "doc_id": F.col("doc_id")}
    return kd_shards.shard_documents(documents, dimensions, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    out = toxicity.held_out(F.col("doc_id"))
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), only=~out)
    return toxicity.score(documents, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("sentences").alias("n_offending"), F.transform("sentences", lambda s: s["start"]).alias("offending_starts"))


def tokenizer_path(spark: SparkSession) -> str:
    """Vocabulary file of the packing query: ``terrane.tokenizerPath``, else the installed public one."""
    path = spark.conf.get("terrane.tokenizerPath", None)
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def byte_tokenizer(spark: SparkSession) -> tuple[str, str]:
    """Vocabulary file and pattern of the byte-level query: ``terrane.bytePairPath``, else the installed public one."""
    import public_tokenizers

    return (spark.conf.get("terrane.bytePairPath", None) or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
            public_tokenizers.PATTERN)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(spark))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents")).drop("other_doc_id")


def pii_key(spark: SparkSession) -> str:
    """Key of the pseudonyms: ``terrane.piiSecret`` of the session.  Without it pseudonyms can be undone by anyone, so that is said."""
    key = spark.conf.get("terrane.piiSecret", None)
    if not key:
        warnings.warn("terrane.piiSecret is not set: pseudonyms are made with the public test key", stacklevel=2)
    return key or "terrane test key"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), pii_key(spark))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = byte_tokenizer(spark)
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, pattern)
    return byte_bpe.decode(encoded, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents")).withColumn("rank", F.col("rank").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_warc_revisits": op2_warc_revisits,
    "op3_simhash": op3_simhash,
    "op4_quality": op4_quality,
    "op5_url_rules": op5_url_rules,
    "op6_kd_shards": op6_kd_shards,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_pii": op10_pii,
    "op11_divergence": op11_divergence,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_collocations": op13_collocations,
}
