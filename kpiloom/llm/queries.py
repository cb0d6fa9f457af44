"""The operators of this subpackage as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import (
    decontamination,
    language,
    lm,
    neardup,
    oracles,
    packing,
    quality,
    ranked_search,
    secret_scan,
    sharding,
    substrings,
    toxicity,
    warc,
    whitening,
)
from kpiloom.llm.store import new_folder, share_code, stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def op1_bin_completion(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents", "doc_id", "text"), TOKENIZER)


def op2_jump_hash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    sizes = docs.select(
        "doc_id",
        (F.octet_length("text") + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = sharding.with_slots(sharding.sharded(sizes, 8), ["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def remainder(parts: int, held_out: int) -> str:
    """Whether a document is held out, as SQL; a null id never is."""
    return f"coalesce(crc32(cast(cast(doc_id AS STRING) AS BINARY)) % {parts} = {held_out}, false)"


def op3_log_bloom(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    held_out = remainder(5, 1)
    return lm.scored(docs, f"NOT {held_out}").select(
        "doc_id",
        F.expr(held_out).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op4_line_field(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    field = quality.trained(docs, table(spark, folder, "labels", "doc_id", "quality"))
    judged = quality.judged(docs, field)
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept", "content_share")


def op5_nb_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    held_out = remainder(3, 1)
    labels = table(spark, folder, "labels", "doc_id", "toxic").where(f"NOT {held_out}")
    scored = toxicity.scored(docs, toxicity.trained(docs, labels))
    return scored.select(
        "doc_id", F.expr(held_out).alias("held_out"), "score", F.expr("int(score >= 0.7)").alias("predicted")
    )


def op6_cross_parsing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    held_out = remainder(4, 2)
    learnt = language.learnt(docs.where(f"NOT {held_out}"), "doc_id", "text", "lang")
    found = language.identified(docs.select("doc_id", "text"), learnt)
    return found.select("doc_id", F.expr(held_out).alias("held_out"), "lang_pred", "score")


def op7_minhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return neardup.near_duplicates(docs, shape=neardup.MinHash(shingle_words=4))


def op8_blob_ledger(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    scanned = secret_scan.scanned(docs, new_folder(spark, "ledger"))
    base = ", ".join(f"'{rule.kind}'" for rule in secret_scan.BASE)
    joined = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    counts = [
        F.expr(f"size(filter(findings, x -> x.kind = '{rule.kind}'))").cast("long").alias(f"n_{rule.kind}")
        for rule in secret_scan.BASE
    ]
    return scanned.select(
        "doc_id",
        *counts,
        F.sha2(F.expr(joined.format(f"filter(findings, x -> x.kind IN ({base}))")), 256).alias("base_sha256"),
        F.expr(joined.format("findings")).alias("spans"),
    )


def op9_containment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return decontamination.contained(docs, table(spark, folder, "benchmark", "item_id", "text")).drop("text_hash")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = new_folder(spark, "warc")
    pages = table(spark, folder, "pages", "page_id", "url", "html")
    records = warc.read_back(warc.written(pages, archive), archive)
    return records.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
        "url",
        F.regexp_extract("file", "-([0-9]+)-", 1).cast("long").alias("shard"),
    )


def op11_suffix_automata(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return substrings.without_repeats(docs).select("doc_id", "n_words", "n_removed", kept)


def op12_exact_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings", "vec_id", "embedding")
    model = whitening.fitted(rows)
    made = stored(whitening.whitened(rows, model).select("vec_id", "deviation", "whitened"), "whitened")
    error = whitening.identity_error(made, len(model.explained))
    shares = F.array(*(F.lit(share) for share in model.explained.tolist())).cast("array<double>")
    each = made.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def op13_nra(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return ranked_search.ranked(docs, table(spark, folder, "benchmark", "item_id", "text"))


def queries() -> dict[str, Query]:
    return {
        "op1_bin_completion": op1_bin_completion,
        "op2_jump_hash": op2_jump_hash,
        "op3_log_bloom": op3_log_bloom,
        "op4_line_field": op4_line_field,
        "op5_nb_ngrams": op5_nb_ngrams,
        "op6_cross_parsing": op6_cross_parsing,
        "op7_minhash": op7_minhash,
        "op8_blob_ledger": op8_blob_ledger,
        "op9_containment": op9_containment,
        "op10_warc": op10_warc,
        "op11_suffix_automata": op11_suffix_automata,
        "op12_exact_whitening": op12_exact_whitening,
        "op13_nra": op13_nra,
    }


def oracle_sql() -> dict[str, str]:
    """Those queries that plain SQL can say; the others are tested against plain versions."""
    return oracles.oracle_sql()
