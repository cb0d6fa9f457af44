"""From raw documents to packed sequences: five stages, each an operator of ``kpiloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet in the shared folder and
the next stage reads that. All stages but the last return the columns of ``documents``, whatever their names: operators
see the columns they read by name, and all others under names that clash with none of theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import decontamination, language, neardup, packing, secret_scan
from kpiloom.llm.queries import TOKENIZER, table
from kpiloom.llm.store import new_folder, share_code, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def set_aside(docs: DataFrame, *read: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but those read under names of no operator, and what selects them as they were."""
    names = [c if c in read else f"column_{i}_of_documents" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), [F.col(new).alias(old) for new, old in zip(names, docs.columns, strict=True)]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: null texts, and texts without a letter."""
    share_code(spark)
    languages = language.learnt(docs, "doc_id", "text", "lang")
    rows, columns = set_aside(docs, "text")
    found = language.identified(rows, languages)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each class of near duplicates the document with the smallest id; of rows equal in id and text, one.

    Classes come from shingles of five words and a similarity of 0.8. A row is known by its id and its text, so that
    null and repeated ids are rows of their own; null ids come last, and equal ids go by the text's hash.
    """
    share_code(spark)
    rows, columns = set_aside(docs, "doc_id", "text")
    row = F.struct(F.isnull("doc_id").alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"))
    named = rows.withColumn("row", row)
    kept = neardup.near_duplicates(named, "row").where("kept").select("row").distinct()
    return named.dropDuplicates(["row"]).join(kept, "row", "left_semi").select(*columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain an item of the benchmark: rows of its id and text, of a null id as well."""
    found = decontamination.contained(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    leaks = found.select(F.col("doc_id").alias("leak"), "text_hash").distinct()
    same = docs["doc_id"].eqNullSafe(leaks["leak"]) & (F.xxhash64(docs["text"]) == leaks["text_hash"])
    return docs.join(leaks, same, "left_anti")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask every secret in the texts, and count n_chars of the changed ones anew."""
    share_code(spark)
    rows, columns = set_aside(docs, "doc_id", "text", "n_chars")
    scanned = secret_scan.scanned(rows, new_folder(spark, "ledger"))
    changed = secret_scan.masked(scanned)
    n_chars = F.when(F.size("findings") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.withColumn("n_chars", F.coalesce(n_chars, "n_chars")).select(*columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its sequence of at most 1024 tokens and its place there."""
    share_code(spark)
    return packing.packed(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]

# Suffix automata and searches for the best packing can't be said in SQL; the tests have a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
