"""From raw documents to packed training sequences, in five stages of the operators in :mod:`millrace.llm`.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one before kept. Between stages the rows are written as Parquet to the
shared folder and read again, so a lost executor never makes an earlier stage run once more.

All stages but the last return the columns of ``documents``:

- quality rules: rejected documents go, boilerplate lines leave the others;
- exact dedup: of equal texts the row with the largest doc_id stays;
- near dedup: of each class of near copies the row with the smallest doc_id stays;
- secret scans: secrets in the texts are masked;
- packing: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact, neardup, packing, quality, secrets
from millrace.session import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_copies(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    forest, known = secrets.trained(docs)
    return secrets.redact(docs, forest, known)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("MinHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: Token ids, the forest and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
