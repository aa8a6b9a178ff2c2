"""From raw documents to packed training sequences.

Five stages, each an operator of ``sensorlake.llm`` applied to all that
the one before kept. Between stages documents are written as Parquet and
read again. All stages but the last return the columns of their input.

Defined results: null or empty texts fail the quality rules and go; repeated
rows are near duplicates of each other, one stays; a document whose words
all repeat elsewhere stays with an empty text; empty tables pass through;
further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import packing, quality_rules, secret_scan, simhash, substring_dedup
from sensorlake.llm._util import staged, table


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    return quality_rules.accepted(docs, quality_rules.POLICIES["full-1"])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group: the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of 50-word passages that also start in an earlier document."""
    return _counted(substring_dedup.deduplicated(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with the values of secrets redacted."""
    return _counted(secret_scan.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of at most 2048 tokens."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substrings),
    ("secret_scan", secrets),
    ("best_fit_packing", pack),
]

#: SQL has neither the fingerprints' hash nor the tokenizer; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
