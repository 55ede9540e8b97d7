"""The corpus pipeline: quality rules, line dedup, near-duplicates, source mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; each result is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``; a stage that changes a
text also brings ``n_chars`` up to date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibflow.llm import line_dedup, mixing, packing, quality_rules, simhash
from bibflow.llm.common import materialize, table
from bibflow.llm.queries import vocabulary_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality_rules.filter_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from the texts; documents stay."""
    out = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("ld_removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.keep_one(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; the one at a source's budget only up to it."""
    out = mixing.mixed_documents(docs)
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), F.col("n_chars"))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document (copies included) goes."""
    out = packing.pack(docs.select("doc_id", "text"), vocabulary_path())
    return out.toDF("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Components of fingerprints, hashes and tokens are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
