"""The corpus pipeline: from documents to the shards of a clean, mixed training corpus.

Every stage takes (spark, docs, sf_dir) and returns a table; all but the last return the
columns of ``documents``.  ``run`` writes each stage as Parquet and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salescompass.llm import decontaminate, near_dedup, rule_quality, sharding, source_mix
from salescompass.llm.storage import stored

SHARDS = 40


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts."""
    return rule_quality.accepted(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one of the smallest doc_id."""
    return near_dedup.deduplicated(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, a row for each pass over a document."""
    return source_mix.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its global ``row`` number, ``shard`` and ``slot``."""
    return sharding.shard_rows(docs, ["doc_id"], SHARDS)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_free", benchmark_free), ("mix", mix), ("shards", shards),
]

#: The quality model and the mix's pseudorandom draws cannot be said in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
