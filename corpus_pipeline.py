"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, mixing.

Every stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a
DataFrame that is written as Parquet and read again as the next stage's documents. All but the last
return the columns of the documents they were given:

1. quality: documents that fail the rules go; failing lines of the others are cut out.
2. near_duplicates: of each group of linked fingerprints the document with the smallest id stays.
3. decontaminate: documents in which a window of a benchmark item occurs go.
4. redact_secrets: secrets are replaced in the texts; no document goes.
5. mix_sources: the documents that the mix takes, with the words it takes of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontam, mixing, quality, secrets, simhash
from corpusloom.llm._store import materialize

#: SQL has no XXH64 bit votes, reachability over them, or random forests; tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.clean_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.drop_contaminated(docs, items)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_documents(docs, *secrets.learn(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("redact_secrets", secret_stage),
    ("mix_sources", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
