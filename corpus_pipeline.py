"""The cleaning pipeline over ``documents``: five stages, each written and read again.

Every stage gets the rows that its predecessor kept and works on all of them.
All but the last return the columns of ``documents``; the last returns packed
pieces. A stage needs nothing but its input and the tables of ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercadal.llm.bradley_terry import keep_good
from mercadal.llm.disclosure import redact
from mercadal.llm.packing import concat_and_cut
from mercadal.llm.simhash import keep_one_each
from mercadal.llm.tables import table
from mercadal.llm.winnowing import without_contaminated
from mercadal.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality ranking rejects."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    return keep_one_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and the terms that disclose it."""
    return redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into training sequences."""
    return concat_and_cut(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", duplicates_stage),
    ("decontamination", benchmark_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

# learned scores, components of links and token ids are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
