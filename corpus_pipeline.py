"""A corpus pipeline over ``documents``: quality rules, near duplicates, repeated passages, secrets, packing.

Each stage takes the documents that the one before it kept, as written and read again. All but the last return the
columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sampleloom.llm.frames import shared_path, table
from sampleloom.llm.minhash import near_duplicates_stage
from sampleloom.llm.packing import packing_stage
from sampleloom.llm.quality import quality_stage
from sampleloom.llm.secrets import secrets_stage
from sampleloom.llm.suffixes import suffix_stage

STAGES = [
    ("quality rules", quality_stage),
    ("MinHash near-dedup", near_duplicates_stage),
    ("suffix-array dedup", suffix_stage),
    ("secret scans", secrets_stage),
    ("packing", packing_stage),
]

#: Trained and numeric stages have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = shared_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
