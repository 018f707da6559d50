"""Corpus pipeline: rules, line dedup, near-dedup, mixing and packing. Each stage's
result is written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from heatlane.llm import line_dedup, mixing, near_dedup, packing, quality
from heatlane.session import durable

STAGES = [
    ("quality_rules", quality.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", near_dedup.stage),
    ("mix_sources", mixing.stage),
    ("best_fit_packing", packing.stage),
]

#: Fingerprints and token ids are beyond SQL; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
