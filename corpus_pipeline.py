"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination and
packing, each stage working on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vitalake.llm.common import delete_path, documents, stage_path
from vitalake.llm.decontamination import stage_decontamination
from vitalake.llm.language_id import stage_language_id
from vitalake.llm.line_dedup import stage_line_dedup
from vitalake.llm.packing import stage_packing
from vitalake.llm.simhash_golay import stage_simhash_dedup

#: each takes (spark, docs, sf_dir); its rows are stored and read as the next one's docs
STAGES = [
    ("language_id", stage_language_id),
    ("line_dedup", stage_line_dedup),
    ("simhash_near_dedup", stage_simhash_dedup),
    ("benchmark_decontamination", stage_decontamination),
    ("best_fit_packing", stage_packing),
]

#: language ID (a fitted model) and packing have no SQL form; the tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, step in STAGES:
        docs, path = stage_path(step(spark, docs, sf_dir), f"pipeline-{name}")
        if before:  # the next stage is stored: nothing reads the one before any more
            delete_path(spark, before)
        before = path
    return docs
