"""A corpus pipeline: score quality, drop near copies, decontaminate, hide secrets, mix sources.

Every stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from toneflow.llm import queries
from toneflow.llm.tables import read, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality", queries.quality_stage),
    ("simhash_dedup", queries.simhash_stage),
    ("decontamination", queries.decontamination_stage),
    ("secrets", queries.secrets_stage),
    ("mixing", queries.mixing_stage),
]

#: Fitted models, XXH64 fingerprints and their components are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
