"""Queries of the corpus operators and the SQL that states them a second time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tellermill.llm import centroids, decontaminate, exact_dedup, katz, line_dedup, packing, pii, quality, role_repair, secret_scan, sharding, simhash, toxicity
from tellermill.llm.common import ship


def _sent(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_OPERATORS = {
    "op1_decontamination": decontaminate.op1,
    "op2_sharding": sharding.op2,
    "op3_quality_rules": quality.op3,
    "op4_line_dedup": line_dedup.op4,
    "op5_simhash": simhash.op5,
    "op6_secret_scan": secret_scan.op6,
    "op7_packing": packing.op7,
    "op8_pii_surrogates": pii.op8,
    "op9_toxicity": toxicity.op9,
    "op10_katz_scores": katz.op10,
    "op11_centroids": centroids.op11,
    "op12_exact_dedup": exact_dedup.op12,
    "op13_role_repair": role_repair.op13,
}
QUERIES = {name: _sent(query) for name, query in _OPERATORS.items()}
ORACLES = {
    "op1_decontamination": decontaminate.ORACLE,
    "op3_quality_rules": quality.ORACLE,
    "op11_centroids": centroids.ORACLE,
    "op12_exact_dedup": exact_dedup.ORACLE,
}
