"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tellermill.llm import decontaminate, line_dedup, packing, quality, simhash
from tellermill.llm.common import ship, stored, table

#: Name and function of each stage. A function takes the session, the documents that the
#: stage before it kept, and the folder of the input tables.
STAGES = [
    ("quality rules", quality.stage),
    ("line dedup", line_dedup.stage),
    ("simhash near-dedup", simhash.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("best-fit packing", packing.stage),
]
#: The last stages depend on a tokenizer and on hashes that SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; each one's rows are written before the next reads them."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
