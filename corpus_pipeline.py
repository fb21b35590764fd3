"""The corpus pipeline: five stages from the documents table to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.

1. language_id keeps documents whose language can be told.
2. near_dedup keeps one document of each group (five-word shingles, similarity 0.8 or more).
3. decontamination keeps documents that leak no benchmark item.
4. secret_scan keeps all documents and replaces secrets in their texts.
5. packing returns the place of every piece of every document in its sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomsift.lineage import written
from loomsift.llm import decontam, langid, neardup, packing, secrets
from loomsift.llm.common import table

STAGES = [
    ("language_id", langid.stage),
    ("near_dedup", neardup.stage),
    ("decontamination", decontam.stage),
    ("secret_scan", secrets.stage),
    ("packing", packing.stage),
]

#: Automata, MinHash, alignment, forests and tokenizers are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
