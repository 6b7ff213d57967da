"""The corpus pipeline: toxic documents go, copies and near copies go, contaminated documents go, and the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

Defined cases: null texts count as empty; rows with a null or repeated doc_id stay or go by their own text; an empty table
gives an empty result; further columns of documents, whatever their names, are passed on up to the last stage, which
returns the columns of its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumengrid.llm import bpe, decontaminate, exact_dedup, near_dedup, toxicity
from lumengrid.llm.common import clear, made, saved, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", near_dedup.stage),
    ("decontamination", decontaminate.stage),
    ("bpe", bpe.stage),
]

#: The first stage is a learnt model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again as the next one's input. What was written before it is then deleted."""
    docs, since = table(spark, sf_dir, "documents"), made()
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        clear(spark, since, made() - 1)
    return docs
