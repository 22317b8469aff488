"""A corpus from raw documents: quality rules, toxicity, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents. Rows without a doc_id stay unless a stage rejects
their text; labels are read from sf_dir.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwise.llm import near_dedup, packing, personal_data, quality_rules, toxicity
from tillwise.llm.common import ship, table
from tillwise.llm.queries import PACKING_END, PACKING_TOKENIZER
from tillwise.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, and one row of it."""
    return near_dedup.keep(docs).select(*docs.columns)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every span of personal data replaced by its kind; n_chars follows the new text."""
    return personal_data.redacted(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(PACKING_TOKENIZER), PACKING_END)


def _shipped(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality rules", _shipped(quality_stage)),
    ("toxicity", _shipped(toxicity_stage)),
    ("near-duplicates", _shipped(near_dedup_stage)),
    ("personal data", _shipped(personal_data_stage)),
    ("packing", _shipped(packing_stage)),
]
#: Calibrated cutoffs, trained models and packing are beyond SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
