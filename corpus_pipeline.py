"""A corpus pipeline: each stage works on all that its predecessor kept.

``run`` applies the stages to ``documents``; every stage's rows are written to the
shared scratch folder and read again as the next one's input. All stages but the
last return the columns of ``documents``; the last returns the digest of the token
files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstrata.llm import decontam, mixing, neardup, quality, tokenfile
from snapstrata.llm.common import stored, table
from snapstrata.llm.queries import tokenizer_path
from snapstrata.session import scratch_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the classifier scores under 0.5; it is fitted on all labels."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality.with_quality(docs, model, score="__quality")
    return scored.where(F.col("__quality") >= 0.5).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each class of near-duplicates."""
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.whole_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and reads their digest back, one row for each row of ``docs``."""
    path = scratch_dir(spark, "pipeline-tokens")
    tokenfile.write_token_files(docs, path, tokenizer_path())
    return tokenfile.id_checksums(tokenfile.read_token_files(spark, path))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]

#: SQL expresses neither the classifier nor the sketches; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
