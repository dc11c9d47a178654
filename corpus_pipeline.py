"""A corpus pipeline: five stages over ``documents``, each one of the corpus operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. ``run`` writes each stage's result to the shared folder and reads it
again as the next one's input. SQL can't express these stages; tests hold them against
brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeworks.llm import bpe, decontaminate, lines, near_copies, toxicity
from tapeworks.llm.common import cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fit on the labels outside the held-out fold; drop what is predicted toxic."""
    return toxicity.remove_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated and nearly repeated lines out of the texts; every document stays."""
    return lines.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each component of SimHash links and of 5-word Jaccard 0.8 or more."""
    return near_copies.keep_one_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share a window of words with the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text that is left, with digests of ids and decoded text."""
    return bpe.tokenise(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
