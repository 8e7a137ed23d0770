"""From raw documents to a mixed training corpus; each stage's rows are written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table, written
from tidemark.llm.decontamination import decontaminated
from tidemark.llm.language_id import known_languages, profiles
from tidemark.llm.minhash_dedup import keep_one_each
from tidemark.llm.secret_scan import redacted
from tidemark.llm.source_mixing import mixed_sources
from tidemark.session import prepare


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: profiles are learnt from the labelled rows; texts in no learnt language go."""
    return known_languages(docs, profiles(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8 on five-word shingles: the least ``doc_id`` of every group stays."""
    return keep_one_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold four fifths of a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: credentials that look live are redacted, and ``n_chars`` follows."""
    return redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: every document gets its place in a reading order that follows the weights."""
    return mixed_sources(docs)


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("source_mixing", mixing),
]

#: Language profiles are learnt from the rows, which SQL does not express; tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
