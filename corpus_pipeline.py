"""Corpus cleaning in stages; each works on all that the one before it kept."""

from __future__ import annotations

import os.path
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import delete, folders_read, read, recorded, stage
from plumbline.llm.lines import dedup_lines
from plumbline.llm.packing import pack
from plumbline.llm.pii import redact
from plumbline.llm.quality import filter_quality
from plumbline.llm.simhash import drop_near_duplicates


#: Tables that the stages before wrote for themselves.
_left: list[str] = []


def _tidy(spark: SparkSession, docs: DataFrame, operator: Callable[[], DataFrame]) -> DataFrame:
    """The operator's result, without the tables of earlier stages.

    A stage's result is written before the next one begins, so its own tables are of no
    use then, unless ``docs`` still reads them.
    """
    used = folders_read(docs)
    done = [path for path in _left if os.path.basename(path) not in used]
    delete(spark, done)
    with recorded() as paths:
        found = operator()
    _left[:] = [path for path in _left if path not in done] + paths
    return found


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return _tidy(spark, docs, lambda: filter_quality(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line repeats."""
    return _tidy(spark, docs, lambda: dedup_lines(docs, min_words=5, max_edits=1, exact_words=1))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return _tidy(spark, docs, lambda: drop_near_duplicates(docs, shingle=4, radius=4))


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    return _tidy(spark, docs, lambda: redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces, with their tokens, and their places in sequences of 4096."""
    return _tidy(spark, docs, lambda: pack(docs, capacity=4096))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("PII", redaction),
    ("best-fit packing", packing),
]

#: The vote model, the fingerprints and the tokens are beyond SQL; tests compare
#: every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written, read by the next, and goes after that."""
    docs, before = read(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        found = step(spark, docs, sf_dir)
        with recorded() as paths:
            docs = stage(found, name.lower().replace(" ", "-"))
        delete(spark, before)
        before = paths
    return STAGES[-1][1](spark, docs, sf_dir)
