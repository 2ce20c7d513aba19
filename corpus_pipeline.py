"""Corpus preparation in stages, each over all that the one before it kept.

Quality rules, near-duplicate removal, passage removal, decontamination and
packing.  Stages return the columns of ``documents``; the last one returns the
places of all token runs.  An empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwatch.llm.common import fresh, landed, table
from linkwatch.llm.decontamination import LEAKS, clean_documents
from linkwatch.llm.packing import pack_documents
from linkwatch.llm.parity_join import Similarity, similar_components
from linkwatch.llm.quality_rules import kept_documents
from linkwatch.llm.queries import END_ID, SEQUENCE
from linkwatch.llm.substring_dedup import deduplicated
from linkwatch.llm.tokens import default_tokenizer

# Near-duplicates of a stage: five words, a Jaccard similarity of 0.8 or more.
NEAR = Similarity(words=5, num=80)


def quality_filtered(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep."""
    return kept_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id of each group of near-duplicates; rows without an id stay.

    A row that repeats the id of a group's first document stays with it.
    """
    groups = similar_components(docs, NEAR)
    later = groups.where(F.col("doc_id") > F.col("component_id"))
    name = fresh(docs.columns, "later_id")
    later = later.select(F.col("doc_id").alias(name)).distinct()
    return docs.join(later, F.col("doc_id") == F.col(name), "left_anti")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of an earlier one; what has no word left goes."""
    cut = deduplicated(docs)
    total, removed = cut.columns[-2:]
    rest = cut.where((F.col(total) == 0) | (F.col(removed) < F.col(total)))
    if "n_chars" in docs.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast("long"))
    return rest.select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands, whole, cut short or edited."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"), LEAKS)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token runs of all documents that are left, packed into sequences."""
    return pack_documents(docs, default_tokenizer(), END_ID, SEQUENCE)


STAGES = [
    ("quality rules", quality_filtered),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed_sequences),
]

# No stage but the first could be put in SQL at whole size; tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
