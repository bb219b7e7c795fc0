"""The corpus pipeline: stages over ``documents``, each reading what the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the folder
in ``spark.checkpoint.dir`` and hands the reread rows to the next. All stages but the last return the
columns of documents; the last packs what is left into sequences.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statuta.llm import decontamination, lines, packing, simhash, toxicity
from statuta.llm.common import folders, remove, remove_folders, shared_dir, table, written


#: Near-duplicates by the Jaccard similarity of their five-word shingles: candidates from eight fingerprints of 64 bits,
#: of which one may differ in three, each verified; then an exact join for pairs that fingerprints can't show.
NEAR = {"words": 5, "similar": 0.8, "budget": 3, "tables": 8}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled rows among these documents, rejects go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go, and documents that lose all their lines; n_chars follows the text."""
    return lines.remove_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_first(docs, **NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, in their sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", without_toxic), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("packing", pack)]

#: SQL cannot express the stages; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written before the next begins; what only earlier stages read is removed then."""
    docs, before = table(spark, sf_dir, "documents"), None
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES[:-1]):
        here, made = f"{at}/{k}_{name}", folders()
        docs = written(stage(spark, docs, sf_dir), name, here)
        remove_folders(spark, made)
        if before:
            remove(spark, before)
        before = here
    return STAGES[-1][1](spark, docs, sf_dir)
