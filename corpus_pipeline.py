"""Corpus pipeline over the table ``documents``: quality, toxicity, near duplicates, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. Every stage's result is written as Parquet and read again as the next stage's
documents. All but the last return the columns of ``documents``; the last returns
where each document is packed. ``run`` deletes what a stage wrote once the next one is stored.

Every stage, by case. Null, empty and wordless texts are judged like any text by the first two
stages and packed with length 0; near duplicates keep one row of them for each doc_id. Very long
texts are taken whole. Ties: of near duplicates the smallest doc_id stays, then the smallest
text. Repeated rows are judged alike; near duplicates keep one. Rows with a null doc_id, source
or lang stay rows (nulls are a site of their own; a null doc_id is no duplicate). Without labels
nothing is rejected; empty documents give empty results. Extra columns, whatever their names,
pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratamart.llm.common import release, stored, table
from stratamart.llm.jaccard_join import keep_one
from stratamart.llm.packing import pack
from stratamart.llm.quality import drop_poor
from stratamart.llm.toxicity import drop_toxic
from stratamart.session import scratch_paths


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior of being good is high enough."""
    return drop_poor(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked sets of five-word shingles (Jaccard 0.8 and more)."""
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document kept."""
    return pack(docs)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("packing", packing)]

#: The first two stages are trained models, which SQL cannot express; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    others = set(scratch_paths(spark))
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # The stage's input and everything that it wrote on the way have been read by now.
        release(spark, [p for p in scratch_paths(spark) if p not in others and p != docs.scratch])
    return STAGES[-1][1](spark, docs, sf_dir)
