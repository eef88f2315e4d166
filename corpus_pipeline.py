"""A training corpus from raw documents: good ones, one of each group of near copies, masked, mixed and packed.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from silverline.llm import curriculum, jaccard_join, packing, pii, quality_mil
from silverline.llm.common import bounded_batches, shared_folder, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; the others stay as they are."""
    return quality_mil.keep_good(docs, table(bounded_batches(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar sets of word 5-grams, that of the smallest id stays."""
    bounded_batches(spark)
    return jaccard_join.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets."""
    bounded_batches(spark)
    return pii.mask_personal_data(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat or are left out until each source has its share, in the order they are to be trained on."""
    return curriculum.training_order(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in the training sequences."""
    bounded_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packed),
]

ORACLE_SQL = None  # a trained model and tokens have no SQL; tests compare the stages with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
