"""A corpus from documents to token files, one operator a stage.

Each stage takes the table that the one before has written and returns its own; all but the last return the columns of
``documents``, extra ones too.  A stage decides by row: rows with a null or a repeated id, and null and empty texts, are judged by
their own text as any other.  An empty table gives an empty one at every stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from swathline.llm import decontaminate, mixing, simhash, tokenstore, toxicity
from swathline.llm.textkit import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labels, does not score as toxic; without labels all are kept."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id (null last), of each class of near copies; null and empty texts are one class."""
    return simhash.keep_one(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item; an empty benchmark keeps all."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them; a null source is a source."""
    return mixing.mixed_rows(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, in ascending order of ids (null first), and each document's place and digest as read back from them."""
    import public_tokenizers

    return tokenstore.encoded(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_test_items),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: No SQL can express the learned and the hashed stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
