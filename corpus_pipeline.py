"""Training-data pipeline over ``documents``: named stages, each one call of an operator.

Every stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage
before it kept, and is written as Parquet and read again before the next one.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import decontamination, packing, simhash, substrings, toxicity
from lapsewise.llm.labelled import fold
from lapsewise.llm.queries import END_ID
from lapsewise.session import shared_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject; it learns from the labels outside fold 0."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold("doc_id", 5) != 0)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur more than once; ``n_chars`` follows the text."""
    cleaned = substrings.remove_repeats(docs, keep_layout=True)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' ids as packed sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("substrings", drop_passages),
          ("decontamination", drop_leaks), ("packing", pack)]

#: Toxicity scores and tokenizer ids have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/lapsewise-llm/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
