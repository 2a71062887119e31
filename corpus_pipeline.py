"""A training corpus from raw documents, stage by stage.

Every stage takes all rows its predecessor kept and returns them with the columns of
documents (the last one: sequences of token ids); rows with nulls, empty or repeated
texts are treated as the operators state.
"""

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import crawltable
from crawltable.llm import disclosure, graysim, latent, powers, repetition
from crawltable.workspace import stage

# Executors need not have this folder on their path.
cloudpickle.register_pickle_by_value(crawltable)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: three-word shingles, two bits."""
    return graysim.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return latent.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and disclosing terms replaced."""
    clean = disclosure.sanitise(docs)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, of power-of-two lengths."""
    return powers.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("pii", private),
    ("packing", packing),
]

# Hashing, latent search and tokenizing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"stage-{n}")
    return docs
