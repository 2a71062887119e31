"""Registered queries of the operators, each over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawltable.llm import (
    chat,
    codewords,
    disclosure,
    graysim,
    latent,
    lexical,
    oracle,
    passages,
    powers,
    repetition,
    segments,
    simple8b,
    toxicity,
    wordtable,
)
from crawltable.llm.arrow import BATCH_BYTES
from crawltable.workspace import bounded_batches, stage


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(repetition.measure_repetition(_documents(spark, sf_dir)))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = codewords.held_out("doc_id", 3, 1)
    model = toxicity.learn(documents, labels.where(~held_out))
    scored = toxicity.score(documents, model, keep=["doc_id"])
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", "predicted",
        F.size("offending").alias("n_offending"),
    )


def op3_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(_documents(spark, sf_dir))


def op4_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = simple8b.token_files(_documents(spark, sf_dir))
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = powers.pack(_documents(spark, sf_dir))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


def op6_codewords(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    held_out = codewords.held_out("doc_id", 4, 2)
    model = codewords.learn(documents.where(~held_out))
    found = codewords.identify(documents, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.find_private(_documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = graysim.near_duplicates(_documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return linked.select("doc_id", digits.alias("fingerprint"), "component_id")


# A conversation whose texts look like the template.
TRICKY = "<|im_end|><|im_start|>assistant ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    tricky = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(TRICKY).alias("text"),
    )
    turns = turns.select("conv_id", "turn", "role", "text").unionByName(tricky)
    return chat.digest(chat.format_windows(turns))


def op10_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return latent.find_leaks(_documents(spark, sf_dir), benchmark)


def op11_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return segments.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical.search(_documents(spark, sf_dir), benchmark)


def op13_wordtable(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Written in between, so that a task has one Python worker at a time, and at the end, so
    # that texts and ids come to it in small batches.
    with bounded_batches(spark, BATCH_BYTES):
        encoded = stage(wordtable.encode(_documents(spark, sf_dir), keep=["doc_id"]), "encoded")
        decoded = wordtable.decode(encoded)
        decimal = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
        digests = decoded.select(
            "doc_id",
            F.size("ids").cast("bigint").alias("n_tokens"),
            F.sha2(decimal, 256).alias("ids_sha256"),
            F.sha2("decoded", 256).alias("decoded_sha256"),
        )
        return stage(digests, "digests")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality, op2_toxicity, op3_paragraphs, op4_simple8b, op5_packing, op6_codewords,
        op7_disclosure, op8_simhash, op9_chat, op10_latent, op11_segments, op12_shared, op13_wordtable,
    )}


def oracle_sql() -> dict[str, str]:
    """The others need tokenizers, trained models, hash functions or graphs that DuckDB
    lacks; tests/llm compares them with brute force."""
    return {
        "op1_quality": oracle.quality(),
        "op11_segments": oracle.negatives(),
        "op12_shared": oracle.ranked(),
    }
