"""The corpus pipeline: stages over whole documents, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame.  It works on all
that its predecessor kept, and all but the last return the columns of
documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contraluz.llm import (benchmark_containment, byte_bpe, language_crf,
                           near_duplicates, surrogates)
from contraluz.llm.common import few, held_out, stored, table
from contraluz.session import checkpoint_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LEAST_SCORE = 0.3  # mean posterior of the likeliest language
SURROGATE_KEY = "surrogates of the corpus pipeline"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a letter, or in which no language
    reaches the least score, go.  The CRF learns from rows that name a language."""
    known = docs.where(language_crf.learnable("doc_id", held_out("doc_id", 3, 1)))
    model = language_crf.train(known)
    rows = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    judged = language_crf.predict(rows, "text", model)
    return judged.where((F.col("lang_pred") != language_crf.UNKNOWN)
                        & (F.col("score") >= LEAST_SCORE)).select("__row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class of texts, the least by id, null last,
    and text.

    Ids play no part in the classes: unlike texts of one id are judged each on
    its own.  A text without words is like no other; of its repeated rows of one
    id one stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    removed = stored(near_duplicates.surplus(docs).toDF("__id", "__digest"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & near_duplicates.digest("text").eqNullSafe(
        F.col("__digest"))
    kept = docs.join(few(removed), same, "left_anti")
    twice = stored(kept.where(F.col("doc_id").isNotNull() | near_duplicates.worded("text")).groupBy(
        F.col("doc_id").alias("__id"), near_duplicates.digest("text").alias("__digest"))
        .count().where("count > 1").drop("count"))
    if not twice.head(1):
        return kept
    one = kept.join(few(twice), same, "left_semi").groupBy(
        "doc_id", near_duplicates.digest("text")).agg(F.min(F.struct(*columns)).alias(
            "__row")).select(*[F.col(f"__row.`{c}`") for c in docs.columns])
    return kept.join(few(twice), same, "left_anti").unionByName(one)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text does not contain a benchmark item."""
    return benchmark_containment.clean(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; n_chars follows the text."""
    replaced = surrogates.replace(docs, SURROGATE_KEY, entities="__entities").drop("__entities")
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.coalesce(
        F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text by the byte-level BPE vocabulary, and their number."""
    codec = byte_bpe.Codec(byte_bpe.read_ranks(
        public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN)
    return byte_bpe.encode(docs, "text", codec, out="token_ids").withColumn(
        "n_tokens", F.size("token_ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("private_data", private_data),
    ("encode_tokens", encode_tokens),
]

#: The stages learn, detect and hash beyond what SQL expresses.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; what each keeps is a Parquet table in the shared folder."""
    home = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{home}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
