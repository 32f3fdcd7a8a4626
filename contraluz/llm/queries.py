"""Registered queries of the training-data operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contraluz.llm import (benchmark_containment, byte_bpe, byte_level, language_crf,
                           near_duplicates, one_bit_codes, repeated_windows, surrogates,
                           token_alignment, token_counts, toxicity_grammar, url_templates,
                           whitening, word_table)
from contraluz.llm.common import documents, held_out, table

BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    edited = docs.withColumn("edits", token_counts.revision_edits("doc_id", "text"))
    counted = token_counts.count_with_edits(
        edited, "text", "edits", byte_bpe.read_ranks(RANK_FILE), public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_tokens", "n_tokens_edited", "n_pieces",
                          "n_reencoded", F.sha2("edited", 256).alias("edited_sha256"))


def op2_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_windows.without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = documents(spark, sf_dir), held_out("doc_id", 5, 0)
    model = toxicity_grammar.train(
        docs.where(~held), table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity_grammar.score(docs, "text", model).select(
        "doc_id", held.alias("held_out"), "score", "predicted")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = byte_bpe.Codec(byte_bpe.read_ranks(RANK_FILE), public_tokenizers.PATTERN)
    encoded = byte_bpe.encode(documents(spark, sf_dir), "text", codec)
    digests = encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256)
        .alias("ids_sha256"), "ids")
    decoded = byte_bpe.decode(digests, "ids", codec)
    return decoded.select("doc_id", "n_tokens", "ids_sha256",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


#: a deployment names a secret key of its own
SURROGATE_KEY = "surrogates of the registered query"


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = surrogates.replace(documents(spark, sf_dir), SURROGATE_KEY)
    return replaced.select("doc_id", "text", F.size("entities").alias("n_replaced"),
                           F.to_json("entities").alias("replaced"))


def op6_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_containment.contained(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op7_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(documents(spark, sf_dir)).select("doc_id", "class_id")


def op8_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = held_out("doc_id", 3, 1)
    model = language_crf.train(docs.where(language_crf.learnable("doc_id", held)))
    return language_crf.predict(docs.select("doc_id", "text"), "text", model).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score")


def op9_one_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return one_bit_codes.neighbours(vectors, F.col("vec_id") % 20 == 0, 20)


#: the fixed rules of the query: verdict, host, path
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"),
             ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
             ("block", "com", "/de/")]


def op10_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_templates.judge(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(PIECE_FILE, "rb") as model:
        aligned = token_alignment.align(
            documents(spark, sf_dir), "text", byte_level.Vocabulary(BPE_FILE),
            public_tokenizers.PATTERN, model.read())
    digests = aligned.select(
        "doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("long").alias("n_links"),
        F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("")
        .alias("groups_sha256"), "links")
    return token_alignment.link_counts(digests, "links").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, "embedding", 4)
    rows = whitening.whiten(vectors, "embedding", model).select(
        "vec_id", F.lit(model.n).cast("long").alias("n"), "deviation",
        F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*(F.lit(float(e)) for e in model.explained)).cast("array<double>")
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"))


def op13_word_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_level.Vocabulary(BPE_FILE)
    encoded = word_table.encode(documents(spark, sf_dir), "text", vocabulary,
                                public_tokenizers.PATTERN)
    digests = encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
        .alias("ids_sha256"), "ids")
    decoded = word_table.decode(digests, "ids", word_table.piece_table(spark, vocabulary))
    return decoded.select("doc_id", "n_tokens", "ids_sha256",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_edit_token_counts": op1_edit_token_counts,
    "op2_repeated_windows": op2_repeated_windows,
    "op3_toxicity_grammar": op3_toxicity_grammar,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_surrogates": op5_surrogates,
    "op6_benchmark_containment": op6_benchmark_containment,
    "op7_dart_minhash": op7_dart_minhash,
    "op8_language_crf": op8_language_crf,
    "op9_one_bit_codes": op9_one_bit_codes,
    "op10_url_templates": op10_url_templates,
    "op11_token_alignment": op11_token_alignment,
    "op12_whitening": op12_whitening,
    "op13_word_table": op13_word_table,
}
SQL: dict[str, str] = {
    "op6_benchmark_containment": benchmark_containment.oracle(),
}
