"""Registered queries of the operators in this folder; each reads its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import bpe, brown, chatrepair, crosspolytope, crosstoken, decontaminate, langid, lengths, licenses, linededup, secrets, setjoin, warc
from pitpanel.llm.common import shared_folder, table
from pitpanel.llm.sql import SQL  # noqa: F401


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return licenses.digest(licenses.scan(docs.select("doc_id", "text")))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "line_dedup.n_lines", "line_dedup.n_removed", F.sha2("text", 256).alias("text_sha256"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("benchmark_matches").alias("m"))
    return found.groupBy("doc_id", F.col("m.item_id").alias("item_id")).agg(
        F.count("*").alias("n_segments"), F.min("m.edits").alias("least_edits"), F.min("m.place").alias("first_place"))


def vocabulary() -> bpe.Vocabulary:
    return bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), vocabulary())
    return coded.select(
        "doc_id",
        F.floor(F.length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write(table(spark, sf_dir, "pages"), shared_folder(spark, "warc"))
    return warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs)
    return found.select(
        "doc_id",
        langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("langid_prediction.lang").alias("lang_pred"),
        F.col("langid_prediction.score").alias("score"),
    )


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.Codec(spark, vocabulary())
    docs = table(spark, sf_dir, "documents").select(codec.encode(F.col("text")).alias("ids"))
    return lengths.histogram(docs, F.length("ids") / 4)


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.near_duplicates(table(spark, sf_dir, "embeddings"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return chatrepair.report(rows, chatrepair.damage(rows))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return crosstoken.score(table(spark, sf_dir, "documents").select("doc_id", "text"), *files)


def op13_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.Ledger(spark)
    ledger.scan(docs)
    return secrets.digest(ledger.paths(docs))


QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_line_dedup": op2_line_dedup,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_warc": op5_warc,
    "op6_language_id": op6_language_id,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_token_counts": op8_token_counts,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_alignment": op12_token_alignment,
    "op13_secret_scans": op13_secret_scans,
}
