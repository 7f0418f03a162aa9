"""A pipeline over documents: each stage reads what the one before it kept.

1. language identification: documents without text or without a letter go;
2. line dedup: later copies of runs of lines are deleted; documents that lose every line go;
3. n-gram Jaccard join of five words at 0.8: of documents that are connected by links the one with the smallest identifier stays;
4. benchmark decontamination: documents with a benchmark passage go;
5. byte-level BPE: documents become token ids, with digests and proof of the round trip.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitpanel.llm import bpe, decontaminate, langid, linededup, setjoin
from pitpanel.llm.common import release, shared_folder, table
from pitpanel.operators import blocks
from pitpanel.session import stable


#: Words of a shingle and percent of all shingles that near copies share.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def _own(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; null and empty texts and texts without a letter go."""
    found = langid.identify(docs)
    return found.where(F.col("langid_prediction.lang") != langid.UNDETERMINED).select(*_own(docs))


def delete_copied_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without copied lines; a document goes if all its lines were copies. ``n_chars`` follows the text."""
    cleaned = linededup.dedup(docs)
    kept = cleaned.where((F.col("line_dedup.n_removed") == 0) | (F.col("line_dedup.n_removed") < F.col("line_dedup.n_lines")))
    length = F.when(F.col("line_dedup.n_removed") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return kept.select(*[length.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each connected group, that with the smallest identifier; one row if rows repeat it.

    Rows are one document if identifier and text are equal. Rows that share only the identifier are documents of their
    own; among them the text with the smallest SHA-256 comes first. Rows without identifier link with nothing and stay.
    """
    times = docs.groupBy("doc_id").agg(F.count("*").alias("n"), F.min(F.sha2("text", 256)).alias("a"), F.max(F.sha2("text", 256)).alias("b"),
                                       F.count("text").alias("known"))
    named = times.where("doc_id is not null")
    most, several = named.agg(F.max("n"), F.max((~F.col("a").eqNullSafe(F.col("b")) | ~F.col("known").isin(0, F.col("n"))).cast("int"))).first()
    if several:
        docs = _numbered(docs)
    key = "__number" if several else "doc_id"
    joined = setjoin.join(docs, identifier=key, width=NEAR_WIDTH, percent=NEAR_PERCENT)
    gone = stable(joined.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("__gone")).distinct())
    few = gone.count() <= setjoin.BROADCAST_IDS
    del joined
    release(spark)
    kept = docs.join(F.broadcast(gone) if few else gone, docs[key] == F.col("__gone"), "left_anti")
    if (most or 0) > 1:
        kept = kept.where(F.col(key).isNotNull()).dropDuplicates([key]).unionByName(kept.where(F.col(key).isNull()))
    return kept.drop("__number")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each (identifier, text), in the order of identifier and SHA-256 of the text; null without identifier."""
    mark = F.coalesce(F.sha2("text", 256), F.lit("")).alias("__mark")
    pairs = docs.where("doc_id is not null").select("doc_id", mark).distinct()
    numbers = stable(blocks.row_positions(pairs, [], ["doc_id", "__mark"], "__number"))
    marked = docs.withColumn("__mark", mark)
    return stable(marked.join(numbers, ["doc_id", "__mark"], "left").select(*_own(docs), "__number"))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (little-endian, four bytes each), n_tokens, digests, and whether decoding gives the text."""
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    codec = bpe.Codec(spark, vocabulary)
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    coded = docs.select(*kept, "text", codec.encode(F.col("text")).alias("ids"))
    coded = coded.select(*kept, "ids", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), codec.decode(F.col("ids")).alias("decoded"))
    return coded.select(
        *kept, "ids", F.floor(F.length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.sha2("decoded", 256) == F.col("text_sha256")).alias("round_trip"),
    )


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", delete_copied_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_benchmark_passages),
    ("byte_bpe", encode_tokens),
]

#: Byte-pair merges, n-gram models and alignments have no SQL form; tests/llm compares run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
