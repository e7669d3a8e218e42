"""One registered query per operator: production parameters, whole tables, digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm import (align, bpe, ctw, embeddings, langid, lines, merkle, minhash, mixing, piece_counts, pii, spelling,
                       toxicity)
from tiers.llm.common import read_table

RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
BYTE_LEVEL = "byte_bpe_50k.json"


def _remainder(n: int):
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(spark, read_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(read_table(spark, sf_dir, "documents"), RANKS)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(spark, read_table(spark, sf_dir, "documents"))
    def count(kind_no):  # a lambda of two parameters would be given the element's place in the array
        return F.size(F.filter("base", lambda s: s["kind_no"] == kind_no)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(pii.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.spans_text(F.array_sort(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_fingerprints(spark, read_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    dictionaries = langid.fit_dictionaries(docs.where(_remainder(4) != 2))
    return langid.identify(spark, docs, dictionaries).withColumn(
        "held_out", F.coalesce(_remainder(4) == 2, F.lit(False)))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    index = toxicity.fit_index(toxicity.join_labels(docs, labels.select("doc_id", F.col("toxic").alias("label")))
                               .where(_remainder(5) != 0))
    return toxicity.score_texts(spark, docs, index).withColumn(
        "held_out", F.coalesce(_remainder(5) == 0, F.lit(False)))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return minhash.near_duplicates(spark, docs, k=2, percent=80).withColumnRenamed("id", "doc_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, the lines cut as later copies, and a digest of what is left."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    before = F.when(F.length("text") > 0, F.regexp_count("text", F.lit("\n")) + 1).otherwise(0).cast("long")
    done = lines.dedup_lines(spark, docs.withColumn("n_lines", before))
    return done.select("doc_id", "n_lines", F.size("cut_lines").cast("long").alias("n_cut"),
                       F.array_join(F.col("cut_lines").cast("array<string>"), ",").alias("cut_lines"),
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return (ctw.score_texts(spark, docs, train=_remainder(7) != 2).withColumnRenamed("id", "doc_id")
            .withColumn("held_out", F.coalesce(_remainder(7) == 2, F.lit(False))))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its bytes and its tokens under the piece model."""
    return piece_counts.count_tokens(read_table(spark, sf_dir, "documents"), PIECES)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the groups and links of its byte-level tokens and its pieces."""
    return align.align(spark, read_table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES).withColumnRenamed("id", "doc_id")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word of the corpus: its near words, its form and its root."""
    return spelling.variant_groups(spark, read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_byte_bpe, op3_personal_data, op4_document_fingerprints, op5_language_id,
    op6_source_mix, op7_toxicity, op8_minhash_near_dedup, op9_line_dedup, op10_lm_scores, op11_token_counts,
    op12_token_alignment, op13_spelling_variants)}
