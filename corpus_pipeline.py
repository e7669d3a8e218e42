"""The corpus pipeline: documents to tokens, in five stages of the ``llm`` operators.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but the
last return the columns of ``documents``.  ``run`` writes each stage's result as Parquet in the
session's shared scratch folder and reads it again for the next one.
"""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm import bpe, lines, minhash, mixing, toxicity
from tiers.llm.common import Scratch, read_table
from tiers.llm.queries import RANKS

#: Rows of an Arrow batch between Spark and the Python workers, at most.  Both hold a batch of whole texts, several times while
#: it is written, and Spark's 10,000 rows would be tens of MB in every task.
BATCH_ROWS = 1024
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: The cube method's sample is not expressible in SQL; tests/llm hold every stage to a brute-force version.
ORACLE_SQL = None


def _small_batches(spark: SparkSession) -> None:
    """Lowers the session's batches to ``BATCH_ROWS``; smaller ones stay.  A stage's result is worked out after the stage
    has returned, so the setting stays; ``run`` puts the former one back."""
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= BATCH_ROWS:
        spark.conf.set(BATCH_KEY, str(BATCH_ROWS))


def _aside(docs: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with its columns of these names (which a stage uses itself) under other ones, and the way back."""
    back = {}
    for name in names:
        if name in docs.columns:
            other = name
            while other in docs.columns:
                other = f"_{other}"
            docs, back[other] = docs.withColumnRenamed(name, other), name
    return docs, back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5; the labelled ones among them are the examples.

    Each row is judged by its own text: rows of one id or none too.  A null or empty text has the training rate
    for its score, so it stays while fewer than half of the examples are toxic.  Other columns are not looked at; an
    empty table stays empty."""
    _small_batches(spark)
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    index = toxicity.fit_index(toxicity.join_labels(docs, labels))
    return docs.where(toxicity.score_column(spark, index)(F.col("text")) < 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs of 50 words or more; a document of
    which nothing else is left goes.  ``n_chars`` follows the text.

    Null and empty texts stay.  Rows of one id and text are one document and lose the same lines; rows of one id
    and different texts are documents of their own."""
    _small_batches(spark)
    docs, back = _aside(docs, "cut_lines")
    done = lines.dedup_lines(spark, docs)
    lost = F.size("cut_lines") > 0
    return (done.where(~lost | (F.length("text") > 0))
            .withColumn("n_chars", F.when(lost, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*docs.columns).withColumnsRenamed(back))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group (five-word shingles, similarity 0.8): the one of smallest id.

    Every row is a document of its own, whatever its id: two rows of one id and different texts both stay unless
    they are near copies.  Texts without words are near to nothing and stay, null ids too (in a group they come
    last).  The rows are stored with a number, by which the groups are told."""
    _small_batches(spark)
    numbered, _ = _aside(docs, "row_no")
    numbered = Scratch(spark, "near").save(numbered.withColumn("row_no", F.monotonically_increasing_id()))
    groups = minhash.near_duplicates(spark, numbered, id_col="row_no", k=5, percent=80).select(
        F.col("id").alias("row_no"), "component_id")
    kept = (numbered.select("row_no", "doc_id").join(groups, "row_no").groupBy("component_id")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_no")).alias("first"))
            .select(F.col("first.row_no").alias("row_no")))
    return numbered.join(kept, "row_no", "left_semi").drop("row_no").toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document is left out, taken once or repeated.

    A null source is a source of its own; rows of one id are separate rows; a null or empty text weighs nothing."""
    _small_batches(spark)
    return mixing.apply_mix(spark, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, the number of them, and a digest of the bytes they decode to.

    A null or empty text has no tokens and the digest of no bytes.  ``token_ids``, ``n_tokens`` and
    ``decoded_sha256`` replace columns of these names."""
    _small_batches(spark)
    return bpe.encode_and_check(docs, RANKS)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_repeated_lines), ("MinHash near-dedup", drop_near_duplicates),
          ("mixing", mix_sources), ("byte-level BPE", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, rows = read_table(spark, sf_dir, "documents"), spark.conf.get(BATCH_KEY)
    try:
        for _, stage in STAGES:
            before, docs = docs, scratch.save(stage(spark, docs, sf_dir))
            scratch.drop(before)
            gc.collect()  # lets the session drop the broadcasts and shuffles of the stage that is done
    finally:
        spark.conf.set(BATCH_KEY, rows)
    return docs
