"""Line dedup: repeated line runs by a suffix array over line ids, built by prefix doubling.

The corpus is one sequence of lines per document.  A position's rank orders its suffix by the
first 1, 2, 4, ... lines; each doubling sorts the pairs (rank here, rank 2^k lines on) over the
cluster and numbers the distinct pairs in order.  Only lines that occur twice are positions: any
other line ends every repeated run.  Doubling stops at the longest window that is asked for.

A run is repeated if another place has the same lines; what counts is at least ``min_words``
words.  The maximal repeated runs of that many words are exactly the union of the windows that
reach ``min_words`` with as few lines as possible, forwards from each line and backwards from it
(a run that long holds, for each of its lines, one such window around it).  The ranks at level k name
any window of 2^k to 2^(k+1) lines by its first and last 2^k lines; positions of one name form an
LCP interval of that length.  Every window but an interval's first occurrence (by id, then line)
is a later copy, and the lines it covers are deleted.

Each step is an equi-join, a minimum or a sort over positions: a line or passage of any number of
copies is never gathered.  Shuffled: a few small rows per line, and the texts once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.common import Scratch, row_blocks

MIN_WORDS = 50


def _windows(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """``(first line, lines)`` of the shortest windows of ``min_words`` words, forwards from each
    line and backwards from it.  A line without words counts as one."""
    ends = np.concatenate([[0], np.cumsum(np.maximum(words, 1))])
    n = len(words)
    start = np.arange(n)
    stop = np.searchsorted(ends, ends[start] + min_words)          # first end that reaches it
    forward = {(int(a), int(b - a)) for a, b in zip(start, stop) if b <= n}
    begin = np.searchsorted(ends, ends[start + 1] - min_words, side="right") - 1
    backward = {(int(a), int(e + 1 - a)) for a, e in zip(begin, start) if ends[e + 1] >= min_words}
    return sorted(forward | backward)


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per line: ``(doc, at, line, windows)``; windows start at the line, as line counts."""
    def run(batches):
        for b in row_blocks(batches, 256):
            doc, at, line, size = [], [], [], []
            for d, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                parts = text.encode("utf-8", "surrogatepass").split(b"\n")
                begins: dict[int, list[int]] = {}
                for a, m in _windows([len(p.split()) for p in parts], min_words):
                    begins.setdefault(a, []).append(m)
                for i, p in enumerate(parts):
                    doc.append(d)
                    at.append(i)
                    line.append(xxhash.xxh3_128_digest(p))
                    size.append(begins.get(i, []))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, b.column(0).type), pa.array(at, pa.int64()), pa.array(line, pa.binary()),
                 pa.array(size, pa.list_(pa.int64()))], ["doc", "at", "line", "windows"])

    return docs.mapInArrow(run, "doc struct<id:bigint,t:binary>, at long, line binary, windows array<bigint>")


def _numbered(keys: DataFrame, *cols: str) -> DataFrame:
    """``keys`` (distinct) with ``rank``, increasing in the order of ``cols``: sorted by range,
    so partition number and place in it give the order.  Write it before use."""
    return keys.orderBy(*cols).withColumn("rank", F.monotonically_increasing_id())


def suffix_ranks(spark: SparkSession, scratch: Scratch, lines: DataFrame, longest: int) -> list[DataFrame]:
    """``(doc, at, rank)`` for levels 0, 1, ...: ranks of suffixes by their first 2^level lines,
    up to the level with 2^(level + 1) > ``longest``.  Positions whose first 2^level lines are not
    a run of repeated lines are left out."""
    often = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("line")
    ids = scratch.save(_numbered(often, "line"))
    levels = [scratch.save(lines.select("doc", "at", "line").join(ids, "line").select("doc", "at", "rank"))]
    step = 1
    while 2 * step <= longest:
        here = levels[-1]
        there = here.select("doc", (F.col("at") - step).alias("at"), F.col("rank").alias("after"))
        pairs = here.join(there, ["doc", "at"])
        named = scratch.save(_numbered(pairs.groupBy("rank", "after").agg(F.count(F.lit(1)).alias("n"))
                                       .where("n > 1").select(F.col("rank").alias("first"), "after"), "first", "after"))
        levels.append(scratch.save(
            pairs.withColumnRenamed("rank", "first").join(named, ["first", "after"]).select("doc", "at", "rank")))
        step *= 2
    return levels


def repeated_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc, cut)``: for each document that loses lines, their numbers in order.

    ``doc`` is ``struct(id, t)`` with a digest of the text: rows of equal id and text are one
    document, rows of one id and different texts come one after the other by digest.  Null texts
    have no lines; rows with a null id come first.
    """
    scratch = Scratch(spark, "lines")
    texts = docs.where(F.length(text_col) > 0).select(document_key(id_col, text_col).alias("doc"),
                                                      F.col(text_col).alias("text"))
    lines = scratch.save(_lines(texts, min_words))
    once = lines.groupBy("doc", "at").agg(F.first("line").alias("line"), F.first("windows").alias("windows")) \
        if lines.where("at = 0").groupBy("doc").count().where("count > 1").take(1) else lines
    longest = once.select(F.max(F.array_max("windows"))).first()[0] or 0
    levels = suffix_ranks(spark, scratch, once.select("doc", "at", "line"), longest) if longest else []
    windows = once.select("doc", "at", F.explode("windows").alias("m"))
    copies = None
    for level, ranks in enumerate(levels):
        w = windows.where((F.col("m") >= 2 ** level) & (F.col("m") < 2 ** (level + 1)))
        last = ranks.select("doc", F.col("at").alias("tail"), F.col("rank").alias("after"))
        named = scratch.save(w.join(ranks, ["doc", "at"]).withColumn("tail", F.col("at") + F.col("m") - 2 ** level)
                             .join(last, ["doc", "tail"]).select("doc", "at", "m", "rank", "after"))
        first = named.groupBy("rank", "after", "m").agg(
            F.min(F.struct("doc", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        later = (named.join(first, ["rank", "after", "m"]).where(F.struct("doc", "at") != F.col("first"))
                 .select("doc", "at", "m"))
        copies = later if copies is None else copies.unionByName(later)
    if copies is None:
        copies = windows.where("false")
    covered = copies.select("doc", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("m") - 1)).alias("at"))
    return covered.groupBy("doc").agg(F.sort_array(F.collect_set("at")).alias("cut"))


def document_key(id_col: str, text_col: str) -> F.Column:
    return F.struct(F.col(id_col).cast("long").alias("id"),
                    F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("t"))


def dedup_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the lines of later copies, plus ``cut_lines`` (their numbers from 0).

    Every row stays; a null or empty text stays as it is; a text of which every line is a later
    copy becomes empty.  ``cut_lines`` replaces a column of that name.
    """
    cuts = repeated_lines(spark, docs, id_col, text_col, min_words).select(F.col("doc.id").alias("_id"), "doc", "cut")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col(f"row.`{text_col}`")
    key = F.struct(F.col(f"row.`{id_col}`").cast("long").alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("t"))
    joined = rows.join(cuts, F.col(f"row.`{id_col}`").cast("long").eqNullSafe(F.col("_id"))
                       & (key == F.col("doc")), "left")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(F.col("cut"), i.cast("long"))), "\n")
    cut = F.coalesce(F.col("cut"), F.array().cast("array<bigint>"))
    return joined.select(
        *[(F.when(F.col("cut").isNull(), text).otherwise(kept) if c == text_col else F.col(f"row.`{c}`")).alias(c)
          for c in docs.columns if c != "cut_lines"], cut.alias("cut_lines"))
