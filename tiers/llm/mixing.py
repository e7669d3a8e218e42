"""Mixing sources to target weights by the cube method.

Every source's target share of all words is found by filling: shares by weight, at most
``max_ratio`` times a source's size, the excess given to the others by weight.  A source's ratio
target / size is taken as its whole part (copies of every document) and a fraction, which is
each document's inclusion probability for one copy more.

Flight: the fractions move along vectors that keep both the number of documents and the number
of words, until each is 0 or 1.  Heavy documents, of at least 1 / ``HEAVY`` of their block's words, move first, each
against all the lighter ones (the projection onto the constraints' null space; where that is empty, of the words alone;
one whose words the lighter ones could not make up for if it were taken is left out, and the other way round);
the others by threes, which always have such a vector.  Documents are dealt to blocks of a bounded size by a hash, so a
source of any size is many tasks; each block leaves at most ``LANDING`` open documents of mixed sizes and two more.  These
meet in the next level's blocks, until one block per source is left.  Landing: of all roundings of its last open
documents, the one whose words, then documents, miss their sums least.  Sources of every size go the same way.

The random steps are seeded by source, block and level, and rows are ordered by size and id
inside a block: a rerun takes the same documents.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiers.llm.common import Scratch, word_count

BLOCK_ROWS = 4096
WEIGHTS = (1, 2, 3)
MAX_RATIO = 3
HEAVY = 1000       # a document of at least this part of its block's words moves against all lighter ones
LANDING = 12       # documents that a block's flight leaves open, and at most two more
COPIES = 1 << 16   # equal rows numbered at a time


def source_targets(sized: DataFrame, weights=WEIGHTS, max_ratio: int = MAX_RATIO) -> DataFrame:
    """``(source, rank, source_size, source_docs, target)`` of ``(source, size)`` rows.

    Sources by code point, null last; the weights repeat.  One row per source meets in one task.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    # Filling: in order of cap per weight, a source is capped while the level of the rest is above it.
    cap = F.col("source_size") * max_ratio
    by_cap = Window.orderBy("per_weight", "rank")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    levels = (ranked.withColumn("per_weight", cap / F.col("weight"))
              .withColumn("total", F.sum("source_size").over(whole))
              .withColumn("level", (F.col("total") - F.coalesce(F.sum(cap).over(before), F.lit(0)))
                          / F.sum("weight").over(onward))
              .withColumn("ok", F.when(F.col("level") <= F.col("per_weight"), F.col("level"))))
    fill = levels.withColumn("fill", F.first("ok", ignorenulls=True).over(
        by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return fill.select("source", "rank", "source_size", "source_docs",
                       F.least(cap.cast("double"), F.col("fill") * F.col("weight")).alias("target"))


def _spread(sizes: np.ndarray, p: np.ndarray, heavy: int, light: np.ndarray, rng: random.Random) -> np.ndarray:
    """Move the ``heavy`` document's probability to 0 or 1 against the ``light`` ones (as far as they reach).

    One that all other open documents together can only let go, or only make room for, has no choice."""
    others = (p > 0) & (p < 1)
    others[heavy] = False
    can_go = p[heavy] * sizes[heavy] <= ((1 - p[others]) * sizes[others]).sum()
    can_stay = (1 - p[heavy]) * sizes[heavy] <= (p[others] * sizes[others]).sum()
    for _ in range(len(light) + 1):
        light = light[(p[light] > 0) & (p[light] < 1)]
        if not 0 < p[heavy] < 1 or not len(light):
            break
        s = sizes[light]
        mean = s.mean()
        apart = s - mean
        by = -1 / len(s) - (sizes[heavy] - mean) * apart / max((apart ** 2).sum(), 1e-9)
        if not (apart ** 2).sum() > 1e-9 or np.abs(by).max() > 1:  # documents and words cannot both be kept, or not within reach
            if not (s > 0).any():
                break
            by = -sizes[heavy] * s / (s ** 2).sum()
        at, step = np.append(light, heavy), np.append(by, 1.0)
        at, step = at[step != 0], step[step != 0]
        up = np.where(step > 0, (1 - p[at]) / step, -p[at] / step).min()
        down = np.where(step > 0, p[at] / step, (p[at] - 1) / step).min()
        odds = rng.random() * (up + down) < down
        t = up if (odds if can_go == can_stay else can_stay) else -down
        x = p[at] + t * step
        p[at] = np.where(x < 1e-9, 0.0, np.where(x > 1 - 1e-9, 1.0, x))
    return p


def flight(sizes: list[int], probs: list[float], rng: random.Random, leave: int = LANDING) -> list[float]:
    """Move the probabilities to 0 or 1, keeping their sum and their sum weighted by size, until at most ``leave + 2``
    are open.  ``sizes`` descend."""
    p, size = np.array(probs, float), np.array(sizes, float)
    rest = np.flatnonzero((p > 0) & (p < 1))
    if len(rest) <= leave + 2:
        return p.tolist()
    # Left for landing: documents of all sizes, so that their roundings come near any sum.
    kept = rest[len(rest) * (2 * np.arange(leave) + 1) // (2 * leave)]
    total, rest = size[rest].sum(), np.setdiff1d(rest, kept)
    for k, i in enumerate(rest[size[rest] * HEAVY >= max(1.0, total)]):
        p = _spread(size, p, i, rest[k + 1:], rng)
    p = p.tolist()
    waiting = iter([i for i in rest.tolist() if 0 < p[i] < 1])
    held: list[int] = []
    while True:
        while len(held) < 3:
            i = next(waiting, None)
            if i is None:
                break
            held.append(i)
        if len(held) == 3:
            a, b, c = (sizes[i] for i in held)
            step = [b - c, c - a, a - b] if not a == b == c else [1, -1, 0]
        elif len(held) == 2 and sizes[held[0]] == sizes[held[1]]:
            step = [1, -1]
        else:
            return p
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(held, step) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(held, step) if d)
        t = up if rng.random() * (up + down) < down else -down
        for i, d in zip(held, step):
            x = p[i] + t * d
            p[i] = 0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x
        held = [i for i in held if 0 < p[i] < 1]


def land(sizes: list[int], probs: list[float]) -> list[float]:
    """Round the open probabilities so that the words, then the documents, miss their sums least."""
    p = np.array(probs, float)
    held = np.flatnonzero((p > 0) & (p < 1))
    if len(held):
        size = np.array(sizes, float)[held]
        ways = np.arange(1 << len(held))[:, None] >> np.arange(len(held)) & 1
        words, docs = np.abs(ways @ size - p[held] @ size), np.abs(ways.sum(axis=1) - p[held].sum())
        p[held] = ways[np.lexsort((np.round(docs, 6), np.round(words, 6)))[0]]
    return p.tolist()


def _level(rows: DataFrame, seed: int, level: int, last: bool) -> DataFrame:
    """One flight (and the landing in the last) of ``(rank, block, at, id, size, p)`` rows."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "id", "at"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        rng = random.Random(f"{seed}:{level}:{key[0]}:{key[1]}")
        sizes = pdf["size"].tolist()
        p = flight(sizes, pdf["p"].tolist(), rng)
        pdf["p"] = land(sizes, p) if last else p
        if level == 0:
            pdf["at"] = [f"{key[1]}.{i}" for i in range(len(pdf))]
        return pdf

    return rows.groupBy("rank", "block").applyInPandas(
        run, f"rank int, block long, at string, id {id_type}, size long, p double")


def mix(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", weights=WEIGHTS, max_ratio: int = MAX_RATIO, block_rows: int = BLOCK_ROWS,
        seed: int = 7) -> DataFrame:
    """``(id, source, size, source_size, target, copies, taken)`` per row of ``docs``.

    ``size`` is the text's number of words (0 for a null or empty text), ``copies`` how often the
    mix holds the row, ``taken`` its words times copies.  A null source is a source of its own.
    Rows with equal ids (or none) are separate rows, told apart by a number, so they too are dealt to many
    blocks.  An empty table gives no rows.
    """
    scratch = Scratch(spark, "mixing")
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                        word_count(F.col(text_col)).alias("size"))
    many = (sized.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("times"))
            .withColumn("run", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / COPIES)))))
    here = F.least(F.lit(COPIES), F.col("times") - F.col("run") * COPIES)
    sized = many.withColumn("no", F.explode(F.sequence(F.lit(1).cast("long"), here))).select(
        "id", "source", "size", (F.col("run") * COPIES + F.col("no")).alias("no"))
    sized = scratch.save(sized)
    targets = scratch.save(source_targets(sized, weights, max_ratio))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    names = targets.select(F.col("source").alias("name"), "rank", "source_docs", ratio.alias("ratio"))
    rows = (sized.join(names, F.col("source").eqNullSafe(F.col("name"))).select(
        "rank", F.pmod(F.xxhash64(F.col("id").cast("string"), "size", "no", F.lit(seed)),
                       F.ceil(F.col("source_docs") / block_rows)).alias("block"),
        F.lit("").alias("at"), "id", "size", (F.col("ratio") - F.floor("ratio")).alias("p")))
    dealt = scratch.save(_level(rows, seed, 0, last=False))

    is_open = (F.col("p") > 0) & (F.col("p") < 1)
    open_rows, level = dealt.where(is_open), 0
    settled = []
    while True:
        level += 1
        per = open_rows.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
        most = per.agg(F.max("n")).first()[0]
        last = most is None or most <= block_rows
        blocked = open_rows.join(per, "rank").select(
            "rank", F.pmod(F.xxhash64("at", F.lit(level)), F.ceil(F.col("n") / block_rows)).alias("block"),
            "at", "id", "size", "p")
        moved = scratch.save(_level(blocked, seed, level, last))
        settled.append(moved.where(~is_open))
        if last:
            break
        open_rows = moved.where(is_open)
    late = settled[0]
    for more in settled[1:]:
        late = late.unionByName(more)
    late = late.select("rank", "at", F.col("p").alias("late"))
    return (dealt.join(late, ["rank", "at"], "left").join(targets, "rank")
            .withColumn("copies", (F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                           .otherwise(0.0)) + F.coalesce("late", "p")).cast("int"))
            .select("id", "source", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def apply_mix(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", source_col: str = "source",
              text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every row as often as the mix holds it (not at all, once or repeatedly)."""
    plan = mix(spark, docs, id_col, source_col, text_col, **options)
    # Rows of one id, source and size are interchangeable; they are told apart by their number.
    same = Window.partitionBy("_id", "_source", "_size")
    plan = plan.select(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies") \
        .withColumn("_n", F.row_number().over(same.orderBy("copies"))).where("copies > 0") \
        .select(*[F.col(c).alias(f"mix{c}") for c in ("_id", "_source", "_size", "_n")], "copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("_id"),
                       F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("_size"))
    rows = rows.withColumn("_n", F.row_number().over(same.orderBy(F.xxhash64(F.col(f"row.`{text_col}`")))))
    on = (F.col("_id").eqNullSafe(F.col("mix_id")) & F.col("_source").eqNullSafe(F.col("mix_source"))
          & (F.col("_size") == F.col("mix_size")) & (F.col("_n") == F.col("mix_n")))
    return (rows.join(plan, on).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns]))
