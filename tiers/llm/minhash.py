"""MinHash near-duplicates: one-permutation hashing, banded buckets, star-shaped candidates.

1. Every text becomes its set of word shingles.  One permutation (the shingle's 64-bit hash)
   deals the set over ``bands * rows`` bins by its high bits; a bin keeps its smallest value,
   and an empty bin borrows from the first full bin of its own fixed random sequence (optimal
   densification).  ``rows`` neighbouring bins are a band; each band's hash is a bucket key.
2. Documents with equal sets are one class, represented by the smallest id.
3. Each bucket links its members to its smallest member only (a star), so a bucket of n
   classes gives n - 1 candidates.  Candidates are confirmed on full sets.
4. A star alone can miss a link between two members of which one is far from the centre.
   Members that the confirmed links leave outside their centre's component are therefore compared
   with that whole component and with each other, in blocks that return links only.  No bucket
   is capped.

With 32 bands of 5 rows a pair at similarity 0.8 shares no bucket with probability 3e-6.
Shuffled per document: 32 bucket rows, the text once (only documents in shared buckets go on)
and, for those, their shingle hashes per candidate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from tiers.llm.common import Scratch, mix64, row_blocks, shingle_set
from tiers.llm.components import connected_components

BANDS, ROWS = 32, 5
TRIES = 64
BLOCK = 256


class OnePermutation:
    """Band hashes of a shingle set."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS):
        self.bands, self.rows, n = bands, rows, bands * rows
        self.bounds = (np.arange(n + 1, dtype=object) * (1 << 64) // n)
        self.bounds = np.array([int(x) for x in self.bounds[:n]], np.uint64)
        seeds = np.arange(n * TRIES, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)
        self.donors = (mix64(seeds) % np.uint64(n)).astype(np.int64).reshape(n, TRIES)

    def sketch(self, shingles: np.ndarray) -> np.ndarray:
        starts = np.searchsorted(shingles, self.bounds)
        ends = np.append(starts[1:], len(shingles))
        full = starts < ends
        values = shingles[np.minimum(starts, len(shingles) - 1)]
        empty = np.flatnonzero(~full)
        if len(empty):
            hit = full[self.donors[empty]]
            first = hit.argmax(1)
            donor = self.donors[empty, first]
            late = ~hit[np.arange(len(empty)), first]
            if late.any():  # very small sets: the next full bin after the last try
                filled = np.flatnonzero(full)
                at = np.searchsorted(filled, self.donors[empty[late], -1]) % len(filled)
                donor[late] = filled[at]
            values[empty] = values[donor]
        return values

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        v = self.sketch(shingles).reshape(self.bands, self.rows)
        acc = np.arange(self.bands, dtype=np.uint64)
        for i in range(self.rows):
            acc = mix64(acc ^ v[:, i]) + np.uint64(0x9E3779B97F4A7C15)
        return acc.view(np.int64)


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int, bands: int, rows: int) -> DataFrame:
    """``(id, n_shingles, set_hash, keys)`` per row; no set, no hash and no keys without words."""
    def run(batches):
        oph = OnePermutation(bands, rows)
        for b in row_blocks(batches):
            ids, n, hashes, keys = b.column(0), [], [], []
            for text in b.column(1).to_pylist():
                s = shingle_set(text, k)
                n.append(len(s))
                hashes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(oph.band_keys(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(hashes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "n_shingles", "set_hash", "keys"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, "id long, n_shingles long, set_hash binary, keys array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """``(id, shingles)``: the sorted 64-bit shingle hashes of each ``(id, t)`` row, packed."""
    def run(batches):
        for b in row_blocks(batches):
            packed = [shingle_set(t, k).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


@pandas_udf(LongType())
def shared_count(a, b):
    """Size of the intersection of two packed shingle sets."""
    return pd.Series([
        len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
        for x, y in zip(a, b)], dtype="int64")


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs(centre, member)`` with the sizes of both full sets and of the common set."""
    left = sets.select(F.col("id").alias("member"), F.col("shingles").alias("m_set"))
    right = sets.select(F.col("id").alias("centre"), F.col("shingles").alias("c_set"))
    return pairs.join(left, "member").join(right, "centre").select(
        "centre", "member", shared_count("c_set", "m_set").alias("common"),
        (F.octet_length("c_set") / 8).cast("long").alias("n_centre"),
        (F.octet_length("m_set") / 8).cast("long").alias("n_member"))


def _linked(percent: int):
    return F.col("common") * 100 >= (F.col("n_centre") + F.col("n_member") - F.col("common")) * percent


def _against_components(visitors: DataFrame, placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of each visitor ``(home, id)`` to the members of the component ``home`` and to its
    other visitors, as forests that connect the same documents.

    Members and visitors are dealt to blocks of ``BLOCK`` rows; a task compares one block of each
    and returns fewer links than it has rows."""
    inside = (visitors.select("home").distinct().join(placed, F.col("home") == F.col("component"))
              .select("home", F.col("node").alias("id")).unionByName(visitors))
    m_size = inside.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("m_blocks"))
    v_size = visitors.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("v_blocks"))
    size = m_size.join(v_size, "home")
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    m = inside.join(size, "home").select("home", "id", F.lit(0).alias("side"), deal("m_blocks").alias("mb"),
                                         every("v_blocks").alias("vb"))
    v = visitors.join(size, "home").select("home", "id", F.lit(1).alias("side"), every("m_blocks").alias("mb"),
                                           deal("v_blocks").alias("vb"))

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        m, v = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        found, root = [], {}

        def top(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        if len(m) and len(v):
            packed = [np.frombuffer(x, np.uint64) for x in m["shingles"]]
            size = np.array([len(x) for x in packed])
            flat, starts = np.concatenate(packed), np.concatenate([[0], np.cumsum(size)[:-1]])
            ids = m["id"].to_numpy()
            for i, x in zip(v["id"].tolist(), v["shingles"]):
                own = np.frombuffer(x, np.uint64)
                at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
                common = np.add.reduceat((own[at] == flat).astype(np.int64), starts)
                hit = (common * 100 >= (len(own) + size - common) * percent) & (ids != i)
                for j in ids[hit].tolist():
                    a, b = top(i), top(j)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        found.append((j, i))
        return pd.DataFrame(found, columns=["centre", "member"], dtype="int64")

    return (m.unionByName(v).join(sets, "id").groupBy("home", "mb", "vb")
            .applyInPandas(links, "centre long, member long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Two documents are linked if ``100 * |A n B| >= percent * |A u B|`` for their ``k``-word
    shingle sets.  ``component_id`` is the smallest id reachable by links, ``kept`` says whether
    it is the document's own.  A null or wordless text is linked with nothing.  Rows with one id
    are one document (their links add up); a row with a null id is kept and linked with nothing.
    """
    scratch = Scratch(spark, "minhash")
    base = scratch.save(sketches(docs, id_col, text_col, k, bands, rows))
    named = base.where("id is not null and set_hash is not null")
    classes = named.groupBy("set_hash").agg(F.min("id").alias("rep"))
    member_of = named.select("id", "set_hash").join(classes, "set_hash").select("id", "rep").distinct()
    reps = named.join(classes.select("set_hash", F.col("rep").alias("id")), ["set_hash", "id"], "left_semi") \
        .dropDuplicates(["set_hash", "id"])

    # Buckets of two classes at least, with their smallest class as the centre.
    rows_of = reps.select("id", F.explode("keys").alias("key"))
    centres = rows_of.groupBy("key").agg(F.min("id").alias("centre"), F.max("id").alias("last")) \
        .where("centre < last").select("key", "centre")
    buckets = scratch.save(rows_of.join(centres, "key"))
    star = buckets.where("id <> centre").select("centre", F.col("id").alias("member")).distinct()
    wanted = buckets.select("id").distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t")) \
        .join(wanted, "id").dropDuplicates(["id", "t"])
    sets = scratch.save(shingle_sets(texts, k))
    tested = scratch.save(_confirm(star, sets))
    links = tested.where(_linked(percent)).select("centre", "member")
    copies = member_of.where("id <> rep").select(F.col("rep").alias("centre"), F.col("id").alias("member"))
    first = scratch.save(connected_components(spark, links, "centre", "member"))

    # Members that a bucket still holds outside its centre's component.
    placed = (buckets.join(first.select(F.col("node").alias("id"), "component"), "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    homes = placed.groupBy("key").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.min(F.when(F.col("id") == F.col("centre"), F.col("component"))).alias("home")).where("lo < hi").select("key", "home")
    apart = scratch.save(placed.join(homes, "key").where("component <> home").select("home", "id").distinct())
    more = _against_components(apart, first, sets, percent)
    stars = first.select(F.col("component").alias("centre"), F.col("node").alias("member"))
    final = connected_components(spark, stars.unionByName(copies).unionByName(more), "centre", "member")

    return (base.select("id", "n_shingles").join(final.withColumnRenamed("node", "id"), "id", "left")
            .select("id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True))))
