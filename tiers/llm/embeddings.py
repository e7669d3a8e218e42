"""Embedding near-duplicates over an inverted multi-index.

Unit vectors are cut in halves; each half has its own codebook (k-means on a bounded sample), and
a vector lies in the cell (nearest codeword of the first half, of the second half) of the product
grid, one grid per label.  For a query, the multi-sequence order visits cells by increasing
distance; here a cell's distance is how far the query lies beyond the borders between its own
cell and that one (0 for its own).  No vector of a cell is nearer to the query than that, so visiting
stops at the distance of unit vectors at exactly the similarity threshold, and no pair is missed.
The grid is used at every size.  Every row is indexed;
found pairs are verified in double precision.

Vectors with equal label and equal components are one class.  A pair of cells is visited from the
lower cell only.  The cells of a label are cut into shards, runs of cells whose vectors one task can
hold; a vector goes once to its own shard and once to each later shard of which it visits any cell,
and the visits take place there, so the copies of a vector follow the shards, not the cells.  Where many
shards make many copies, they are taken in rounds.  A crowded shard is cut into blocks of members
and blocks of visitors, and is many tasks.  A task holds its members, streams its visitors, and gives
per-vector link counts and a spanning forest of its links, never the links themselves.
"""

from __future__ import annotations

import gc
import math
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.llm.common import Scratch, give_back, row_blocks
from tiers.llm.components import connected_components

SAMPLE_ROWS = 8192      # vectors that the codebooks are fitted on
CELL_ROWS = 2048        # classes per label and cell that the grid is sized for
MIN_WORDS, MAX_WORDS = 4, 256  # codewords per half (fewer on a few rows only)
SHARDS, SHARD_ROWS = 3, 2048   # shards of a label at least, if they get so many rows each
SHARD_BYTES = 64 << 20  # of vectors per shard that a label's shards are sized for
FULL = 1.5              # times that size, a shard is cut into blocks
VISITORS = 1            # times its members, a block's visitors are cut
COPIES = 2              # of the vectors that a round deals out, about
TILE = 1024             # members that are compared at once
SEEM = 1e-5             # of the pairs that are apart, those whose short vectors may be near
REACH = 1 << 20         # distances of rows to cells that are held at once
SLACK = 1e-6            # on the radius, for rounding


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (((centres ** 2).sum(1)) - 2 * x @ centres.T).argmin(1)
        for j in range(k):
            if (near == j).any():
                centres[j] = x[near == j].mean(0)
    return centres


class Grid:
    """The two codebooks, and the radius to visit: no pair of at least ``cosine`` lies beyond it."""

    def __init__(self, first: np.ndarray, second: np.ndarray, cosine: float):
        self.books, self.radius = (first, second), math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
        self.before = np.zeros(len(first) * len(second))  # share of the sample in the cells before each one
        self.axes = np.eye(first.shape[1] + second.shape[1])
        self.apart = [np.sqrt(((b[:, None] - b[None]) ** 2).sum(2)) for b in self.books]

    def beyond(self, half: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest codeword, and its distance beyond the border to every codeword's cell."""
        book = self.books[half]
        d2 = np.maximum((x ** 2).sum(1)[:, None] + (book ** 2).sum(1) - 2 * x @ book.T, 0)
        own = d2.argmin(1)
        gap = self.apart[half][own]
        over = (d2 - d2[np.arange(len(x)), own][:, None]) / (2 * np.maximum(gap, SLACK))
        over[gap < SLACK] = 0
        over[np.arange(len(x)), own] = 0
        return own, np.maximum(over, 0)

    def parts(self, x: np.ndarray):
        cut = x.shape[1] // 2
        return self.beyond(0, x[:, :cut]), self.beyond(1, x[:, cut:])

    def cells(self, x: np.ndarray) -> np.ndarray:
        (a, _), (b, _) = self.parts(x)
        return a * len(self.books[1]) + b

    def fit(self, x: np.ndarray, cosine: float) -> None:
        """Where the sample's vectors lie, and the axes along which they differ most, so many that few pairs
        that are apart seem near."""
        n = np.bincount(self.cells(x), minlength=len(self.before))
        self.before = (np.cumsum(n) - n) / max(1, len(x))
        x = x[:TILE]
        axes, apart = np.linalg.svd(x, full_matrices=False)[2].T, x @ x.T < cosine - 0.1
        for m in range(7, axes.shape[1], 8):
            self.axes = axes[:, :m]
            y = self.short(x)
            if ((y @ y.T >= cosine) & apart).sum() <= SEEM * apart.sum():
                return
        self.axes = np.eye(x.shape[1])

    def short(self, x: np.ndarray) -> np.ndarray:
        """Fewer numbers for unit vectors: along the axes, and the length of what is left.  Their product is not
        less than that of the vectors themselves."""
        if self.axes.shape[0] == self.axes.shape[1]:
            return x.astype(np.float32)
        y = x @ self.axes
        return np.column_stack([y, np.sqrt(np.maximum(0, 1 - (y ** 2).sum(1)))]).astype(np.float32)

    def shards(self, n: int) -> np.ndarray:
        """Each cell's shard, if there are ``n`` of about one size; never less than that of a lower cell."""
        return np.minimum((self.before * n).astype(np.int64), n - 1)

    def distances(self, da: np.ndarray, db: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Squared, of rows to ``cells``."""
        w = len(self.books[1])
        return (da ** 2)[:, cells // w] + (db ** 2)[:, cells % w]

    def visits(self, da: np.ndarray, db: np.ndarray, cells: np.ndarray):
        """Multi-sequence traversal for a block of rows: the position in ``cells`` of each cell and the rows that
        visit it, by increasing distance of the nearest row, until that is beyond the radius."""
        d = self.distances(da, db, cells)
        limit = self.radius ** 2
        first, near = d.min(0), d <= limit
        for k in np.argsort(first, kind="stable"):
            if first[k] > limit:
                return
            yield int(k), np.flatnonzero(near[:, k])

    def nearest(self, da2: np.ndarray, db2: np.ndarray, start: int, end: int) -> np.ndarray:
        """Squared distance of rows to the nearest of the cells from ``start`` to before ``end``."""
        (a, b), (c, d) = divmod(start, len(self.books[1])), divmod(end - 1, len(self.books[1]))
        if a == c:
            return da2[:, a] + db2[:, b:d + 1].min(1)
        least = np.minimum(da2[:, a] + db2[:, b:].min(1), da2[:, c] + db2[:, :d + 1].min(1))
        return least if c == a + 1 else np.minimum(least, da2[:, a + 1:c].min(1) + db2.min(1))

    def deal(self, x: np.ndarray, shards: np.ndarray) -> tuple[np.ndarray, ...]:
        """Where rows go whose labels have so many ``shards``: each row's cell; and the row and shard of each copy,
        for the row's own shard first and then the later ones of which it visits any cell."""
        (a, da), (b, db) = self.parts(x)
        home, at, to = a * len(self.books[1]) + b, [], []
        for n in np.unique(shards):
            rows = np.flatnonzero(shards == n)
            names, starts = np.unique(table := self.shards(int(n)), return_index=True)
            own = table[home[rows]]
            da2, db2, ends = da[rows] ** 2, db[rows] ** 2, np.append(starts[1:], len(table))
            near = np.stack([self.nearest(da2, db2, *x) for x in zip(starts, ends)], axis=1) <= self.radius ** 2
            touched = near & (names[None] > own[:, None])
            i, j = np.nonzero(touched | (names[None] == own[:, None]))
            at.append(rows[i])
            to.append(names[j])
        return home, np.concatenate(at), np.concatenate(to)


def fit_grid(sample: np.ndarray, rows_per_label: float, cosine: float, seed: int = 11) -> Grid:
    rng = np.random.default_rng(seed)
    k = max(MIN_WORDS, math.ceil(math.sqrt(rows_per_label / CELL_ROWS * 8)))
    k = max(1, min(MAX_WORDS, len(sample) // 8, k))
    cut = sample.shape[1] // 2
    grid = Grid(_kmeans(sample[:, :cut], k, rng), _kmeans(sample[:, cut:], k, rng), cosine)
    grid.fit(sample, cosine)
    return grid


def _unit(x: np.ndarray) -> np.ndarray:
    """Unit vectors; by their largest component first, so that no square overflows or vanishes."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(packed: pa.Array, number: np.dtype) -> np.ndarray:
    """The rows of a column of packed vectors of one length."""
    packed = packed.cast(pa.binary())
    at = np.frombuffer(packed.buffers()[1], np.int32, len(packed) + 1, packed.offset * 4)
    return np.frombuffer(packed.buffers()[2], np.uint8)[at[0]:at[-1]].view(number).reshape(len(packed), -1)


def _codes(column: pa.Array) -> tuple[np.ndarray, list]:
    """A number for each row's value, and the values (equal ones have one number, also if they are NaN)."""
    try:
        d = column.dictionary_encode()
        return d.indices.to_numpy(zero_copy_only=False), d.dictionary.to_pylist()
    except pa.ArrowNotImplementedError:  # nested
        values: dict[str, int] = {}
        return np.array([values.setdefault(repr(v), len(values)) for v in column.to_pylist()], np.int64), list(values)


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's and column's smallest id reachable inside the block (its own without links)."""
    a, b = left.copy(), right.copy()
    big = np.int64(2 ** 63 - 1)
    while True:
        b2 = np.minimum(b, np.where(linked, a[:, None], big).min(0))
        a2 = np.minimum(a, np.where(linked, b2[None], big).min(1))
        if (a2 == a).all() and (b2 == b).all():
            return a, b
        a, b = a2, b2


class Block:
    """The members of a block, by cell, and what their visitors find.

    Short vectors are compared in single precision, with what its rounding can take; the pairs that are left
    are verified in double precision.  ``low`` is the smallest id that a row is known to be connected
    with; each change of it is an edge.
    """

    def __init__(self, grid: Grid, cosine: float, parts: list[tuple[np.ndarray, ...]]):
        self.grid, self.cosine = grid, cosine
        self.rep, self.times, self.home, self.role, self.raw = (
            np.concatenate([p.pop(0) for p in parts]) for _ in range(len(parts[0])))
        self.short = np.concatenate([grid.short(_unit(self.raw[i:i + TILE])) for i in range(0, len(self.raw), TILE)])
        self.least = np.float32(cosine - (self.raw.shape[1] + 16) * 2.0 ** -23)
        self.low, self.links = self.rep.copy(), np.zeros(len(self.rep))
        self.cells, self.starts = np.unique(self.home, return_index=True)
        self.ends = np.append(self.starts[1:], len(self.home))

    def visit(self, rep: np.ndarray, times: np.ndarray, home: np.ndarray, raw: np.ndarray):
        """``(rep, links, root)`` of visitors."""
        step = max(16, min(4 * TILE, REACH // len(self.cells)))
        for i in range(0, len(rep), step):
            s = slice(i, i + step)
            yield from self._visit(rep[s], times[s], home[s], _unit(raw[s]))

    def _visit(self, rep, times, home, x):
        short = self.grid.short(x)
        (_, da), (_, db) = self.grid.parts(x)
        low, links = rep.copy(), np.zeros(len(rep))
        for k, rows in self.grid.visits(da, db, self.cells):
            rows = rows[home[rows] <= self.cells[k]]
            if not len(rows):
                continue
            mine = short if len(rows) == len(short) else short[rows]
            for j in range(self.starts[k], self.ends[k], TILE):
                cols = slice(j, min(j + TILE, self.ends[k]))
                near = mine @ self.short[cols].T >= self.least
                if near.any():
                    r, c = rows[near.any(1)], j + np.flatnonzero(near.any(0))
                    near = x[r] @ _unit(self.raw[c]).T >= self.cosine
                    near &= rep[r][:, None] != self.rep[c][None]
                    # Pairs inside one cell meet twice (both visit it): each counts for its visitor.
                    links[r] += near @ self.times[c].astype(np.float64)
                    self.links[c] += (near & (home[r] != self.cells[k])[:, None]).T @ times[r].astype(np.float64)
                    a, b = _forest(near, low[r], self.low[c])
                    edges = np.stack([np.concatenate([low[r], self.low[c]]), np.concatenate([a, b])])
                    edges = np.unique(edges[:, edges[0] != edges[1]], axis=1)
                    low[r], self.low[c] = a, b
                    if edges.size:
                        yield _found(edges[0], np.zeros(edges.shape[1]), edges[1])
        some = links > 0
        yield _found(rep[some], links[some], rep[some])

    def own(self):
        """What members find that visit their block too, and after that the links of all members."""
        for i in range(0, len(self.rep), 4 * TILE):
            s = i + np.flatnonzero(self.role[i:i + 4 * TILE] == BOTH)
            if len(s):
                yield from self.visit(self.rep[s], self.times[s], self.home[s], self.raw[s])

    def end(self):
        some = self.links > 0
        yield _found(self.rep[some], self.links[some], self.rep[some])


MEMBER, BOTH, VISITOR = 0, 1, 2  # roles of a row in a block: compared with, that and a visitor, a visitor


def _found(rep: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), pa.array(np.rint(links).astype(np.int64)),
                                       pa.array(root, pa.int64())], ["rep", "links", "root"])


def _free_shuffles(spark: SparkSession) -> None:
    """Lets the driver find out which shuffles no frame needs any more, so that their files go now, not at some time."""
    try:
        for _ in range(2):  # at the first time, what told the listeners of the job may still hold it
            gc.collect()
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.2)
    except Exception:  # a session without a driver of its own
        pass


def near_vectors(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", cosine: float = 0.93) -> DataFrame:
    """``(id, n_links, component_id, kept)`` per row of ``vectors``.

    Rows are compared if their labels are equal and not null; a link is a cosine of at least
    ``cosine``.  Vectors that are null, empty, zero or hold a null or non-finite component link
    with nothing, as do vectors of another length than the rest of their label.  Rows with one id
    are separate vectors that share their component; a row with a null id links with nothing.
    """
    scratch = Scratch(spark, "vectors")
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"  # else in double precision
    number = np.dtype(np.float32 if single else np.float64)
    v = F.col(vector_col).cast("array<float>" if single else "array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v"))
    # Whether a null is there is not known of NaN either: the answer is null.
    plain = ~F.array_contains("v", F.lit(float("nan")).cast("float" if single else "double"))
    low, high = F.array_min("v"), F.array_max("v")
    fits = F.coalesce(F.col("label").isNotNull() & plain & (high < float("inf")) & (low > float("-inf")) &
                      ((high > 0) | (low < 0)), F.lit(False))
    label = vectors.schema[label_col].dataType

    def pack(batches):
        for b in batches:
            v = b.column(2)
            flat = v.flatten().to_numpy(zero_copy_only=False).astype(number) + number.type(0)  # -0 is 0
            ends = np.cumsum(np.append(0, v.value_lengths().to_numpy(zero_copy_only=False))) * number.itemsize
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.Array.from_buffers(
                    pa.binary(), len(v), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)])],
                ["id", "label", "vec"])

    good = rows.where(F.col("id").isNotNull() & fits).select("id", "label", "v").mapInArrow(
        pack, T.StructType().add("id", "long").add("label", label).add("vec", "binary"))
    packed = scratch.save(good.groupBy("label", "vec").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("times")).select(
        "rep", "label", (F.octet_length("vec") / number.itemsize).cast("integer").alias("dim"), "times", "vec"))
    dims = [r.dim for r in packed.groupBy("dim").count().where("count > 1").select("dim").collect()]  # few lengths
    _free_shuffles(spark)
    found = [part for d in sorted(dims)
             for part in _one_length(spark, scratch, packed.where(F.col("dim") == d), label, number, d, cosine)]

    own = packed.select(F.col("rep"), (F.col("times") - 1).alias("links"))
    edges = None
    for part in found:
        own = own.unionByName(part.select("rep", "links"))
        e = part.where("root <> rep").select("rep", "root")
        edges = e if edges is None else edges.unionByName(e)
    links = own.groupBy("rep").agg(F.sum("links").alias("n_links"))
    # A row's class, by a digest of its vector; alone in its class, a row is its own.
    digest = F.unhex(F.sha2("vec", 256)).alias("digest")
    several = scratch.save(packed.where("times > 1").select("label", digest, "rep"))
    member = scratch.save(good.select("id", "label", digest).join(several, ["label", "digest"], "left")
                          .select("id", F.coalesce("rep", "id").alias("rep")))
    copies = member.where("id <> rep").select(F.col("id").alias("rep"), F.col("rep").alias("root")).distinct()
    edges = copies if edges is None else edges.unionByName(copies)
    parts = connected_components(spark, edges, "rep", "root")
    per = member.join(links, "rep").select("id", "rep", "n_links")
    # Rows of one id: each has its own links, all share the component.
    per = per.groupBy("id").agg(F.max("n_links").alias("n_links"))
    return (rows.select("id", fits.alias("valid"))
            .join(per, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left")
            .select("id", F.when(F.col("valid"), F.coalesce("n_links", F.lit(0)))
                    .otherwise(0).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True))))


def _one_length(spark: SparkSession, scratch: Scratch, packed: DataFrame, label: T.DataType, number: np.dtype, dim: int,
                cosine: float) -> list[DataFrame]:
    """``(rep, links, root)`` partial counts and forest edges of vectors of one length, by round."""
    per_label = packed.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    n, largest = per_label.agg(F.sum("rows"), F.max("rows")).first()
    spot = F.xxhash64("rep", "vec")
    few = min(2 ** 63 - 1, -2 ** 63 + 2 ** 64 * 4 * SAMPLE_ROWS // n)  # so that not every row is sorted
    chosen = packed.where(spot <= F.lit(few)).orderBy(spot, "rep").limit(min(SAMPLE_ROWS, n)).select("vec").collect()
    sample = _unit(np.frombuffer(b"".join(bytes(r.vec) for r in chosen), number).reshape(-1, dim))
    shared = spark.sparkContext.broadcast(fit_grid(sample, largest, cosine))
    held = max(TILE, SHARD_BYTES // (dim * number.itemsize))

    def shards_of(rows):
        return F.greatest(F.ceil(rows / held), F.least(F.ceil(rows / SHARD_ROWS), F.lit(SHARDS))).cast("integer")

    sized = scratch.save(per_label.select("label", shards_of(F.col("rows")).alias("shards")))
    most = max(-(-largest // held), min(-(-largest // SHARD_ROWS), SHARDS))
    rounds = max(1, math.ceil((1 + (most - 1) / 2) / COPIES))
    step = 4 * TILE

    def count(batches):
        g = shared.value
        for b in row_blocks(batches, step):
            _, at, to = g.deal(_unit(_matrix(b.column(1), number)), b.column(2).to_numpy())
            codes, _ = _codes(b.column(0))
            own = np.append(True, at[1:] != at[:-1])  # a row's own shard is its first
            _, first, back = np.unique(codes[at].astype(np.int64) * len(g.before) + to, return_index=True, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at[first])), pa.array(to[first], pa.int32()),
                 pa.array(np.bincount(back, own).astype(np.int64)), pa.array(np.bincount(back), pa.int64())],
                ["label", "shard", "members", "visitors"])

    full = held * FULL
    crowded = (packed.select("label", "vec").join(sized, "label").mapInArrow(
        count, T.StructType().add("label", label).add("shard", "integer").add("members", "long").add("visitors", "long"))
        .groupBy("label", "shard").agg(F.sum("members").alias("members"), F.sum("visitors").alias("visitors"))
        .select("label", "shard", F.greatest(F.ceil(F.col("members") / full), F.lit(1)).cast("integer").alias("m"),
                F.ceil(F.col("visitors") / (full * VISITORS)).cast("integer").alias("v")).where("m > 1 or v > 1"))
    crowded = crowded.groupBy("label").agg(F.collect_list(F.struct("shard", "m", "v")).alias("blocks"))
    plan = scratch.save(sized.join(crowded, "label", "left"))

    def deal(of_round):
        def run(batches):
            g = shared.value
            for b in row_blocks(batches, step):
                home, at, to = g.deal(_unit(_matrix(b.column(3), number)), b.column(4).to_numpy())
                own = np.append(True, at[1:] != at[:-1])
                m, v = np.ones(len(at), np.int64), np.ones(len(at), np.int64)
                if b.column(5).null_count < b.num_rows:
                    codes, _ = _codes(b.column(1))
                    for code, i in zip(*np.unique(codes, return_index=True)):
                        for cut in b.column(5)[int(i)].as_py() or ():
                            here = (codes[at] == code) & (to == cut["shard"])
                            m[here], v[here] = cut["m"], cut["v"]
                spot = b.column(6).to_numpy().view(np.uint64)[at]
                mb = (spot % m.astype(np.uint64)).astype(np.int64)
                vb = (spot // np.uint64(2 ** 32) % v.astype(np.uint64)).astype(np.int64)
                # Members meet every block of visitors, visitors every block of members.
                copies = np.where(to % rounds == of_round, np.where(own, v + m - 1, m), 0)
                nth = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
                at, to, own, v, mb, vb = (np.repeat(z, copies) for z in (at, to, own, v, mb, vb))
                member = own & (nth < v)
                others = np.where(own, nth - v + (nth - v >= mb), nth)
                role = np.where(member, np.where(nth == vb, BOTH, MEMBER), VISITOR)
                t = b.select([0, 1, 2, 3]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*t.columns, pa.array(home[at], pa.int32()), pa.array(to, pa.int32()),
                     pa.array(np.where(member, mb, others), pa.int32()), pa.array(np.where(member, nth, vb), pa.int32()),
                     pa.array(role, pa.int8())], ["rep", "label", "times", "vec", "home", "shard", "mb", "vb", "role"])
        return run

    kinds = T.StructType().add("rep", "long").add("label", label).add("times", "long").add("vec", "binary").add(
        "home", "integer").add("shard", "integer").add("mb", "integer").add("vb", "integer").add("role", "byte")

    def verify(batches):
        grid, key, parts, block = shared.value, None, [], None

        def close():
            if block:
                yield from block.end()
            elif any((p[3] == BOTH).any() for p in parts):  # without visitors of other shards
                alone = Block(grid, cosine, parts)
                yield from alone.own()
                yield from alone.end()

        try:
            for b in batches:
                codes, labels = _codes(b.column(1))
                keys = np.stack([codes, *(b.column(i).to_numpy() for i in (5, 6, 7))])
                role = b.column(8).to_numpy()
                visits = role == VISITOR
                turns = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0) | (visits[1:] != visits[:-1])) + 1
                for lo, hi in zip([0, *turns], [*turns, b.num_rows]):
                    new = (repr(labels[keys[0, lo]]), *keys[1:, lo].tolist())
                    if new != key:
                        yield from close()
                        key, parts, block = new, [], None
                    s = b.slice(lo, hi - lo)
                    rep, times, home = (s.column(i).to_numpy().astype(np.int64) for i in (0, 2, 4))
                    raw = _matrix(s.column(3), number)
                    if role[lo] != VISITOR:
                        parts.append([rep, times, home, role[lo:hi].copy(), raw.copy()])
                    elif parts or block:
                        if not block:
                            block = Block(grid, cosine, parts)
                            parts = []
                            yield from block.own()
                        yield from block.visit(rep, times, home, raw)
            yield from close()
        finally:
            block = parts = None
            give_back()

    found = []
    for r in range(rounds):
        dealt = packed.select("rep", "label", "times", "vec").join(plan, "label").select(
            "rep", "label", "times", "vec", "shards", "blocks", spot.alias("spot")).mapInArrow(deal(r), kinds)
        found.append(scratch.save(
            dealt.repartition("label", "shard", "mb", "vb")
            .sortWithinPartitions("label", "shard", "mb", "vb", F.col("role") == VISITOR, "home")
            .mapInArrow(verify, "rep long, links long, root long")))
        _free_shuffles(spark)
    return found
