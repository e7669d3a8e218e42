"""Toxicity by labelled neighbours: exact TF-IDF cosine over a block-max inverted index.

Fit: features are a text's words and their first letters.  Their document counts per class come
from all training rows.  The index holds a bounded sample, at most ``per_class`` training documents of
each class (those of smallest id hash), as TF-IDF vectors over every feature of the sample; a feature
weighs more the more its rates differ between the classes, and none is left out.  Postings lie by
feature in blocks of ``block`` rows, with the largest weight of each feature in each block.

Rows lie in blocks of like rows (spherical k-means over the heaviest features), so a block's largest weights say
something about its rows.  Features that many rows hold are kept as a dense tile per block, the others as
postings.

Score: texts go through in batches.  The postings of a text's rarer features are added up for all rows.  A block's
bound is the most of these sums in it, plus the dot product of the text's common features with their largest weights
in the block.  The ``FIRST`` blocks of largest bounds are visited, then those whose bound is not below
the k-th best cosine so far, so the k neighbours are exact; visiting multiplies a block's tile with all the batch's
texts that need it.  Votes are weighted by squared cosine and by the classes' true rates
(the sample is balanced, the score is not), plus a small vote for the training rate.

Scoring reads whole texts in one pass without a shuffle; the index is bounded by the sample.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiers.llm.common import Scratch, give_back, row_blocks, ship

PER_CLASS, BLOCK, NEIGHBOURS = 2048, 64, 32
PREFIXES = (3, 4, 5)
FLUSH = 300_000
PRIOR_VOTE = 0.1
OVERSAMPLE = 4
FIRST = 8
BATCH = 512                     # texts scored together
CLUSTERS, CLUSTER_FEATURES, CLUSTER_ROUNDS = 8, 512, 8
TILE_SHARE, TILE_FEATURES = 1 / 16, 4096   # a tile holds features of at least this share of the rows, at most so many
TILE_STEP = 1 << 17             # postings put into tiles at a time, some
LABEL_ROWS = 2_000_000          # labels up to this number are broadcast to the texts
KNOWN_BEGINS = 100_000          # words' first letters that a worker remembers the features of; then it starts over
FEW = 5        # texts with a feature at which its class rates count half
FLOOR = 0.01   # the weight's share that a feature of equal rates keeps

_WORDS = re.compile(r"\w+").findall


def features(text: str | None) -> Counter:
    """Counts of a text's words, and of their first letters (marked ``^``)."""
    words = Counter(_WORDS(text.lower())) if text else Counter()
    out = Counter(words)
    for w, n in words.items():
        for p in PREFIXES:
            if len(w) > p:
                out["^" + w[:p]] += n
    return out


class _Slots(dict):
    """The slots of each word's features, given the slot of each feature's name; words of the vocabulary are remembered,
    and so are first letters."""

    def __init__(self, slot: dict[str, int]):
        self.slot, self.begins = slot, {}

    def __missing__(self, word: str) -> tuple:
        get, letters = self.slot.get, word[:PREFIXES[-1] + 1]
        begin = self.begins.get(letters)
        if begin is None:
            begin = self.begins[letters] = tuple(
                [i for p in PREFIXES if len(letters) > p and (i := get("^" + letters[:p])) is not None])
        i = get(word)
        if i is None:
            return begin
        self[word] = slots = (i, *begin)
        return slots

    def ready(self) -> "_Slots":
        """Itself; first letters start over beyond ``KNOWN_BEGINS``."""
        if len(self.begins) > KNOWN_BEGINS:
            self.begins.clear()
        return self


class _Vocabulary:
    """The features of the sample, by slot; tasks make the look-up tables once per worker."""

    def __init__(self, names: pa.Array):
        self.names = names

    def __getstate__(self):
        return {"names": self.names}

    @cached_property
    def slot(self) -> dict[str, int]:
        return {f: i for i, f in enumerate(self.names.to_pylist())}

    @cached_property
    def words(self) -> _Slots:
        return _Slots(self.slot)


class Index:
    """Block-max inverted index of labelled texts.

    What is handed to the tasks is the sample's vectors; tiles, bounds and look-up tables are made there, once
    per worker."""

    def __init__(self, idf: dict[str, float], rows: list[tuple], rate: float, block: int = BLOCK):
        """``idf`` per feature; ``rows``: ``(doc_id, label, counts by feature)``; ``rate``: share of label 1."""
        names = sorted(idf)
        slot = {f: i for i, f in enumerate(names)}
        kept = [[(slot[f], n) for f, n in r[2].items() if f in slot] for r in rows]
        self._build(names, np.array([idf[f] for f in names], float), [r[0] for r in rows],
                    np.array([r[1] for r in rows], int), np.array([len(k) for k in kept], np.int64),
                    np.array([i for k in kept for i, _ in k], np.int32), np.array([n for k in kept for _, n in k], float),
                    rate, block)

    @classmethod
    def from_arrays(cls, *args) -> "Index":
        """Of arrays, as ``_build`` takes them."""
        index = cls.__new__(cls)
        index._build(*args)
        return index

    def _build(self, names, idf: np.ndarray, ids: list, labels: np.ndarray, sizes: np.ndarray, slots: np.ndarray,
               counts: np.ndarray, rate: float, block: int = BLOCK) -> None:
        """``sizes`` of the rows' runs in ``slots`` and ``counts``, row after row."""
        self.names, self.idf, self.rate, self.block = names, idf, rate, block
        n1 = int((labels == 1).sum())
        n0 = len(labels) - n1
        w = (1 + np.log(counts)) * idf[slots]
        at = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        norm = np.sqrt(np.bincount(at, w * w, len(sizes)))
        held = norm[at] > 0
        at, terms, w, counts = at[held], slots[held], w[held] / norm[at[held]], counts[held]
        order = _alike(at, terms, w, np.lexsort((np.array([-1 if i is None else i for i in ids]), labels)), norm > 0)
        place = np.full(len(sizes), -1, np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        self.ids, self.labels = [ids[i] for i in order], labels[order].astype(float)
        # A balanced sample's votes count as the classes' shares in training.
        self.class_weight = np.where(self.labels == 1, rate / max(n1, 1), (1 - rate) / max(n0, 1)) * (n1 + n0)
        self.blocks = -(-len(order) // block)
        at = place[at]
        order = np.lexsort((at, terms))
        # Weights follow from counts, so a task keeps some bytes a posting.
        self.df, self.norms = np.bincount(terms, minlength=len(names)), norm[norm > 0][np.argsort(place[norm > 0])]
        self.rows, self.counts = _narrow(at[order]), _narrow(counts[order])

    def weights(self, terms: np.ndarray, which) -> np.ndarray:
        """The unit vectors' weights at the postings ``which``, whose features are ``terms``."""
        return (1 + np.log(self.counts[which].astype(float))) * self.idf[terms] / self.norms[self.rows[which]]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in self.MADE}

    #: What a task makes of the rest.
    MADE = ("slot", "_tiles", "_words")

    def put_away(self) -> None:
        """Forgets what was made, so that an idle worker holds little."""
        for k in self.MADE:
            self.__dict__.pop(k, None)

    @cached_property
    def slot(self) -> dict[str, int]:
        return {f: i for i, f in enumerate(self.names if isinstance(self.names, list) else self.names.to_pylist())}

    @cached_property
    def _words(self) -> "_Slots":
        return _Slots(self.slot)

    @cached_property
    def _tiles(self) -> "_Tiles":
        return _Tiles(self)

    def vector(self, counts) -> tuple[np.ndarray, np.ndarray] | None:
        """Unit TF-IDF vector over the vocabulary of counts by name, or of ``(slots, counts)``; None if
        it holds none of them."""
        if isinstance(counts, tuple):
            terms, n = counts
        else:
            hit = [(i, n) for f, n in counts.items() if (i := self.slot.get(f)) is not None]
            terms, n = np.array([i for i, _ in hit], np.int64), np.array([n for _, n in hit], float)
        if not len(terms):
            return None
        w = (1 + np.log(n)) * self.idf[terms]
        norm = math.sqrt(float(w @ w))
        return (terms, w / norm) if norm > 0 else None

    def text_vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """``vector(features(text))``, with each word's features looked up once per worker."""
        if not text:
            return None
        words = Counter(_WORDS(text.lower()))
        of = list(map(self._words.ready().__getitem__, words))
        terms = np.fromiter(chain.from_iterable(of), np.int64)
        if not len(terms):
            return None
        counts = np.repeat(np.fromiter(words.values(), float, len(words)), np.fromiter(map(len, of), np.int64, len(of)))
        order = np.argsort(terms)
        terms = terms[order]
        first = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        return self.vector((terms[first], np.add.reduceat(counts[order], first)))

    def nearest(self, vectors: list, k: int = NEIGHBOURS) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the index rows and cosines of the ``k`` nearest rows of positive cosine, ties by row."""
        out = [(np.empty(0, int), np.empty(0))] * len(vectors)
        there = [i for i, v in enumerate(vectors) if v is not None]
        if there and self.blocks:
            cosines, least = self._tiles.cosines([vectors[i] for i in there], k)
            for i, c, low in zip(there, cosines, least):
                # No other row can be among the nearest, or equal the last.
                r = np.flatnonzero(c >= low - 1e-11 if low > 1e-11 else c)
                if len(r) > k:
                    x = c[r]
                    r = r[x >= np.partition(x, len(r) - k)[len(r) - k] - 1e-11]
                order = np.lexsort((r, -np.round(c[r], 12)))[:k]
                order = order[c[r[order]] > 0]
                out[i] = r[order], np.round(c[r[order]], 12)  # whatever the batch
        return out

    def neighbours(self, counts, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        """``nearest`` of the vector of one text's features."""
        return self.nearest([self.vector(counts)], k)[0]

    def vote(self, r: np.ndarray, c: np.ndarray) -> tuple[float, list]:
        """Weighted vote (0 to 1) of the nearest rows, and the first of them as evidence."""
        votes = c ** 2 * self.class_weight[r] if len(r) else c
        score = (float(votes @ self.labels[r]) if len(r) else 0.0) + PRIOR_VOTE * self.rate
        score /= float(votes.sum()) + PRIOR_VOTE
        near = [{"doc_id": self.ids[i], "cosine": float(x), "label": int(self.labels[i])} for i, x in zip(r[:3], c[:3])]
        return min(1.0, max(0.0, score)), near

    def score(self, counts) -> tuple[float, list]:
        return self.vote(*self.neighbours(counts))

    def score_texts(self, texts: list) -> list[tuple[float, list]]:
        """``score(features(text))`` for each text, in batches."""
        out = []
        for i in range(0, len(texts), BATCH):
            out += [self.vote(*x) for x in self.nearest([self.text_vector(t) for t in texts[i:i + BATCH]])]
        return out


class _Tiles:
    """The index as a task uses it: a tile per block for its common features, postings for the rest.

    Tiles are kept as their cells that are not zero, and laid out as one dense tile when a batch comes to their block."""

    def __init__(self, index: Index):
        n, blocks, block, vocabulary = len(index.ids), index.blocks, index.block, len(index.idf)
        self.n, self.blocks, self.block = n, blocks, block
        df, starts = index.df, np.concatenate([[0], np.cumsum(index.df)])
        common = np.flatnonzero(df >= max(2, TILE_SHARE * n))
        common = np.sort(common[np.argsort(-df[common], kind="stable")[:TILE_FEATURES]])
        self.column = np.full(vocabulary, -1, np.int32)
        self.column[common] = np.arange(len(common))
        # A tile has all common features, so that a text's are taken as they lie.
        self.tile, self.largest = np.zeros((len(common), block)), np.zeros((len(common), blocks))
        self.cuts = np.concatenate([[0], np.cumsum(np.bincount(
            index.rows[_ranges(starts[common], starts[common + 1])[0]] // block, minlength=blocks))]).astype(np.int64)
        self.cells, self.values = np.empty(self.cuts[-1], np.int32), np.empty(self.cuts[-1])
        self.postings = np.concatenate([[0], np.cumsum(np.where(self.column < 0, df, 0))])
        self.rows, self.weights = np.empty(self.postings[-1], index.rows.dtype), np.empty(self.postings[-1])
        free, done = self.cuts[:-1].copy(), 0
        # Features in steps of some TILE_STEP postings, so that the copies on the way stay small.
        steps = np.unique(np.concatenate([np.searchsorted(starts, np.arange(0, starts[-1], TILE_STEP)), [vocabulary]]))
        for i, j in zip(np.concatenate([[0], steps[:-1]]), steps):
            terms, at = np.repeat(np.arange(i, j, dtype=np.int32), df[i:j]), np.arange(starts[i], starts[j])
            rest = self.column[terms] < 0
            size = int(rest.sum())
            self.rows[done:done + size] = index.rows[at[rest]]
            self.weights[done:done + size] = index.weights(terms[rest], at[rest])
            done += size
            terms, at = terms[~rest], at[~rest]
            rows = index.rows[at].astype(np.int64)
            order = np.argsort(rows // block, kind="stable")
            of, many = rows[order] // block, np.bincount(rows // block, minlength=blocks)
            place = free[of] + np.arange(len(of)) - (np.cumsum(many) - many)[of]
            free += many
            self.cells[place] = (self.column[terms] * block + rows % block)[order]
            self.values[place] = index.weights(terms, at)[order]
        for b in range(blocks):
            with self.laid(b) as tile:
                self.largest[:, b] = tile.max(axis=1)

    @contextmanager
    def laid(self, b: int) -> Iterator[np.ndarray]:
        """Block ``b`` as a dense tile, in the one array that all blocks use."""
        cells = self.cells[self.cuts[b]:self.cuts[b + 1]]
        flat = self.tile.reshape(-1)
        flat[cells] = self.values[self.cuts[b]:self.cuts[b + 1]]
        try:
            yield self.tile
        finally:
            flat[cells] = 0

    def cosines(self, vectors: list, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector the cosines with all rows; too small ones in blocks that cannot hold one of the ``k``
        nearest.  And a cosine that the k-th nearest reaches."""
        many, blocks, block = len(vectors), self.blocks, self.block
        dense, found = np.zeros((many, len(self.largest))), np.zeros((many, blocks * block))
        for i, (terms, w) in enumerate(vectors):
            column = self.column[terms]
            common = column >= 0
            dense[i, column[common]] = w[common]
            at, times = _ranges(self.postings[terms[~common]], self.postings[terms[~common] + 1])
            found[i, :self.n] = np.bincount(self.rows[at], np.repeat(w[~common], times) * self.weights[at], self.n)
        bounds = found.reshape(many, blocks, block).max(axis=2) + dense @ self.largest

        def visit(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(axis=0)):
                who = np.flatnonzero(wanted[:, b])
                with self.laid(b) as tile:
                    found[who, b * block:(b + 1) * block] += dense[who] @ tile

        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST], True, axis=1)
        visit(first)
        kth = np.partition(found[:, :self.n], self.n - k, axis=1)[:, self.n - k] if self.n >= k else np.zeros(many)
        visit(~first & (bounds > 0) & (bounds * (1 + 1e-9) + 1e-11 >= kth[:, None]))
        return found[:, :self.n], kth


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in as few bytes as they need."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _alike(at: np.ndarray, terms: np.ndarray, w: np.ndarray, order: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The rows that are ``there`` with like rows side by side: by spherical k-means over the features of largest
    total weight, each cluster from its middle outwards; ``order`` among equals."""
    order = order[there[order]]
    if len(order) <= CLUSTERS:
        return order
    mass = np.bincount(terms, w * w)
    top = np.argsort(-mass, kind="stable")[:CLUSTER_FEATURES]
    column = np.full(len(mass), -1)
    column[top] = np.arange(len(top))
    of = column[terms]
    x = np.zeros((len(there), len(top)), np.float32)
    x[at[of >= 0], of[of >= 0]] = w[of >= 0]
    x = x[order]
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)
    centres = x[np.linspace(0, len(x) - 1, CLUSTERS).astype(int)].copy()
    for _ in range(CLUSTER_ROUNDS):
        nearest = (x @ centres.T).argmax(axis=1)
        for j in range(CLUSTERS):
            if (own := nearest == j).any():
                centres[j] = x[own].sum(axis=0)
        centres /= np.maximum(np.sqrt((centres * centres).sum(axis=1, keepdims=True)), 1e-12)
    near = x @ centres.T
    return order[np.lexsort((np.arange(len(x)), -near.max(axis=1), near.argmax(axis=1)))]


def _feature_names(rows: DataFrame) -> pa.Array:
    """The features of all texts of ``rows``, in order."""
    def run(batches):
        names = set()
        for b in row_blocks(batches):
            for text in b.column(0).to_pylist():
                names.update(features(text))
            if len(names) > FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string())], ["feature"])
                names.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(names), pa.string())], ["feature"])

    found = rows.select("text").mapInArrow(run, "feature string").distinct().orderBy("feature")
    return found.toArrow()["feature"].combine_chunks()


def _class_counts(rows: DataFrame, shared, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts of class 1 and of class 0 that hold each of the ``many`` features of the ``shared`` vocabulary, over
    all rows."""
    def run(batches):
        vocabulary, counts = shared.value, np.zeros((2, many), np.int64)
        for b in row_blocks(batches):
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    words = vocabulary.words.ready()
                    held = set(chain.from_iterable(map(words.__getitem__, set(_WORDS(text.lower())))))
                    counts[1 if label else 0, np.fromiter(held, np.int64, len(held))] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[1, at]), pa.array(counts[0, at])],
                                         ["slot", "n1", "n0"])

    got = (rows.select("text", "label").mapInArrow(run, "slot int, n1 long, n0 long")
           .groupBy("slot").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))).toArrow()
    out = np.zeros((2, many))
    for row, name in enumerate(("n1", "n0")):
        out[row, got["slot"].to_numpy()] = got[name].to_numpy()
    return out[0], out[1]


def _weight(n1_of: np.ndarray, n0_of: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """A feature's weight: its IDF, times how far its rates in the classes are apart, to the square.

    Rates are compared, so more rows of the same kind change no weight, but for features that only
    few texts hold."""
    both, r1, r0 = n1_of + n0_of, n1_of / n1, n0_of / n0
    apart = np.abs(r1 - r0) / (r1 + r0) * both / (both + FEW)
    return (1 + np.log((1 + n1 + n0) / (1 + both))) * (FLOOR + (1 - FLOOR) * apart ** 2)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and each range's size."""
    sizes = ends - starts
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


def join_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with their ``labels(doc_id, label)``, each of its labels a row.

    Up to ``LABEL_ROWS`` labels (some 16 bytes each) go to the texts, beyond that both are shuffled."""
    few = labels.limit(LABEL_ROWS + 1).count() <= LABEL_ROWS
    return docs.select("doc_id", "text").join(F.broadcast(labels) if few else labels.hint("merge"), "doc_id")


def fit_index(labelled: DataFrame, per_class: int = PER_CLASS) -> Index:
    """Index of ``labelled(doc_id, text, label)``; rows with a null label are left out.

    The driver gets the features of ``2 * per_class`` texts and their sparse vectors.  With
    one class or none the index is empty and every score is the training rate (0 without rows).
    Rows of one id and label give the index one vector (of the smallest text).
    """
    ship(labelled.sparkSession)
    scratch = Scratch(labelled.sparkSession, "toxicity")
    rows = labelled.where("label is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", (F.col("label") == 1).cast("int").alias("label"))
    n1, n = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    if not 0 < n1 < n:
        return Index({}, [], n1 / n if n else 0.0)
    # Ids of small hash first, about OVERSAMPLE times as many as wanted: the window sees no more.
    share = F.when(F.col("label") == 1, OVERSAMPLE * per_class / n1).otherwise(OVERSAMPLE * per_class / (n - n1))
    near = (rows.select("doc_id", "label", F.xxhash64(F.col("doc_id").cast("string")).alias("h"))
            .where(F.col("h") / 2.0 ** 64 + 0.5 <= share).distinct())
    order = Window.partitionBy("label").orderBy("h", "doc_id")
    chosen = (near.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_class)
              .select("doc_id", "label"))

    sample = scratch.save(rows.join(F.broadcast(chosen), ["doc_id", "label"])  # 2 * per_class ids
                          .groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    # All features of the sample, with their counts over all rows.
    names = _feature_names(sample)
    shared = labelled.sparkSession.sparkContext.broadcast(_Vocabulary(names))
    idf = _weight(*_class_counts(rows, shared, len(names)), n1, n - n1)

    def run(batches):
        slot = shared.value.slot
        for b in row_blocks(batches):
            found = [features(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([[slot[f] for f in c] for c in found], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], ["doc_id", "label", "slots", "counts"])

    got = sample.mapInArrow(run, "doc_id long, label int, slots array<int>, counts array<int>") \
        .orderBy("doc_id", "label").toArrow().combine_chunks()
    shared.destroy()
    scratch.drop(sample)
    slots, counts = got["slots"].combine_chunks(), got["counts"].combine_chunks()
    return Index.from_arrays(
        names, idf, got["doc_id"].to_pylist(), got["label"].to_numpy().astype(int),
        pc.list_value_length(slots).to_numpy(zero_copy_only=False).astype(np.int64), slots.flatten().to_numpy(),
        counts.flatten().to_numpy().astype(float), n1 / n)


def score_texts(spark: SparkSession, docs: DataFrame, index: Index, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``(id, score, predicted, evidence)`` per row of ``docs``; the training rate for a text
    without a feature of the index (empty and null texts too)."""
    ship(spark)
    shared = spark.sparkContext.broadcast(index)  # bounded by the fit's sample
    kind = docs.schema[id_col].dataType.simpleString()
    near = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches):
        model = shared.value
        for b in row_blocks(batches):
            found = model.score_texts(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in found], pa.float64()),
                 pa.array([int(x[0] >= 0.5) for x in found], pa.int32()), pa.array([x[1] for x in found], near)],
                [id_col, "score", "predicted", "evidence"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, score double, predicted int, "
             "evidence array<struct<doc_id:bigint,cosine:double,label:int>>")


def score_column(spark: SparkSession, index: Index):
    """A function from a text column to its score, for filters that keep whole rows."""
    ship(spark)
    shared = spark.sparkContext.broadcast(index)  # bounded by the fit's sample

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        try:
            for texts in batches:
                out = np.zeros(len(texts))
                for i in range(0, len(out), BATCH):  # only so many texts are Python objects at a time
                    out[i:i + BATCH] = [x[0] for x in model.score_texts(texts.slice(i, BATCH).to_pylist())]
                yield pa.array(out)
        finally:  # idle workers keep what they hold while others work
            model.put_away()
            give_back()

    return score
