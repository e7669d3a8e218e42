"""Language-model scores by context-tree weighting over bytes.

The text is its lower-cased words, each ended by a space, then an end mark.  A byte is eight binary
decisions (its bits from the high one); a decision's contexts are the last 0 to ``depth`` bytes,
through spaces and words; before a text lie end marks.  Every node (context, bits so far) keeps
counts of zeros and ones and a Krichevsky-Trofimov estimate; a node's weighted probability is the
half-and-half mixture of its own estimate and its children's product (context-tree weighting over
all depths).

Every node seen ``MIN_COUNT`` times or more is kept, however large the corpus; the rarer contexts
below a node together form one more child.  Prediction is the batch form of the mixture: each node's
posterior weight, from the root down.

The tree is never collected.  A byte behind its six context bytes is one number (a gram), newest
context byte highest, so a context's grams are a run of the sorted table.  Grams are dealt out by
their newest ``TOP`` context bytes and weighted there, in runs of bounded size unless one context of
``TOP`` bytes is larger; only the contexts shorter than ``TOP`` meet on the driver.  A second pass goes
down from those and gives each distinct gram its log probability.  Texts look grams above a fixed
share of all bytes (a bounded number) up in place; the others meet the gram table in an equi-join.
Words, for the base score, are counted and looked up in the same way.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.common import Scratch, row_blocks, words_of

DEPTH = 6
MIN_COUNT = 2          # times a node is seen to stand by itself; the same for any corpus
TOP = 3                # context bytes that grams are dealt out by
HEAD_SHARE = 5e-7      # of all words; bounds the words looked up in place
GRAM_SHARE = 1e-7      # of all bytes; bounds the grams looked up in place
END = b"\n"            # the end of a text; no word holds it
WORD_BYTES = 1 << 24   # bytes of text whose words are counted at once
PIECE = 1 << 20        # bytes of text, and
PIECE_TEXTS = 256      # texts, turned into grams at once
RUN = 100_000          # grams weighted at once

_LOG2 = math.log(2.0)


# ---- bytes in context ---------------------------------------------------------------------

def bytes_of(words: list[bytes]) -> bytes:
    """The text scored: each word and a space, then the end mark."""
    return b" ".join([*words, END])


def pieces(texts: list[bytes], limit: int = PIECE, most: int = PIECE_TEXTS):
    """``(first text, text number from there, gram)`` of every byte of the texts, at most about
    ``limit`` bytes and ``most`` texts at once; long texts are cut, with their contexts."""
    parts, owners, size = [], [], 0

    def made():
        data = b"".join(parts)
        sizes = np.array([len(x) for x in parts])
        real = np.ones(len(data), bool)
        real[((np.cumsum(sizes) - sizes)[:, None] + np.arange(DEPTH)).ravel()] = False
        # The eight bytes from each place on as one number: the oldest of six context bytes is the lowest.
        six = np.ndarray(len(data) - DEPTH, "<i8", data + b"\0" * (8 - DEPTH), strides=(1,))[real[DEPTH:]]
        six <<= 16
        gram = (six.view(np.uint64) >> np.uint64(8)).view(np.int64)
        gram |= np.frombuffer(data, np.uint8)[real]
        return owners[0], np.repeat(np.array(owners) - owners[0], sizes - DEPTH), gram

    for i, text in enumerate(texts):
        data = END * DEPTH + text
        for s in range(0, len(text), limit):
            parts.append(data[s:s + limit + DEPTH])
            owners.append(i)
            size += len(parts[-1])
            if size >= limit or i - owners[0] >= most - 1:
                yield made()
                parts, owners, size = [], [], 0
    if parts:
        yield made()


def grams(words: list[bytes], depth: int) -> tuple[np.ndarray, ...]:
    """Every byte of the words and the space that ends each (none after the end mark):
    ``(context, its length, byte, word number)``; the newest byte of a context is its lowest."""
    buf = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8)
    at = np.arange(1, len(buf))
    reach = np.minimum(at, depth)
    context = np.zeros(len(at), np.int64)
    for d in range(depth):
        ok = reach > d
        context[ok] |= buf[at[ok] - 1 - d].astype(np.int64) << (8 * d)
    word = np.cumsum(buf[:-1] == 32) - 1
    real = buf[:-1] != END[0]
    return context[real], reach[real], buf[1:][real].astype(np.int64), word[real]


def node_key(depth, context, bits):
    """One number for a node: depth, context bytes, and the bits so far behind a leading one."""
    return (np.int64(depth) << 56 if np.isscalar(depth) else depth << 56) | (context << 8) | bits


def _summed(keys: np.ndarray, *weights: np.ndarray):
    """Distinct values of sorted keys and the sums of their weights."""
    if not len(keys):
        return (keys, *weights)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[starts], *(np.add.reduceat(w, starts) for w in weights))


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of sorted keys and how often each occurs."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.diff(starts, append=len(keys))


# ---- the model --------------------------------------------------------------------------------

_TABLE = 1 << 12
_LGAMMA = np.array([math.lgamma(i / 2) for i in range(1, 2 * _TABLE + 4)])  # of 1/2, 1, 3/2, ...


def _lgamma(twice: np.ndarray) -> np.ndarray:
    """Log gamma of ``twice / 2``, for whole numbers ``twice`` from 1."""
    out = _LGAMMA[np.minimum(twice, 2 * _TABLE + 3).astype(np.int64) - 1]
    big = twice > 2 * _TABLE
    if big.any():
        x = twice[big] / 2
        out[big] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3)
    return out


def _kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov block probability."""
    return _lgamma(2 * zeros + 1) + _lgamma(2 * ones + 1) - _lgamma(2 * (zeros + ones) + 2) - math.log(math.pi)


class Tree:
    """The mixture in memory.  Node keys in order and, for each, the probability that the next bit
    is one if the node is the deepest of the tree for the context."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, depth: int = DEPTH):
        self.depth = depth
        order = np.argsort(keys)
        keys, zeros, ones = keys[order], zeros[order].astype(float), ones[order].astype(float)
        level = keys >> 56
        context, bits = (keys >> 8) & np.int64((1 << 48) - 1), keys & 255
        own = _kt(zeros, ones)
        complete = level == depth
        parent = np.full(len(keys), -1)
        for d in range(1, depth + 1):
            at = np.flatnonzero(level == d)
            low = context[at] & np.int64((1 << (8 * (d - 1))) - 1)
            parent[at] = np.searchsorted(keys, node_key(d - 1, low, bits[at]))
        below = level > 0
        rest0, rest1 = zeros.copy(), ones.copy()
        np.subtract.at(rest0, parent[below], zeros[below])
        np.subtract.at(rest1, parent[below], ones[below])
        children = _kt(np.maximum(rest0, 0), np.maximum(rest1, 0))
        weighted = own.copy()
        for d in range(depth, -1, -1):
            at = np.flatnonzero((level == d) & ~complete)
            weighted[at] = np.logaddexp(own[at], children[at]) - _LOG2
            at = np.flatnonzero(level == d)
            if d:
                np.add.at(children, parent[at], weighted[at])
        stop = np.where(complete, 1.0, np.exp(np.minimum(own - _LOG2 - weighted, 0.0)))
        one = (ones + 0.5) / (zeros + ones + 1.0)
        rest = (rest1 + 0.5) / (rest0 + rest1 + 1.0)
        mixed, left = np.zeros(len(keys)), np.ones(len(keys))
        for d in range(depth + 1):
            at = np.flatnonzero(level == d)
            before_m = mixed[parent[at]] if d else 0.0
            before_l = left[parent[at]] if d else 1.0
            mixed[at] = before_m + before_l * stop[at] * one[at]
            left[at] = before_l * (1.0 - stop[at])
        self.keys, self.one = keys, mixed + np.where(complete, 0.0, left * rest)

    def bits_log2(self, context: np.ndarray, reach: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Log2 probability of each byte in its context."""
        out = np.zeros(len(byte))
        at_depth = reach.astype(np.int64)
        keys, n = self.keys, len(self.keys)
        for k in range(8):
            bits = (1 << k) | (byte >> (8 - k))
            bit = (byte >> (7 - k)) & 1
            p = np.full(len(byte), 0.5)
            open_ = np.arange(len(byte))
            d_of = at_depth.copy()
            while len(open_) and n:
                d = d_of[open_]
                mask = (np.int64(1) << (8 * d)) - 1
                want = (d << 56) | ((context[open_] & mask) << 8) | bits[open_]
                i = np.minimum(np.searchsorted(keys, want), n - 1)
                hit = keys[i] == want
                p[open_[hit]] = self.one[i[hit]]
                open_ = open_[~hit & (d > 0)]
                d_of[open_] -= 1
            out += np.log2(np.where(bit == 1, p, 1.0 - p))
        return out


def _prefix(key: np.ndarray, d: int) -> np.ndarray:
    """Keys (context, bits) with the context cut to its newest ``d`` bytes."""
    return key & ~np.int64((1 << (8 * (DEPTH - d + 1))) - 1) | key & 255


class Levels:
    """Nodes of the depths ``low`` to ``high``, weighted from the deepest up.

    The deepest are given as distinct keys (context, bits), their counts, and what their kept
    children sum to: zeros, ones, log weighted probability (None at the full depth)."""

    def __init__(self, key, zeros, ones, low: int, high: int, least: int, children=None):
        self.nodes = []
        for d in range(high, low - 1, -1):
            own = _kt(zeros, ones)
            if children is None:
                weighted, stop, rest = own, np.ones(len(own)), np.full(len(own), 0.5)
            else:
                rest0, rest1 = zeros - children[0], ones - children[1]
                weighted = np.logaddexp(own, _kt(rest0, rest1) + children[2]) - _LOG2
                stop = np.exp(np.minimum(own - _LOG2 - weighted, 0.0))
                rest = (rest1 + 0.5) / (rest0 + rest1 + 1.0)
            kept = (zeros + ones >= least) if d else np.ones(len(own), bool)
            one = (ones + 0.5) / (zeros + ones + 1.0)
            self.key, self.zeros, self.ones, self.weighted, self.kept = key, zeros, ones, weighted, kept
            if d > low:
                up, parent = np.unique(_prefix(key, d - 1), return_inverse=True)
                sums = [np.bincount(parent, x, len(up))
                        for x in (zeros, ones, zeros * kept, ones * kept, weighted * kept)]
                key, zeros, ones, children = up, sums[0], sums[1], sums[2:]
            else:
                parent = None
            self.nodes.append((parent, stop, one, rest, kept))

    def down(self, mixed, left, last):
        """Mixture so far, weight left, and the probability of a one, per deepest node; given the
        same per shallowest node from the depth above (0, 1 and any at the root)."""
        for parent, stop, one, rest, kept in reversed(self.nodes):
            if parent is not None:
                mixed, left, last = mixed[parent], left[parent], last[parent]
            mixed = mixed + left * stop * one
            left = left * (1.0 - stop)
            last = np.where(kept, mixed + left * rest, last)
        return mixed, left, last


def _per_bit(gram: np.ndarray, n: np.ndarray, depth: int, low: int, least: int):
    """For each of a byte's bits: ``(levels, deepest node of each gram, bit)`` of sorted grams."""
    byte = gram & 255
    for k in range(8):
        bit = (byte >> (7 - k)) & 1
        key = _prefix(gram, depth) & ~np.int64(255) | (1 << k) | (byte >> (8 - k))
        key, at = np.unique(key, return_inverse=True)
        zeros, ones = (np.bincount(at, x, len(key)) for x in (n * (1 - bit), n * bit))
        yield Levels(key, zeros, ones, low, depth, least), at, bit


def _runs(batches, low: int):
    """``(gram, n, n_all)`` of sorted batches, in runs of about ``RUN`` grams that end where the
    newest ``low`` context bytes change."""
    held, size = [], 0
    for b in batches:
        held.append([b.column(i).to_numpy() for i in range(3)])
        size += b.num_rows
        if size >= RUN:
            cols = [np.concatenate(x) for x in zip(*held)]
            group = cols[0] >> (8 * (DEPTH - low + 1))
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield [c[:cut] for c in cols]
                cols = [c[cut:] for c in cols]
            held, size = [cols], len(cols[0]) if cut else 0
    if held and sum(len(h[0]) for h in held):
        yield [np.concatenate(x) for x in zip(*held)]


def gram_table(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(gram, n, n_all)`` of ``docs(text, train)``: every distinct byte in context, how often in
    the training texts and how often in all."""
    keep = ~np.int64((1 << (8 * (DEPTH - depth + 1))) - 1) | 255

    def run(batches):
        held, size = [], 0

        def merged():  # a gram of training texts is another code
            code, n = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(code, kind="stable")
            return _summed(code[order], n[order])

        def found(code, n):
            columns = _summed(code >> 1, n * (code & 1), n)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["gram", "n", "n_all"])

        for b in row_blocks(batches):
            learn = np.array([bool(x) for x in b.column(1).to_pylist()])
            for first, row, gram in pieces([bytes_of(words_of(t)) for t in b.column(0).to_pylist()], 2 * PIECE, 512):
                held.append(_counted(np.sort((gram & keep) << 1 | learn[first + row])))
                size += len(held[-1][0])
                if size > 4_000_000:
                    held = [merged()]
                    size = len(held[0][0])
                    if size > 2_000_000:
                        yield found(*held[0])
                        held, size = [], 0
        if held:
            yield found(*merged())

    return (docs.select("text", "train").mapInArrow(run, "gram long, n long, n_all long").repartition("gram")
            .groupBy("gram").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all")))


def score_grams(spark: SparkSession, table: DataFrame, depth: int = DEPTH, least: int = MIN_COUNT) -> DataFrame:
    """``(gram, n, n_all, ctw)`` of a stored gram table: ``ctw`` is the log10 probability of the byte in
    its context, from the mixture over all nodes seen ``least`` times or more.

    The driver gets the contexts shorter than ``TOP`` bytes."""
    low = min(TOP, depth)
    dealt = (table.repartition(F.shiftright("gram", 8 * (DEPTH - low + 1))).sortWithinPartitions("gram")
             .select("gram", "n", "n_all"))

    def up(batches):
        for gram, n, _ in _runs(batches, low):
            for levels, _, _ in _per_bit(gram, n, depth, low, least):
                if low:
                    key, parent = np.unique(_prefix(levels.key, low - 1), return_inverse=True)
                    kept = levels.kept
                    sums = [np.bincount(parent, x, len(key)) for x in (
                        levels.zeros, levels.ones, levels.zeros * kept, levels.ones * kept, levels.weighted * kept)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, *sums)],
                                                     ["key", "zeros", "ones", "k0", "k1", "kw"])

    if low:
        names = ["zeros", "ones", "k0", "k1", "kw"]
        got = (dealt.mapInArrow(up, "key long, " + ", ".join(f"{x} double" for x in names)).groupBy("key")
               .agg(*(F.sum(x).alias(x) for x in names)).toArrow())
        order = np.argsort(got["key"].to_numpy())
        key, zeros, ones, *children = (got[x].to_numpy()[order] for x in ("key", *names))
        above = Levels(key, zeros, ones, 0, low - 1, least, children)
        roots = len(above.key)
        start = (key, *above.down(np.zeros(roots), np.ones(roots), np.full(roots, 0.5)))
    else:
        start = (np.zeros(0, np.int64),) + (np.zeros(0),) * 3
    shared = spark.sparkContext.broadcast(start)  # one row per bit of a context below TOP bytes

    def run(batches):
        keys, *values = shared.value
        for gram, n, n_all in _runs(batches, low):
            log = np.zeros(len(gram))
            for levels, at, bit in _per_bit(gram, n, depth, low, least):
                if low:
                    i = np.searchsorted(keys, _prefix(levels.key, low - 1))
                    one = levels.down(*(x[i] for x in values))[2][at]
                else:
                    m = len(levels.key)
                    one = levels.down(np.zeros(m), np.ones(m), np.full(m, 0.5))[2][at]
                log += np.log10(np.where(bit == 1, one, 1.0 - one))
            for s in range(0, len(gram), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[s:s + 50_000]) for x in (gram, n, n_all, log)],
                                                 ["gram", "n", "n_all", "ctw"])

    return dealt.mapInArrow(run, "gram long, n long, n_all long, ctw double")


# ---- words ------------------------------------------------------------------------------------

def word_table(docs: DataFrame) -> DataFrame:
    """``(word, n, n_all)`` of ``docs(text, train)``: every distinct word, how often the training
    texts and how often all texts hold it; the end mark is a word of every text."""
    def run(batches):
        parts, sizes, learn, held = [], [], [], 0

        def flush():
            data = np.frombuffer(b"".join(parts), np.uint8)
            ends = np.flatnonzero(data == 32)
            offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(ends),
                                          [None, pa.py_buffer(offsets), pa.py_buffer(data[data != 32])]).dictionary_encode()
            at, trains = words.indices.to_numpy(), np.repeat(np.array(learn, bool), sizes)
            n, n_all = (np.bincount(x, minlength=len(words.dictionary)).astype(np.int64) for x in (at[trains], at))
            return pa.RecordBatch.from_arrays([words.dictionary, pa.array(n), pa.array(n_all)], ["word", "n", "n_all"])

        for b in row_blocks(batches):
            for text, to in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                parts.append(b" ".join([*words, END, b""]))
                sizes.append(len(words) + 1)
                learn.append(bool(to))
                held += len(parts[-1])
                if held > WORD_BYTES:
                    yield flush()
                    parts, sizes, learn, held = [], [], [], 0
        if parts:
            yield flush()

    # A task's words are distinct already: summed up once, behind the shuffle.
    return (docs.select("text", "train").mapInArrow(run, "word binary, n long, n_all long").repartition("word")
            .groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all")))


def score_texts(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                train=None, depth: int = DEPTH, share: float = 0.0,
                head_share: float = HEAD_SHARE, gram_share: float = GRAM_SHARE) -> DataFrame:
    """Per row of ``docs``: ``(id, n_bytes, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte)``.

    ``train`` is the condition of the rows to learn from (all by default).  Tokens are the
    lower-cased words and one end; ``base_score`` is their add-one unigram log10 probability,
    ``score`` the tree's log10 probability of the same bytes, each after the ``depth`` bytes (6 at
    most) before it.  Nodes rarer than ``share`` of the training bytes share a child (none but those
    seen once, by default).  A null text is the empty text, the end alone.  Without training rows
    every bit has probability one half.
    """
    scratch = Scratch(spark, "lm")
    train = F.lit(True) if train is None else F.coalesce(train, F.lit(False))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), train.alias("train"))
    counted = scratch.save(word_table(texts))
    tokens, distinct, everything = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1)),
        F.coalesce(F.sum("n_all"), F.lit(0))).first()
    log_all = math.log10(tokens + distinct + 1)
    table = counted.withColumn("base", F.log10(F.col("n") + 1) - F.lit(log_all))
    head = table.where((F.col("n_all") >= everything * head_share) | (F.col("word") == END)).toArrow()
    seen = scratch.save(gram_table(texts, depth))
    learnt, n_bytes = (x or 0 for x in seen.agg(F.sum("n"), F.sum("n_all")).first())
    scored = scratch.save(score_grams(spark, seen, depth, max(MIN_COUNT, math.ceil(learnt * share))))
    scratch.drop(seen)
    often = scored.where(F.col("n_all") >= n_bytes * gram_share).select("gram", "ctw").toArrow()
    order = np.argsort(often["gram"].to_numpy())
    shared = spark.sparkContext.broadcast((
        {w: i for i, w in enumerate(head["word"].to_pylist())}, head["n"].to_numpy() > 0,
        head["base"].to_numpy(), often["gram"].to_numpy()[order], often["ctw"].to_numpy()[order]))
    kind = docs.schema[id_col].dataType.simpleString()
    keep = np.uint64(int(~np.int64((1 << (8 * (DEPTH - depth + 1))) - 1) | 255) & (2 ** 56 - 1))
    eight, low_byte = np.uint64(8), np.uint64(255)

    def tree_sums(data, keys, logs):
        """Per text: the log probabilities of the grams looked up, and the other grams."""
        total, others = np.zeros(len(data)), ([], [], [])
        for first, row, gram in pieces(data):
            code = np.sort((gram.astype(np.uint64) & keep) << eight | row.astype(np.uint64))
            code, times = _counted(code)
            row, gram = first + (code & low_byte).astype(np.int64), (code >> eight).astype(np.int64)
            i = np.searchsorted(keys, gram)
            hit = keys[np.minimum(i, len(keys) - 1)] == gram if len(keys) else np.zeros(len(gram), bool)
            total += np.bincount(row[hit], times[hit] * logs[i[hit]], len(data))
            for to, x in zip(others, (row, gram, times)):
                to.append(x[~hit])
        row, gram, times = (np.concatenate(x) for x in others)
        order = np.argsort(row.astype(np.uint16), kind="stable")  # fewer rows than that; by their digits
        offsets = np.searchsorted(row[order], np.arange(len(data) + 1)).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(gram[order]), pa.array(times[order])], ["gram", "times"])
        return total, pa.ListArray.from_arrays(pa.array(offsets), pairs)

    def run(batches):
        slot, known, base, keys, logs = shared.value
        for b in row_blocks(batches, PIECE_TEXTS):
            if not b.num_rows:
                continue
            cols, data = [[] for _ in range(5)], []
            for text in b.column(1).to_pylist():
                words = words_of(text)
                data.append(bytes_of(words))
                words.append(END)
                at = np.fromiter(map(slot.get, words, repeat(-1)), np.int64, len(words))
                tail = Counter([words[k] for k in np.flatnonzero(at < 0).tolist()])
                at = at[at >= 0]
                row = (len(data[-1]), len(words), int(known[at].sum()), float(base[at].sum()), list(tail.items()))
                for c, x in zip(cols, row):
                    c.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.map_(pa.binary(), pa.int64()))
            total, others = tree_sums(data, keys, logs)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(cols, types)), pa.array(total), others],
                ["id", "n_bytes", "n_tokens", "known", "base", "tail", "ctw", "others"])

    rows = scratch.save(texts.select("id", "text").mapInArrow(
        run, f"id {kind}, n_bytes long, n_tokens long, known long, base double, tail map<binary,bigint>, ctw double, "
             "others array<struct<gram:bigint,times:bigint>>").withColumn("row", F.monotonically_increasing_id()))
    rare_words = (rows.select("row", F.explode("tail").alias("word", "times")).join(table.select("word", "n", "base"), "word")
                  .select("row", F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("t_known"),
                          (F.col("base") * F.col("times")).alias("t_base"), F.lit(0.0).alias("t_ctw")))
    rare_grams = (rows.select("row", F.explode("others").alias("x")).select("row", "x.gram", "x.times")
                  .join(scored.select("gram", "ctw").hint("shuffle_hash"), "gram")
                  .select("row", F.lit(0).cast("long").alias("t_known"), F.lit(0.0).alias("t_base"),
                          (F.col("ctw") * F.col("times")).alias("t_ctw")))
    tail = rare_words.unionByName(rare_grams).groupBy("row").agg(
        *(F.sum(x).alias(x) for x in ("t_known", "t_base", "t_ctw")))
    zero = F.lit(0)
    return (rows.select("row", "id", "n_bytes", "n_tokens", "known", "base", "ctw").join(tail, "row", "left")
            .select("id", "n_bytes", "n_tokens", (F.col("known") + F.coalesce("t_known", zero)).alias("n_known"),
                    F.lit(tokens).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("t_base", F.lit(0.0))).alias("base_score"),
                    (F.col("ctw") + F.coalesce("t_ctw", F.lit(0.0))).alias("score"))
            .withColumn("bits_per_byte", -F.col("score") / math.log10(2.0) / F.col("n_bytes")))
