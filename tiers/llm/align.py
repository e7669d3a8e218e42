"""Alignment of two tokenizers' tokens over the bytes of the same texts, by sparse incidence products.

A block of texts is one line of bytes.  Its tokens under tokenizer A and under tokenizer B are two sparse
token-by-byte incidence matrices, held in compressed rows built here (``Csr``).  Gustavson's row
products give the links:

* ``overlap``: A Bt over the bytes; an entry is the number of bytes the two tokens share;
* ``end``: the overlap links whose tokens end at the same byte;
* ``group``: the bytes at which tokens of both end cut the line into groups; the product of the two
  token-by-group matrices links all tokens of one group.

A run over a table has three steps, each from a written table, so a lost executor costs its tasks:

1. every text is encoded by both and linked: one row per text with its counts, its digest and its link
   keys (A id, B id), packed;
2. the keys are counted over the corpus, combined per task before the shuffle;
3. each text adds up the counts of its own links.  The pairs with at least one in ``HOT_PAIRS`` of all
   links (so at most ``HOT_PAIRS`` pairs, whatever the corpus) are broadcast; the others are rare by
   that definition and meet their texts in a shuffle join.  No pair is left out.

Texts are cut where both tokenizers surely cut, at a single space between two other characters.  The units
between are the blocks on the matrices' diagonal: each distinct one is encoded and multiplied once per
worker (a bounded table keeps the results, those of late use longest), and a text's result is its units' put
together.  A unit's result is its tokens alone, one number each that also says where groups close; counts, keys
and digest are worked out of a whole text's numbers at once.  New units are encoded some to a line, with single
spaces between, and told apart by their bytes.
Long texts are read in stretches of ``BLOCK_CHARS``.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.bpe import _path
from tiers.llm.common import Scratch, ship

HOT_PAIRS = 500_000
BLOCK_CHARS = 1 << 18
BLOCK_TEXTS = 256
KNOWN_UNITS = 300_000     # units a worker remembers; half of them since the older half was last renewed
KNOWN_CHARS = 48          # longer units are not remembered
LINE_UNITS = 64           # units encoded as one line,
FEW_UNITS = 8             # and those of lines whose tokens do not show the units

#: A place at which both tokenizers end a token: a single space between two characters that are no white space.
CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
#: What only other spaces have beside them.
BEFORE, BEHIND = re.compile(r"[^!-~\w] "), re.compile(r" [^!-~\w]")
#: A unit that is surely cut off from any such neighbours.
WHOLE = re.compile(r"[!-~\w](?:.*[!-~\w])?", re.DOTALL).fullmatch


# ---- sparse matrices ----------------------------------------------------------------------------

class Csr:
    """A matrix of counts in compressed rows: row ``i`` has the columns ``cols[start[i]:start[i + 1]]``,
    ascending, with the values ``data`` at the same places."""

    def __init__(self, start: np.ndarray, cols: np.ndarray, data: np.ndarray, width: int):
        self.start, self.cols, self.data, self.width = start, cols, data, width

    @classmethod
    def from_runs(cls, ends: np.ndarray, width: int) -> "Csr":
        """Rows that cover consecutive runs of columns, run ``i`` up to ``ends[i]``."""
        return cls(np.concatenate([[0], ends]), np.arange(width), np.ones(width, np.int64), width)

    @classmethod
    def from_labels(cls, labels: np.ndarray, width: int) -> "Csr":
        """Rows of one entry, in column ``labels[i]``."""
        n = len(labels)
        return cls(np.arange(n + 1), labels, np.ones(n, np.int64), width)

    @property
    def height(self) -> int:
        return len(self.start) - 1

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(self.height), np.diff(self.start))

    def transposed(self) -> "Csr":
        """By a stable counting order of the entries' columns."""
        sizes = np.bincount(self.cols, minlength=self.width)
        order = np.arange(len(self.cols)) if np.all(self.cols[1:] >= self.cols[:-1]) else np.argsort(self.cols, kind="stable")
        return Csr(np.concatenate([[0], np.cumsum(sizes)]), self.rows()[order], self.data[order], self.height)

    def times(self, other: "Csr") -> "Csr":
        """Gustavson's product: row ``i`` is the sum of ``other``'s rows at row ``i``'s columns, weighted."""
        size = np.diff(other.start)[self.cols]
        total = int(size.sum())
        shift = np.repeat(other.start[self.cols] - (np.cumsum(size) - size), size)
        at = np.arange(total) + shift
        key = np.repeat(self.rows(), size) * other.width + other.cols[at]
        value = np.repeat(self.data, size) * other.data[at]
        if not np.all(key[1:] >= key[:-1]):
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.empty(0, np.int64)
        key, value = key[first], np.add.reduceat(value, first) if total else value
        row, col = np.divmod(key, max(1, other.width))
        return Csr(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=self.height))]), col, value, other.width)


def links(a_ends: np.ndarray, b_ends: np.ndarray, kind: str = "overlap") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked tokens of one line of bytes: positions in A, positions in B, and the shared bytes
    (``overlap``, ``end``) or the shared groups (``group``, always 1).

    ``a_ends`` and ``b_ends`` are the tokens' ascending end offsets; the last ones are equal.  Tokens have at
    least one byte.  Without tokens there are no links.
    """
    if not len(a_ends):
        return (np.empty(0, np.int64),) * 3
    if kind == "group":
        group_a, group_b, n = groups(a_ends, b_ends)
        c = Csr.from_labels(group_a, n).times(Csr.from_labels(group_b, n).transposed())
        return c.rows(), c.cols, c.data
    c = Csr.from_runs(a_ends, int(a_ends[-1])).times(Csr.from_runs(b_ends, int(b_ends[-1])).transposed())
    i, j, shared = c.rows(), c.cols, c.data
    if kind == "end":
        same = a_ends[i] == b_ends[j]
        i, j, shared = i[same], j[same], shared[same]
    return i, j, shared


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The group of every token of A and of B, and the number of groups."""
    i, j, _ = links(a_ends, b_ends, "end")
    return _group_of(len(a_ends), i), _group_of(len(b_ends), j), len(i)


def _group_of(n: int, last: np.ndarray) -> np.ndarray:
    """The group of each of ``n`` tokens, where ``last`` are the groups' last tokens."""
    closes = np.zeros(n + 1, np.int64)
    closes[last + 1] = 1
    return np.cumsum(closes)[:n]


# ---- tokenizers ---------------------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it is printable
    Latin-1, else the next code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library; special tokens' strings are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        letters = _byte_letters()
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes_of[i] = (bytes(map(letters.__getitem__, piece)) if all(c in letters for c in piece)
                                else piece.encode())
        self.batch = getattr(self.library, "encode_batch_fast", self.library.encode_batch)

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.batch([" " + p for p in parts], add_special_tokens=False)]


class Pieces:
    """A SentencePiece model, which puts a space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(sp.id_to_piece, range(sp.get_piece_size()))
        self.bytes_of = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(pieces)]

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self.library.encode(parts, num_threads=1)


class Aligner:
    """Both tokenizers, their tables of lengths, and of ids as text."""

    def __init__(self, a: str, b: str):
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.len_a, self.len_b = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b))
        n, m = len(self.len_a), len(self.len_b)
        self.width = m
        #: Ids with what follows them: A's comma, A's bar, B's comma, B's semicolon.  A token's place here is its number.
        said = [f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + \
            [f"{i}," for i in range(m)] + [f"{i};" for i in range(m)]
        self.said = np.array(said, f"S{-(-max(map(len, said)) // 8) * 8}")
        self.base = (0, n, 2 * n, 2 * n + m)
        self.known: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        if any(b" " in x.lstrip(b" ") for x in self.b.bytes_of):  # A's words are split before its merges
            raise ValueError("B's vocabulary has entries across words")

    def stretches(self, text: str) -> list[str]:
        """The text in stretches of bounded size, without the spaces at which they are cut."""
        out, at = [], 0
        while len(text) - at > BLOCK_CHARS:
            m = CUT.search(text, at + BLOCK_CHARS // 2)
            if not m:
                break
            out.append(text[at:m.start()])
            at = m.end()
        return [*out, text[at:]]

    @staticmethod
    def units(stretch: str) -> list[str]:
        """The stretch cut at every ``CUT``; at all of its spaces, where none is another."""
        if stretch.startswith(" ") or stretch.endswith(" ") or BEHIND.search(stretch) or BEFORE.search(stretch):
            return CUT.split(stretch)
        return stretch.split(" ")

    def block(self, parts: list[str]) -> list[bytes | None]:
        """For each unit its tokens' numbers, packed, in the order of the digest; None where the joined bytes
        of either tokenizer differ from the unit's."""
        found: dict[str, bytes | None] = {}
        whole = list(filter(WHOLE, parts))
        for n in (LINE_UNITS, FEW_UNITS):
            found.update(self.lines([whole[k:k + n] for k in range(0, len(whole), n)]))
            whole = [p for p in whole if p not in found]
        found.update(self.lines([[p] for p in parts if p not in found]))
        return list(map(found.get, parts))

    def lines(self, lines: list[list[str]]) -> dict[str, bytes | None]:
        """``block`` of the units of each line, encoded with single spaces between them.  Of a line of many whose joined
        bytes differ, or in which a token runs on from unit to unit, none are in the result."""
        if not lines:
            return {}
        joined = list(map(" ".join, lines))
        ids_a, ids_b = self.a.encode(joined), self.b.encode(joined)
        same = [b"".join(map(self.a.bytes_of.__getitem__, x)) == (want := b" " + p.encode()) and
                b"".join(map(self.b.bytes_of.__getitem__, y)) == want for p, x, y in zip(joined, ids_a, ids_b)]
        found: dict[str, bytes | None] = {line[0]: None for line, ok in zip(lines, same) if not ok and len(line) == 1}
        ids_a, ids_b, lines, joined = ([x for x, ok in zip(them, same) if ok] for them in (ids_a, ids_b, lines, joined))
        a = np.fromiter(chain.from_iterable(ids_a), np.int64)
        b = np.fromiter(chain.from_iterable(ids_b), np.int64)
        units = list(chain.from_iterable(lines))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # Where each unit, with the space in front, ends: in characters, then in bytes.
        data = np.frombuffer("".join([" " + p for p in joined]).encode(), np.uint8)
        first = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))
        ends = first[np.cumsum(np.fromiter(map(len, units), np.int64, len(units)) + 1)]
        to_a, to_b = np.searchsorted(ends_a, ends, "right"), np.searchsorted(ends_b, ends, "right")
        cut = (ends_a[to_a - 1] == ends) & (ends_b[to_b - 1] == ends)
        i, j, _ = links(ends_a, ends_b, "end")
        group_a, group_b = _group_of(len(a), i), _group_of(len(b), j)
        # A group's A tokens stand behind all B tokens of earlier groups, its B tokens behind its A tokens.
        closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closes_a[i], closes_b[j] = 1, 1
        said = np.empty(len(a) + len(b), np.int32)
        said[np.arange(len(a)) + np.concatenate([[0], j + 1])[group_a]] = a + np.where(closes_a, self.base[1], self.base[0])
        said[np.arange(len(b)) + (i + 1)[group_b]] = b + np.where(closes_b, self.base[3], self.base[2])
        packed, to = said.tobytes(), (4 * (to_a + to_b)).tolist()
        found.update((u, packed[x:y]) for u, x, y in zip(units, [0, *to], to))
        if not cut.all():
            at = np.cumsum([0, *map(len, lines)])
            for line, x, y in zip(lines, at, at[1:]):
                if not cut[x:y].all():
                    for u in line:
                        del found[u]
        return found

    def learn(self, units: list[str]) -> dict[str, bytes | None]:
        """The results of these units, with the new ones worked out."""
        if len(self.known) > KNOWN_UNITS // 2:
            self.older, self.known = self.known, {}
        known, older, long = self.known, self.older, {}
        new = set(units).difference(known)
        again = older.keys() & new
        known.update((u, older[u]) for u in again)
        new = list(new - again)
        for u, got in zip(new, self.block(new)):
            (known if len(u) <= KNOWN_CHARS else long)[u] = got
        return known | long if long else known

    def texts(self, texts: list[str | None]) -> list[tuple]:
        """For each text ``(n_a, n_b, number of links, packed link keys, digest)``."""
        out, held, size = [(0, 0, 0, b"", "")] * len(texts), [], 0
        pending = [(k, s) for k, t in enumerate(texts) if t for s in self.stretches(t)]
        done: dict[int, list] = {}
        for at, (k, stretch) in enumerate(pending):
            held.append((k, self.units(stretch)))
            size += len(stretch)
            if size < BLOCK_CHARS and at + 1 < len(pending):
                continue
            results = self.learn(list(chain.from_iterable(units for _, units in held)))
            for i, units in held:
                got = list(map(results.__getitem__, units))
                done.setdefault(i, []).append(None if None in got else b"".join(got))
            held, size = [], 0
        _, a_closes, b_opens, b_closes = self.base
        for k, got in done.items():
            if None not in got:
                said = np.frombuffer(b"".join(got), np.int32)
                n_a = int(np.count_nonzero(said < b_opens))
                a = said[(said >= a_closes) & (said < b_opens)].astype(np.int64) - a_closes
                b = said[said >= b_closes] - b_closes
                digest = hashlib.sha256(self.said.take(said).tobytes().translate(None, b"\0")[:-1]).hexdigest()
                out[k] = n_a, len(said) - n_a, len(a), (a * self.width + b).tobytes(), digest
        return out


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """One aligner per worker process."""
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


# ---- over a table -------------------------------------------------------------------------------

def encoded(docs: DataFrame, a: str, b: str, id_col: str, text_col: str) -> DataFrame:
    """``(row, id, n_a, n_b, n_groups, groups_sha256, links)``: ``links`` are packed 64-bit keys, A id times
    the size of B's vocabulary plus B id, in text order."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        c = aligner(_path(a), _path(b))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_TEXTS):
                part = batch.slice(at, BLOCK_TEXTS)
                n_a, n_b, n_g, keys, digests = zip(*c.texts(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_g)), pa.array(digests, pa.string()),
                     pa.array(keys, pa.binary())],
                    ["id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        run, f"id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, links binary").withColumn(
        "row", F.monotonically_increasing_id())


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """``(pair, n, best)``: how many links hold the pair, and whether no pair of its B id has more."""
    def run(batches):
        keys, n, held = [], [], 0

        def merged():
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            return key, np.bincount(at, weights=np.concatenate(n), minlength=len(key)).astype(np.int64)

        for batch in batches:
            for packed in batch.column(0):
                key, count = np.unique(np.frombuffer(packed.as_buffer(), np.int64), return_counts=True)
                keys.append(key)
                n.append(count)
                held += len(key)
                if held > 2_000_000:
                    key, count = merged()
                    if len(key) > 1_000_000:  # counts of a part are as good: they are added up later
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["pair", "m"])
                        key, count = key[:0], count[:0]
                    keys, n, held = [key], [count], len(key)
        if held:
            key, count = merged()
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(count)], ["pair", "m"])

    counts = (rows.select("links").where(F.length("links") > 0).mapInArrow(run, "pair long, m long")
              .groupBy("pair").agg(F.sum("m").alias("n")).withColumn("b", F.col("pair") % width))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def _sum_hot(rows: DataFrame, hot) -> DataFrame:
    """``(row, n_best, count_sum, pairs, times)``: sums over the links of broadcast pairs, and the other links'
    pairs with the times they occur."""
    def run(batches):
        pair, n, best = hot.value
        for batch in batches:
            out = []
            for packed in batch.column(1):
                key, m = np.unique(np.frombuffer(packed.as_buffer(), np.int64), return_counts=True)
                at = np.minimum(np.searchsorted(pair, key), max(0, len(pair) - 1))
                known = pair[at] == key if len(pair) else np.zeros(len(key), bool)
                at, k = at[known], m[known]
                out.append((int(best[at] @ k), int(n[at] @ k), key[~known], m[~known]))
            b, s, p, t = zip(*out)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(b, pa.int64()), pa.array(s, pa.int64()), pa.array(p, longs), pa.array(t, longs)],
                ["row", "n_best", "count_sum", "pairs", "times"])

    return rows.select("row", "links").mapInArrow(
        run, "row long, n_best long, count_sum long, pairs array<long>, times array<long>")


def align(spark: SparkSession, docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text",
          hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per row of ``docs``.

    Tokenizer ``a`` (byte-level, of the ``tokenizers`` library) encodes a space and the text, ``b``
    (SentencePiece) the text.  Links join tokens that end together; ``n_best`` counts those whose pair is the
    commonest of its B id in the whole table, ``count_sum`` adds up the pairs' counts.  A text that is null,
    empty, or not given back by both tokenizers byte for byte has no tokens: zeros and an empty digest.
    Rows are independent (null and repeated ids stay); other columns are not read; an empty table gives no
    rows.  ``a`` and ``b`` are files, or their names in ``public_tokenizers``; the tasks open them.
    """
    ship(spark)
    scratch = Scratch(spark, "align")
    width = Pieces(_path(b)).library.get_piece_size()
    rows = scratch.save(encoded(docs, a, b, id_col, text_col))
    pairs = scratch.save(pair_counts(rows, width))
    total = pairs.agg(F.sum("n")).first()[0] or 0
    least = -(-total // max(1, hot_pairs))  # at most ``hot_pairs`` pairs can have so many links each
    hot = pairs.where(F.col("n") >= least).toPandas().sort_values("pair")
    shared = spark.sparkContext.broadcast(tuple(hot[c].to_numpy(np.int64) for c in ("pair", "n", "best")))
    summed = scratch.save(_sum_hot(rows, shared))
    shared.destroy()
    rare = (summed.where(F.size("pairs") > 0)
            .select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.pairs", "x.times")
            .join(pairs.where(F.col("n") < least).withColumnRenamed("pair", "pairs"), "pairs")
            .groupBy("row").agg(F.sum(F.col("times") * F.col("best")).alias("more_best"),
                                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    done = rows.drop("links").join(summed.select("row", "n_best", "count_sum"), "row").join(rare, "row", "left")
    return done.select("id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
                       (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                       (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
