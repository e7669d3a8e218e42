"""Byte-level BPE as a monoid: halves are encoded on their own, neighbours are joined.

``encode`` splits a text in two, encodes the halves recursively (short spans directly, with the
tiktoken library's merges) and joins them.  The join re-encodes a window around the seam and keeps every token outside it.  The
window grows on both sides until it ends at a *sure boundary*: a place at which the pattern ends
a match whatever stands further away (a non-space followed by a space, a letter followed by a
non-letter, and so on).  A scan of either half stops there too, so the tokens outside the window
are those of the whole text.  A span without any sure boundary is a run of one class; its
matches are encoded by the same scheme on bytes: halves are encoded, and the seam's window of
tokens grows until its outermost pair on either side is stable, that is, encoding the two tokens'
bytes gives the two tokens back.  Byte pair merges are local to adjacent pairs, so a sequence of
which all adjacent pairs are stable is the encoding of the whole.

``decode`` looks tokens up and concatenates up a tree of halves.  Documents are independent:
one pass, no shuffle, memory bounded by one block of rows.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.llm.common import give_back, row_blocks, ship

LEAF_CHARS = 1024     # spans up to this length are encoded directly
LEAF_BYTES = 512      # matches up to this length are merged directly

#: Places that end a match of the pattern whatever the rest of the text is.
SURE = regex.compile(
    r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\p{L}\s])|(?<=\p{N})(?=[^\p{N}\s])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])")


class Codec:
    """Encoder and decoder for one rank file and one pattern."""

    def __init__(self, ranks_path: str, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        with open(ranks_path, "rb") as fh:
            pairs = [line.split() for line in fh if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.bpe = tiktoken.Encoding("spans", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.matches = regex.compile(pattern).findall
        self.leaf_chars, self.leaf_bytes = max(2, leaf_chars), max(2, leaf_bytes)

    # ---- one match -----------------------------------------------------------------------

    def merge(self, piece: bytes) -> list[int]:
        """Byte pair merges of one short span or window, without the pattern."""
        return self.bpe._encode_single_piece(piece)

    def stable(self, a: int, b: int) -> bool:
        return self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def piece(self, data: bytes) -> list[int]:
        """The encoding of one match, by halves when it is long."""
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        if data in self.ranks:
            return [self.ranks[data]]
        half = len(data) // 2
        return self.join_tokens(self.piece(data[:half]), self.piece(data[half:]))

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        n = 1
        while True:
            a, b = max(0, len(left) - n), min(len(right), n)
            window = b"".join(map(self.bytes_of.__getitem__, left[a:] + right[:b]))
            middle = self.merge(window)
            if ((a == 0 or self.stable(left[a - 1], middle[0]))
                    and (b == len(right) or self.stable(middle[-1], right[b]))):
                return left[:a] + middle + right[b:]
            n *= 2

    # ---- a text --------------------------------------------------------------------------

    def long_run(self, text: str) -> list[int]:
        """A long span of one class of characters: its few matches, each by halves."""
        out = []
        for m in self.matches(text):
            out += self.piece(m.encode("utf-8", "surrogatepass"))
        return out

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.leaf_chars:
            return self.bpe.encode_ordinary(text)
        cut = len(text) // 2
        a, b = _last_sure(text, cut), _first_sure(text, cut)
        if a == 0 and b == len(text):
            return self.long_run(text)
        left, right = self.encode(text[:cut]), self.encode(text[cut:])
        # Each half's scan stops at the sure boundary inside it, so its tokens split there.
        keep = len(left) - self.tokens_of(reversed(left), len(text[a:cut].encode("utf-8", "surrogatepass")))
        drop = self.tokens_of(right, len(text[cut:b].encode("utf-8", "surrogatepass")))
        return left[:keep] + self.encode(text[a:b]) + right[drop:]

    def tokens_of(self, ids, size: int) -> int:
        """How many of the first ``ids`` make up ``size`` bytes."""
        n = 0
        if size:
            for i in ids:
                n += 1
                size -= len(self.bytes_of[i])
                if size <= 0:
                    break
        return n

    def decode(self, ids: list[int]) -> bytes:
        """Concatenation of the tokens' bytes, up a tree of halves."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def _first_sure(text: str, cut: int) -> int:
    """The first sure boundary after ``cut``, seen from the right half alone; else its end."""
    width = 64
    while cut + width < len(text):
        m = SURE.search(text, cut + 1, cut + width)
        if m:
            return m.start()
        width *= 4
    m = SURE.search(text, cut + 1)
    return m.start() if m and m.start() < len(text) else len(text)


def _last_sure(text: str, cut: int) -> int:
    """The last sure boundary before ``cut``, seen from the left half alone; else its start."""
    width = 64
    while width < cut:
        found = [m.start() for m in SURE.finditer(text, cut - width, cut) if cut - width < m.start() < cut]
        if found:
            return found[-1]
        width *= 4
    found = [m.start() for m in SURE.finditer(text, 0, cut) if 0 < m.start() < cut]
    return found[-1] if found else 0


_CODECS: dict[tuple, Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec per worker process: its tables are read once."""
    key = (ranks_path, pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(ranks_path, pattern)
    return _CODECS[key]


def forget_codecs() -> None:
    """An idle worker holds no tables; the next task reads them again."""
    _CODECS.clear()
    give_back()


def _path(name_or_path: str) -> str:
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers

    return public_tokenizers.path(name_or_path)


def tokenize(docs: DataFrame, ranks: str, pattern: str | None = None, text_col: str = "text",
             ids_col: str = "token_ids") -> DataFrame:
    """``docs`` with ``ids_col``: the text's token ids (null text: no tokens), texts whole.

    ``ranks`` is a rank file, or its name in ``public_tokenizers``; it is opened by the tasks.
    A column of ``docs`` called ``ids_col`` is replaced.
    """
    pattern = pattern or _default_pattern()
    ship(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def encode(texts):
        c = codec(_path(ranks), pattern)
        return texts.map(lambda t: np.array(c.encode(t) if t else [], np.int32))

    return docs.withColumn(ids_col, encode(F.col(text_col)))


def detokenize(docs: DataFrame, ranks: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with ``out_col``: the bytes of the ids in ``ids_col`` (null ids: no bytes)."""
    pattern = _default_pattern()
    ship(docs.sparkSession)

    @F.pandas_udf("binary")
    def decode(ids):
        c = codec(_path(ranks), pattern)
        return ids.map(lambda x: c.decode(list(x)) if x is not None else b"")

    return docs.withColumn(out_col, decode(F.col(ids_col)))


def encode_and_check(docs: DataFrame, ranks: str, pattern: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``, ``n_tokens`` and ``decoded_sha256`` (of the bytes that the ids decode to), texts whole.

    One pass over small blocks of rows, so a task holds the ids and bytes of few documents at a time.  A null or
    empty text has no tokens and the digest of no bytes; columns of these three names are replaced; rows are
    independent; an empty table stays empty."""
    pattern = pattern or _default_pattern()
    own = ("token_ids", "n_tokens", "decoded_sha256")
    kept = docs.drop(*own)
    at = kept.columns.index(text_col)
    ship(docs.sparkSession)

    def run(batches):
        c = codec(_path(ranks), pattern)
        try:
            for b in row_blocks(batches, 64):
                ids = [c.encode(t) if t else [] for t in b.column(at).to_pylist()]
                digests = [hashlib.sha256(c.decode(x)).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(ids, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array(digests, pa.string())], [*b.schema.names, *own])
        finally:
            c = ids = None
            forget_codecs()

    schema = T.StructType(list(kept.schema.fields)).add("token_ids", T.ArrayType(T.IntegerType())) \
        .add("n_tokens", T.LongType()).add("decoded_sha256", T.StringType())
    return kept.mapInArrow(run, schema)


def _default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def token_digests(docs: DataFrame, ranks: str, pattern: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)`` per row, encoded and decoded in one pass
    so that no id list leaves its task."""
    pattern = pattern or _default_pattern()
    kind = docs.schema[id_col].dataType.simpleString()
    ship(docs.sparkSession)

    def run(batches):
        c = codec(_path(ranks), pattern)
        sha = hashlib.sha256
        for b in row_blocks(batches):
            n, a, d = [], [], []
            for text in b.column(1).to_pylist():
                ids = c.encode(text) if text else []
                n.append(len(ids))
                a.append(sha(",".join(map(str, ids)).encode()).hexdigest())
                d.append(sha(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
