"""Document fingerprints: a Merkle tree over sections, paragraphs and runs of words.

A text's paragraphs are its lines; a section ends after a blank paragraph or one whose digest is
divisible by 8, so that an edit moves no boundary far from it.  A paragraph's leaves are runs of
words, cut after words chosen by their checksum.  Leaf digests (BLAKE2, 96 bits) cover the raw text, every
node's digest covers its children's, and the root covers the sections'.  Cuts are lossless, so
equal roots mean equal texts, but for a collision of leaf digests.

A fingerprint is the root and the leaves' digests in tree order, as text:
``root:leafleaf,leaf;leaf`` (``,`` between paragraphs, ``;`` between sections).  The root and all inner digests
follow from the leaves, so two fingerprints are compared from the root down (``compare``): branches of equal
digests are alike as a whole, and only differing ones are descended into, as far as their leaves.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.common import row_blocks, ship

LEAF_CUT, SECTION_CUT = 6, 8
LEAF_BYTES, DIGITS = 12, 16  # of a leaf's digest, and its base64 digits


def _leaf(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=LEAF_BYTES).digest()


def _paragraph(data: bytes) -> str:
    """The digests of a paragraph's leaves; one leaf at least."""
    crc = zlib.crc32
    leaves, start = [], 0
    words = data.split(b" ")
    for i, w in enumerate(words):
        if crc(w) % LEAF_CUT == 0:
            leaves.append(_leaf(b" ".join(words[start:i + 1])))
            start = i + 1
    if start < len(words) or not leaves:
        leaves.append(_leaf(b" ".join(words[start:])))
    return base64.b64encode(b"".join(leaves)).decode()


def _node(kind: str, children: str) -> str:
    """The digest of a node of this kind (paragraph, section or root) over its children's."""
    return hashlib.blake2b(f"{kind}{children}".encode(), digest_size=16).hexdigest()


def _section(paragraphs: list[str]) -> str:
    return _node("s", "".join([_node("p", p) for p in paragraphs]))


def fingerprint(text: str | None) -> str:
    """The fingerprint of a text; null as the empty text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    sections, paragraphs = [], []
    for line in data.split(b"\n") if data else ():
        leaves = _paragraph(line)
        paragraphs.append(leaves)
        if not line.strip() or zlib.crc32(leaves.encode()) % SECTION_CUT == 0:
            sections.append(paragraphs)
            paragraphs = []
    if paragraphs:
        sections.append(paragraphs)
    return _node("r", "".join(map(_section, sections))) + ":" + ";".join(map(",".join, sections))


def _unpaired(a: list, b: list) -> tuple[list[int], list[int]]:
    """The places of ``a`` and of ``b`` that are left when equal values are paired off."""
    def rest(x, y):
        there, out = Counter(y), []
        for i, v in enumerate(x):
            if there[v] > 0:
                there[v] -= 1
            else:
                out.append(i)
        return out
    return rest(a, b), rest(b, a)


def compare(a: str, b: str) -> tuple[float, list[tuple[int, int]]]:
    """The likeness of two fingerprints, the share of their leaves that they have in common (0 to 1; 1 for equal
    roots), and the ``(section, paragraph)`` places of ``b`` that ``a`` lacks, found from the root down."""
    (root_a, _, tree_a), (root_b, _, tree_b) = a.partition(":"), b.partition(":")
    if root_a == root_b:
        return 1.0, []
    sides = [[s.split(",") for s in t.split(";")] if t else [] for t in (tree_a, tree_b)]
    branches = []
    for side, open_sections in zip(sides, _unpaired(*[[_section(s) for s in side] for side in sides])):
        branches.append([(i, j, p) for i in open_sections for j, p in enumerate(side[i])])
    digests = [[_node("p", p) for _, _, p in side] for side in branches]
    branches = [[side[i] for i in left] for side, left in zip(branches, _unpaired(*digests))]
    leaves = [Counter(p[i:i + DIGITS] for _, _, p in side for i in range(0, len(p), DIGITS)) for side in branches]
    total = [sum(len(p) for s in side for p in s) // DIGITS for side in sides]
    common = total[0] - sum((leaves[0] - leaves[1]).values())
    return 2.0 * common / sum(total), [(i, j) for i, j, _ in branches[1]]


def likeness(a: str, b: str) -> float:
    return compare(a, b)[0]


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out_col``, the fingerprint of each row's whole text."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def run(texts):
        return texts.map(fingerprint, na_action=None)

    return docs.withColumn(out_col, run(F.col(text_col)))


def edited_text(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the start of ``following``."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut] if cut else text


FIRST = -(1 << 63)  # the sort key of a null id


def edit_fingerprints(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Per row: ``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, edited_places)`` against its edited text and the next row by ascending id (after the last: the
    first; null ids first, rows of one id by text).  A null text is the empty text.  ``edited_places`` are the
    sections and paragraphs of the edited text that differ from the text's.  Equal rows are rows of their own; other
    columns are not read; an empty table gives no rows.

    Texts are shuffled once: rows are dealt to ranges of ids, and each range's first row also
    goes to the range before it, as the neighbour of that range's last row.
    """
    ship(spark)
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("key"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted({int(x) for x in ids.approxQuantile("key", [i / parts for i in range(1, parts)], 0.2 / parts)}) \
        if parts > 1 else []

    @F.pandas_udf("int")
    def range_of(keys):
        import pandas as pd

        return pd.Series(np.searchsorted(np.array(cuts, np.int64), keys.to_numpy(), side="right").astype("int32"))

    firsts = dict(tuple(r) for r in ids.select(range_of("key").alias("part"), "key")
                  .groupBy("part").agg(F.min("key")).collect())  # a row per range
    order = sorted(firsts)
    before = {part: order[i - 1] for i, part in enumerate(order)}  # the first range follows the last

    def deal(batches):
        bounds = np.array(cuts, np.int64)
        for b in row_blocks(batches):
            keys = np.array(b.column(0).to_pylist(), np.int64)
            part = np.searchsorted(bounds, keys, side="right")
            again = np.array([firsts[int(p)] == k for p, k in zip(part, keys.tolist())], bool)
            for rows, to, lead in ((np.arange(len(keys)), part, 0),
                                   (np.flatnonzero(again), [before[int(p)] for p in part[again]], 1)):
                if len(rows):
                    t = b.take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(to, pa.int32()), pa.array([lead] * len(rows), pa.int32()), t.column(0), t.column(1),
                         t.column(2)], ["part", "lead", "key", "id", "text"])

    dealt = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(FIRST)).alias("key"),
                        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .mapInArrow(deal, "part int, lead int, key long, id long, text string")
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
             "edited_places"]
    places = pa.list_(pa.struct([("section", pa.int32()), ("paragraph", pa.int32())]))

    def against_next(batches):
        held = None  # (part, id, text, fingerprint) of the row before
        ended = None  # the range whose following row has been seen
        for b in row_blocks(batches):
            out = []
            for part, lead, i, text in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4))):
                if lead and ended == part:
                    continue  # further rows of the following range's first id
                mark = fingerprint(text)
                if held is not None and held[0] == part:
                    edited = edited_text(held[2], text)
                    new = fingerprint(edited) if edited != held[2] else held[3]
                    near, where = compare(held[3], new)
                    out.append((held[1], len(held[2]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                                held[3], new, near, likeness(held[3], mark),
                                [{"section": i, "paragraph": j} for i, j in where]))
                held, ended = (None, part) if lead else ((part, i, text, mark), ended)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), places))], names)

    return (dealt.repartitionById(max(1, parts), F.col("part")).sortWithinPartitions("part", "lead", "key", "text")
            .mapInArrow(against_next, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double, "
                                 "edited_places array<struct<section:int,paragraph:int>>"))
