"""Token counts of a SentencePiece BPE model by heap-and-linked-list byte-pair merging.

A text's symbols (code points, with U+2581 for each space and one in front) form a linked list; a heap
holds every adjacent pair that the vocabulary can merge, lowest rank first, leftmost among equals.
Popping a pair merges it and pushes the pairs that it forms with its neighbours.  No identifier is
looked up or emitted: the count is the number of symbols minus the merges, plus the further bytes of
the code points that the vocabulary lacks (they fall back to one token a byte).

Two facts of the vocabulary, checked when it is read, cut a text into independent units: no entry
goes from another character into U+2581, and no entry of two or more characters holds a line break
(or whichever white space that is true of).  Merges never cross such a place, so units are merged one
by one, and frequent units are counted once per worker (a bounded table).  A text without any such
place is one unit: O(n log n).  Documents are independent: one pass, no shuffle.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from tiers.llm.bpe import _path
from tiers.llm.common import row_blocks, ship

SPACE = "▁"
KNOWN_UNITS = 400_000     # units a worker remembers; then it starts over
KNOWN_CHARS = 48          # longer units are not remembered
STREAM_CHARS = 1 << 20    # longer texts are cut into units one at a time


class _Known(dict):
    """Counts of units, bounded."""

    def __init__(self, count):
        self.count = count

    def __missing__(self, unit: str) -> int:
        n = self.count(unit)
        if len(unit) <= KNOWN_CHARS:
            if len(self) >= KNOWN_UNITS:
                self.clear()
            self[unit] = n
        return n


class PieceCounter:
    """Counts tokens as the model at ``path`` makes them.

    The model must be BPE with byte fallback, without normalization, user-defined or unused entries, and
    with a space in front of the text; otherwise ``ValueError``.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.ranks = {sp.id_to_piece(i): -sp.get_score(i) for i in ids}
        longer = [p for p in self.ranks if len(p) > 1]
        cuts = SPACE not in "".join(p.lstrip(SPACE) for p in longer)
        alone = "".join(c for c in "\n\t\r\v\f" if not any(c in p for p in longer))
        word = f"[^{SPACE}{alone}]"
        self.units = re.compile(f"{SPACE}+{word}*|{word}+" + (f"|[{alone}]" if alone else "") if cuts else r"(?s:.+)")
        self.known = _Known(self.merge)
        for probe in ("", " ", "a", "  The end.\n\tSo  ", "é▁x \U0001F642\r\n", "<s>1 あ\x00</s>", "Ａ́"):
            if self.count(probe) != len(sp.encode(probe)):
                raise ValueError(f"{path} is not a plain BPE model with byte fallback and a space in front")

    def merge(self, unit: str) -> int:
        """Tokens of one unit of symbols."""
        ranks, pieces, n = self.ranks, list(unit), len(unit)
        heap = []
        for i in range(n - 1):
            rank = ranks.get(unit[i:i + 2])
            if rank is not None:
                heap.append((rank, i, 2))
        if heap:
            heapq.heapify(heap)
            pop, push = heapq.heappop, heapq.heappush
            after, before, end = list(range(1, n + 1)), list(range(-1, n)), n
            merges = 0
            while heap:
                _, i, size = pop(heap)
                left = pieces[i]
                j = after[i]
                if not left or j >= end or len(left) + len(pieces[j]) != size:
                    continue  # one of the two has been merged since
                left += pieces[j]
                merges += 1
                pieces[i], pieces[j] = left, ""
                after[i] = k = after[j]
                if k < end:
                    before[k] = i
                    rank = ranks.get(left + pieces[k])
                    if rank is not None:
                        push(heap, (rank, i, size + len(pieces[k])))
                h = before[i]
                if h >= 0:
                    rank = ranks.get(pieces[h] + left)
                    if rank is not None:
                        push(heap, (rank, h, size + len(pieces[h])))
            n -= merges
        return n + sum(len(p.encode("utf-8", "surrogatepass")) - 1 for p in pieces if len(p) == 1 and p not in ranks)

    def count(self, text: str) -> int:
        if not text:
            return 0
        symbols = SPACE + text.replace(" ", SPACE)
        if len(symbols) > STREAM_CHARS:
            known = self.known
            return sum(known[m[0]] for m in self.units.finditer(symbols))
        return sum(map(self.known.__getitem__, self.units.findall(symbols)))


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """One counter per worker process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``.

    ``n_bytes`` are the text's bytes in UTF-8, ``over_limit`` is ``n_tokens > limit``.  ``model`` is a
    model file, or its name in ``public_tokenizers``; the tasks open it.  A null or empty text has
    no bytes and no tokens; ids may be null or repeated (each row is counted by itself); other columns of
    ``docs`` are not read; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ship(docs.sparkSession)

    def run(batches):
        c = counter(_path(model))
        for b in row_blocks(batches):
            texts = b.column(1).to_pylist()
            size = [len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts]
            n = [c.count(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], [id_col, "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
