"""Language identification by compression.

Each language has a zstandard raw-content dictionary made of a bounded sample of its texts.  A
text (its runs of letters, lower-cased) is compressed once with every dictionary; the smallest
output names the language.  A narrow margin between the two smallest outputs is reported as
not accepted.

Fit: at most ``docs_per_lang`` labelled rows per language (those of smallest id hash), each
giving a piece of at most ``piece_chars`` characters, so a dictionary never passes
``docs_per_lang * piece_chars`` characters whatever the table's size.  Prediction reads whole
texts in one pass without a shuffle.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiers.llm.common import row_blocks, ship

UNKNOWN = "und"
LEVEL = 6

_LETTERS = re.compile(r"[^\W\d_]+").findall


def letters(text: str) -> bytes:
    """The text's runs of letters, lower-cased, one space between them."""
    return " ".join(_LETTERS(text.lower())).encode("utf-8", "surrogatepass")


def fit_dictionaries(labelled: DataFrame, docs_per_lang: int = 48, piece_chars: int = 2048,
                     id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """One raw-content dictionary per language value; rows without text or language are left out.

    A piece starts anywhere in its text, by a hash of the id."""
    name = F.col(id_col).cast("string")
    starts = F.greatest(F.length(text_col) - piece_chars, F.lit(0)) + 1
    start = (F.pmod(F.xxhash64(name, F.lit("start")), starts) + 1).cast("int")
    order = Window.partitionBy("lang").orderBy("h", "piece")
    sample = (labelled.where(F.col(lang_col).isNotNull() & (F.length(text_col) > 0))
              .select(F.col(lang_col).alias("lang"), F.xxhash64(name).alias("h"),
                      F.substring(F.col(text_col), start, F.lit(piece_chars)).alias("piece"))
              .withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs_per_lang))
    pieces: dict[str, list] = {}
    for r in sample.collect():
        pieces.setdefault(r.lang, []).append((r.n, r.piece))
    return {lang: b"\n".join(letters(p) for _, p in sorted(found))
            for lang, found in sorted(pieces.items())}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.langs = sorted(dictionaries)
        self.compress = []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            self.compress.append(zstandard.ZstdCompressor(
                level=level, dict_data=d, write_content_size=False, write_checksum=False).compress)

    def classify(self, text: str | None) -> tuple[str, float, float]:
        """``(language, score, margin)``; the first of equal languages by name."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        data = letters(text)
        sizes = [len(c(data)) for c in self.compress]
        best = min(sizes)
        at = sizes.index(best)
        rest = sizes[:at] + sizes[at + 1:]
        margin = (min(rest) - best) / min(rest) if rest else 1.0
        share = 1.0 / (1.0 + sum(math.exp(max(-700.0, (best - s) / 2.0)) for s in rest))
        return self.langs[at], share, margin


def identify(spark: SparkSession, docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = 0.01,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, lang_pred, score, margin, accepted)`` per row of ``docs``.

    ``und`` with score 0 for a null text, one without a letter, or without dictionaries.
    ``score`` weighs the chosen language's output against the others' (0 to 1); ``margin`` is the
    runner-up's relative excess; below ``min_margin`` the prediction is not ``accepted``.
    """
    ship(spark)
    shared = spark.sparkContext.broadcast(dictionaries)  # bounded by the fit's parameters
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        model = Classifier(shared.value)
        for b in row_blocks(batches):
            found = [model.classify(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.float64()),
                 pa.array([x[0] != UNKNOWN and x[2] >= min_margin for x in found], pa.bool_())],
                [id_col, "lang_pred", "score", "margin", "accepted"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, margin double, accepted boolean")
