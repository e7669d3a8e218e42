"""Helpers that several operators share: tables, intermediate results, words and hashes."""

from __future__ import annotations

import atexit
import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.session import scratch_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the session's executors, once per application, so that their Python
    workers need no copy of it (as ``spark-submit --py-files`` does)."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tiers-package-"), "tiers_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---- intermediate results -------------------------------------------------------------------

def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session is gone: its shared folder is removed with it
        pass


class Scratch:
    """Parquet tables under the session's shared checkpoint folder.

    A written table cuts the lineage: a lost executor costs its running tasks, never an
    earlier step.  ``drop`` removes a table that no later step reads; what is left is
    removed when the session's process ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark, self.root = spark, scratch_dir(spark, f"llm-{label}")
        self._n = 0
        self._paths: dict[int, str] = {}
        atexit.register(_delete, spark, self.root)

    def save(self, df: DataFrame) -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:04d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, df: DataFrame) -> None:
        path = self._paths.pop(id(df), None)
        if path:
            _delete(self.spark, path)


# ---- words and shingles -----------------------------------------------------------------------

def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_count(col) -> F.Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text column; 0 for a null text."""
    return F.coalesce(F.regexp_count(col, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (murmur3's finalizer)."""
    x = x ^ (x >> _MIX[2])
    x = x * _MIX[0]
    x = x ^ (x >> _MIX[2])
    x = x * _MIX[1]
    return x ^ (x >> _MIX[2])


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's ``k``-word shingles.

    With fewer than ``k`` words the whole sequence is the one shingle; without words the
    set is empty.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), np.uint64, len(words))
    take = min(k, len(words))
    acc = np.full(len(h) - take + 1, np.uint64(take), np.uint64)
    for i in range(take):
        acc = mix64(acc ^ h[i:len(h) - take + 1 + i]) + np.uint64(0x9E3779B97F4A7C15)
    return np.unique(acc)


def row_blocks(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow batches cut into blocks of at most ``rows`` rows, so that Python objects made
    from a block stay few even where a batch holds many long texts.  At the end, freed memory is given back."""
    try:
        for b in batches:
            for i in range(0, b.num_rows, rows):
                yield b.slice(i, rows)
    finally:
        give_back()


def give_back() -> None:
    """Hands the memory that this process has freed back to the system.

    The C library keeps freed memory for later; an idle worker would hold it while the executor needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)
