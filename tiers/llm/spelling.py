"""Spelling variants by a variable-length gram index.

1. *Gram dictionary*, pruned by frequency: all grams of ``Q_MIN`` code points, and a longer gram only
   if the gram without its last letter is frequent, that is, makes up at least ``SHARE`` of all grams
   of its length.  At most 1 / ``SHARE`` grams of a length can be frequent, so the longer ones number at
   most (letters of the alphabet) / ``SHARE`` a length, however many words there are: that bounds what the
   driver collects and the tasks hold.
2. *Decomposition*: at each place of a word (with a mark at each end) the longest gram of the
   dictionary, unless an earlier chosen gram covers it.
3. *Affected grams*: for each place at which one letter may be inserted, deleted or replaced, the chosen
   grams that this can take away: those over the place; those before it which an earlier or own start
   could extend across it (the letters up to the place begin a longer gram of the dictionary); those
   behind it which a gram across the place could cover (the letters behind the place end one).  The
   word's bound is the most over its places.  Near words keep all other grams at the same place, or
   one further in the longer word.
4. *List merging*: two near words share all but the bound's number of grams, so among its rarest
   (bound + 1) grams each has one that the other has among its own.  Only those go into the inverted lists, one
   list for each gram, place and word length; a list's words meet those of equal length, and of one
   letter more at the same and at the next place.  A long list is salted.
5. *Verification* inside the join: Levenshtein distance 1.  Candidates are never written out.

A word whose bound leaves none of its grams untouched (possible for short words from ``Q_MAX`` = 4 on) goes
by its grams of ``Q_MIN`` letters as well, of which an edit takes at most ``Q_MIN``.

The words are counted by Spark functions with map-side aggregation, so a word of a third of all occurrences costs
each task one row.  Everything later works on distinct words.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.common import Scratch, ship

RUN = "[A-Za-zÀ-ÿ]+"
Q_MIN, Q_MAX = 2, 4
SHARE = 1 / 5000
SALT_ROWS = 20_000
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- words --------------------------------------------------------------------------------------

def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199,
                min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """``(word, n)``: the letter runs of all texts, A-Z lower-cased, with at least ``min_chars`` code points and
    ``min_count`` occurrences.

    A run loses one letter where ``every`` divides its hash with the document's id (``h``: at ``h`` modulo its
    length); 0 for ``every`` leaves all runs as they are, and so does a null id.
    """
    runs = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(F.regexp_extract_all(
        F.translate(F.col(text_col), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    word = F.col("run")
    if every:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (h % F.char_length("run")).cast("int")
        word = F.when(h % every == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length("run")))).otherwise(word)
    return (runs.where(F.char_length("run") >= min_chars).select(word.alias("word"))
            .where(F.char_length("word") >= min_chars)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# ---- grams --------------------------------------------------------------------------------------

class Grams:
    """Decomposition of words by a dictionary of the grams longer than ``Q_MIN``."""

    def __init__(self, longer, q_max: int = Q_MAX):
        self.longer, self.q_max = frozenset(longer), q_max
        #: What letters a longer gram begins with, and ends with.
        self.heads = {g[:k] for g in self.longer for k in range(1, len(g))}
        self.tails = {g[k:] for g in self.longer for k in range(1, len(g))}

    def split(self, word: str) -> list[tuple[int, str]]:
        """The chosen grams of a word in its marks, with their places."""
        chosen, covered, q = [], 0, Q_MIN
        for p in range(len(word) - q + 1):
            size = q
            while size < self.q_max and p + size < len(word) and word[p:p + size + 1] in self.longer:
                size += 1
            if p + size > covered:
                chosen.append((p, word[p:p + size]))
                covered = p + size
        return chosen

    def affected(self, word: str, chosen: list[tuple[int, str]]) -> int:
        """The most grams of ``chosen`` that one edit between the marks can take away."""
        most, last = 0, len(word) - 1
        spans = [(p, p + len(g)) for p, g in chosen]
        for i in range(1, last + 1):            # replaced or deleted: the letter at i; inserted: before i
            for first in ((i, i + 1) if i < last else (i,)):
                # Letters [first - 1 or i, ...): what stands before the place ends at i, what stands behind begins at ``first``.
                before = next((i - k for k in range(min(self.q_max - 1, i), 0, -1) if word[i - k:i] in self.heads), i)
                behind = next((first + k for k in range(min(self.q_max - 1, len(word) - first), 0, -1)
                               if word[first:first + k] in self.tails), first)
                n = 0
                for s, e in spans:
                    if e <= i:
                        n += s >= before
                    elif s >= first:
                        n += e <= behind
                    else:
                        n += 1
                most = max(most, n)
        return most

    def rarest(self, word: str, order) -> list[tuple[int, str]] | None:
        """All occurrences of the word's rarest (bound + 1) distinct grams; None where the bound leaves none untouched."""
        chosen = self.split(word)
        distinct = sorted({g for _, g in chosen}, key=order)
        keep = self.affected(word, chosen) + 1
        if keep > len(distinct):
            return None
        few = set(distinct[:keep])
        return [x for x in chosen if x[1] in few]


def _marked(word: str) -> str:
    return START + word + END


def _gram_counts(words: DataFrame, grams_of) -> DataFrame:
    """``(gram, n)``: the words' grams, combined in each task."""
    def run(batches):
        seen = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                seen.update(grams_of(_marked(w)))
            if len(seen) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["gram", "m"])
                seen.clear()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], ["gram", "m"])

    return words.select("word").mapInArrow(run, "gram string, m long").groupBy("gram").agg(F.sum("m").alias("n"))


def fit_grams(scratch: Scratch, words: DataFrame, q_max: int = Q_MAX, share: float = SHARE) -> Grams:
    """The dictionary of the words' grams (see the module)."""
    counts = scratch.save(_gram_counts(words, lambda w: [w[p:p + q] for q in range(Q_MIN, q_max + 1)
                                                         for p in range(len(w) - q + 1)]))
    longer: set[str] = set()
    size = F.char_length("gram")
    totals = {r.q: r.n for r in counts.groupBy(size.alias("q")).agg(F.sum("n").alias("n")).collect()}
    for q in range(Q_MIN, q_max):
        frequent = counts.where((size == q) & (F.col("n") >= max(2.0, share * totals.get(q, 0)))).select(F.col("gram").alias("head"))
        heads = {r.head for r in frequent.collect()}
        if q > Q_MIN:
            heads &= longer
        table = scratch.spark.createDataFrame([(h,) for h in sorted(heads)], "head string")
        longer |= {r.gram for r in counts.where(size == q + 1).join(
            F.broadcast(table), F.col("head") == F.expr(f"substring(gram, 1, {q})"), "left_semi").select("gram").collect()}
    return Grams(longer, q_max)


def _entries(words: DataFrame, grams: Grams, freq: dict[str, int], salt_rows: int) -> DataFrame:
    """Rows ``(gram, place, size, salts, mine, word, n)``: a word's places in the lists; a list of a frequent gram
    is dealt over ``salts`` parts, of which the word is in part ``mine``."""
    plain = Grams((), Q_MIN)
    schema = pa.schema([("gram", pa.string()), ("place", pa.int32()), ("size", pa.int32()), ("salts", pa.int32()),
                        ("mine", pa.int32()), ("word", pa.string()), ("n", pa.int64())])

    def order(gram):
        return freq.get(gram, 0), gram

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 5000):
                part, out = b.slice(at, 5000), []
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    marked, mine = _marked(word), zlib.crc32(word.encode("utf-8"))
                    few = grams.rarest(marked, order)
                    # Of a pair with one word without a sure gram, the other's rarest grams are in this one's whole
                    # list; two words without one meet in the plain lists.
                    places = few or grams.split(marked)
                    if few is None:
                        places = places + [(p, "=" + g) for p, g in plain.rarest(marked, order)]
                    for p, g in places:
                        salts = 1 + freq.get(g.lstrip("="), 0) // salt_rows
                        out.append((g, p, len(word), salts, mine % salts, word, n))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return words.select("word", "n").mapInArrow(
        run, "gram string, place int, size int, salts int, mine int, word string, n long")


def near_words(spark: SparkSession, words: DataFrame, q_max: int = Q_MAX, share: float = SHARE,
               salt_rows: int = SALT_ROWS, scratch: Scratch | None = None) -> DataFrame:
    """``(a, a_n, b, b_n)``: each unordered pair of different words of ``(word, n)`` at Levenshtein distance 1,
    once.  Words are of letters, have at least two code points, and are unique."""
    scratch = scratch or Scratch(spark, "spelling")
    ship(spark)
    grams = fit_grams(scratch, words, q_max, share)
    plain = Grams((), Q_MIN)
    used = _gram_counts(words, lambda w: {g for _, g in grams.split(w)} | {g for _, g in plain.split(w)})
    freq = {r.gram: r.n for r in used.collect()}  # grams of two letters and the dictionary: bounded by the alphabet and SHARE
    entries = scratch.save(_entries(words, grams, freq, salt_rows))
    listed = entries.select("gram", "place", "size", F.col("mine").alias("salt"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    looked = F.explode(F.array(*(F.struct((F.col("place") + p).alias("place"), (F.col("size") + s).alias("size"), F.lit(s).alias("shift"))
                                 for p, s in ((0, 0), (0, 1), (1, 1)))))
    asked = (entries.select("gram", looked.alias("x"), "salts", F.col("word").alias("b"), F.col("n").alias("b_n"))
             .select("gram", "x.*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "b", "b_n"))
    key = ["gram", "place", "size", "salt"]
    on = [listed[k] == asked[k] for k in key]
    near = ((F.col("shift") == 1) | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    return listed.join(asked.hint("merge"), [*on, near]) \
        .groupBy("a", "b").agg(F.first("a_n").alias("a_n"), F.first("b_n").alias("b_n"))


# ---- groups -------------------------------------------------------------------------------------

def variant_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   every: int = 199, min_chars: int = 6, min_count: int = 5, ratio: int = 5,
                   q_max: int = Q_MAX, share: float = SHARE) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)``, one row per word of ``word_counts``.

    ``n_near`` counts the words at Levenshtein distance 1.  ``form`` is the commonest of them (the smallest
    in code-point order among equals), if it occurs at least ``ratio`` times as often as the word; ``root`` follows
    the forms to the last one.  Null and empty texts have no words; repeated rows count again; null ids
    take part (see ``word_counts``); other columns are not read; no words, no rows.  ``min_chars`` is at least 2.
    """
    if min_chars < 2 or ratio < 2:
        raise ValueError("min_chars and ratio must be at least 2")
    scratch = Scratch(spark, "spelling")
    words = scratch.save(word_counts(docs, id_col, text_col, every, min_chars, min_count))
    pairs = scratch.save(near_words(spark, words, q_max, share, scratch=scratch))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("w"))).alias("best"))
    taken = -F.col("best.k") >= F.col("n") * ratio
    rows = scratch.save(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best.w")).alias("form"), F.when(taken, -F.col("best.k")).alias("form_n")))
    # Pointer doubling: a form's count is at least ``ratio`` times the word's, so chains are short and without circles.
    roots = scratch.save(rows.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = scratch.save(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if not step.where("next is not null").take(1):
            break
        scratch.drop(roots)
        roots = step.drop("next")
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
