"""Personal data: fixed patterns as seeds, then bootstrapped contextual extraction.

Seeds are the matches of four patterns (email, ip, card, phone) with their checks.  Their
contexts, the two words before a mention and the two behind it, are the patterns of a bipartite graph with the
instances (the mentioned strings).  Each round scores a pattern by the share of mentions of known instances
among its occurrences in the whole corpus, those with a still undecided candidate left out; and an instance by
the patterns it stands in.  Patterns of high confidence and enough distinct known instances then admit the unknown
instances (words of five digits or more) beside them, which become known for the next round.

What is enough (``MIN_SUPPORT``) is the same for any corpus.  A pattern's known mentions are among its occurrences, so
they alone bound its confidence; only patterns that can still reach it are counted in the texts.

Everything is DataFrame functions.  The regular expressions are possessive forms of the plain ones
(same matches, but linear in the text and without recursion), and offsets come from the lengths of
the pieces between matches.  Only matches, candidates and counts are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiers.llm.common import Scratch

KINDS = ("email", "ip", "card", "phone")
SPACE, WORD = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
HINTS = {"email": "@", "ip": ".", "phone": "+"}
#: A word with five digits or more: an instance that contexts may reveal.
CANDIDATE = rf"(?<!{WORD})(?=(?:[^\x20\x09-\x0D0-9]*+[0-9]){{5}}){WORD}++"
#: Two words before a place, and behind it; what touches the place itself is part of neither.
LEFT = rf"(?<!{WORD})({WORD}++){SPACE}++({WORD}++){SPACE}++{WORD}*+$"
RIGHT = rf"^{WORD}*+{SPACE}++({WORD}++){SPACE}++({WORD}++)"

MIN_SUPPORT, MIN_CONFIDENCE, ROUNDS = 3, 0.8, 3
#: Patterns up to this number (16 bytes each) are broadcast when their occurrences are counted.
BROADCAST_PATTERNS = 500_000


def _luhn(digits) -> F.Column:
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for i in range(1, 21):
        d = F.substring(padded, i, 1).cast("int")
        total = total + (F.when(d > 4, 2 * d - 9).otherwise(2 * d) if i % 2 else d)
    return total % 10 == 0


def _valid(kind, match) -> F.Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    return (F.when(kind == "email", True)
            .when(kind == "ip", match.rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
            .when(kind == "card", F.when(n.between(12, 19), _luhn(digits)).otherwise(False))
            .otherwise(n.between(9, 15)))


def _mentions(texts: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """``(doc, kind, start, stop, match, left, right)`` of every match; ``left`` and ``right`` are hashes of the two
    words before and behind it, null without two (the gap to the next match counts, whatever its length)."""
    text = F.col("text")
    found = []
    for kind, pattern in patterns.items():
        hint = text.contains(HINTS[kind]) if kind in HINTS else F.lit(True)
        found.append(F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(f"m_{kind}"))
    # Rows of equal id and text are told apart while positions are summed up.
    some = texts.select("doc", "text", F.monotonically_increasing_id().alias("row"), *found).where(" or ".join(f"size(m_{k}) > 0" for k in patterns))

    def pair(p, words):
        low = F.lower(p)
        second = F.regexp_extract(low, words, 2)
        return F.when(second != "", F.xxhash64(F.regexp_extract(low, words, 1), second))

    ctx = lambda p: F.struct(F.char_length(p).alias("gap"), pair(p, LEFT).alias("left"), pair(p, RIGHT).alias("right"))
    lists = [F.when(F.size(f"m_{k}") > 0, F.struct(
        F.lit(k).alias("kind"), F.col(f"m_{k}").alias("matches"), F.transform(F.split(text, p, -1), ctx).alias("gaps")))
        for k, p in patterns.items()]
    rows = (some.select("doc", "row", F.explode(F.filter(F.array(*lists), lambda x: x.isNotNull())).alias("k"))
            .select("doc", "row", "k.kind", "k.matches", F.expr("slice(k.gaps, 1, size(k.matches))").alias("before"),
                    F.expr("slice(k.gaps, 2, size(k.matches))").alias("behind"))
            .select("doc", "row", "kind", F.posexplode(F.arrays_zip("matches", "before", "behind")).alias("at", "z"))
            .select("doc", "row", "kind", "at", F.col("z.matches").alias("match"), F.col("z.before.gap").alias("gap"),
                    F.col("z.before.left").alias("left"), F.col("z.behind.right").alias("right")))
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("stop", F.sum(F.col("gap") + F.char_length("match")).over(so_far).cast("long"))
            .select("doc", "kind", (F.col("stop") - F.char_length("match")).alias("start"), "stop", "match", "left", "right"))


def _pattern_totals(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(pair, side, total)``: how often each word pair of ``patterns`` stands before another word (side 0)
    and behind one (side 1)."""
    words = F.filter(F.split(F.lower("text"), f"{SPACE}+"), lambda w: w != "")
    at = lambda i: F.element_at("w", i.cast("int"))
    pairs = (texts.select(words.alias("w")).where("size(w) > 2")
             .select(F.size("w").alias("n"), F.posexplode(F.transform(
                 F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.xxhash64(at(i), at(i + 1)))).alias("i", "pair"))
             .select("pair", (F.col("i") < F.col("n") - 2).cast("long").alias("before"), (F.col("i") > 0).cast("long").alias("behind")))
    wanted = patterns.select("pair").distinct()
    few = wanted.count() <= BROADCAST_PATTERNS
    counts = pairs.join(F.broadcast(wanted) if few else wanted, "pair", "left_semi").groupBy("pair").agg(
        F.sum("before").alias("before"), F.sum("behind").alias("behind"))
    return counts.select("pair", F.posexplode(F.array("before", "behind")).alias("side", "total"))


def _grow(spark, scratch: Scratch, texts: DataFrame, seeds: DataFrame, unknown: DataFrame, min_support: int,
          min_confidence: float, rounds: int) -> DataFrame | None:
    """``(instance, kind)`` of the unknown instances that contexts reveal, or None."""
    pattern = ["pair", "side"]
    mentions = scratch.save(seeds.select("left", "right", "instance", "kind").unionByName(
        unknown.select("left", "right", "instance", F.lit(None).cast("string").alias("kind")))
        .select(F.posexplode(F.array("left", "right")).alias("side", "pair"), "instance", "kind").where("pair is not null"))
    known = scratch.save(seeds.select("instance", "kind", F.lit(1.0).alias("score")).distinct())
    before = known.count()
    # Unknown mentions alone never make a pattern, and a pattern of seeds alone reveals nothing.
    useful = mentions.groupBy(*pattern).agg(
        F.count_distinct("instance").alias("n"), F.count("kind").alias("s"), F.count(F.lit(1)).alias("all")) \
        .where((F.col("n") >= min_support) & (F.col("s") > 0) & (F.col("s") < F.col("all"))).select(*pattern)
    useful = scratch.save(useful)
    if not useful.take(1):
        return None
    graph = scratch.save(mentions.join(useful, pattern, "left_semi"))
    asked, totals = None, None
    for _ in range(rounds):
        decided = graph.select(*pattern, "instance").join(known, "instance", "left")
        support = (decided.groupBy(*pattern, "kind")
                   .agg(F.sum("score").alias("hits"), F.count(F.lit(1)).alias("here"), F.count_distinct("instance").alias("n")))
        inside = support.groupBy(*pattern).agg(
            *(F.coalesce(F.sum(F.when(which, F.col("here"))), F.lit(0)).alias(name)
              for name, which in (("sure", F.col("kind").isNotNull()), ("open", F.col("kind").isNull()))))
        able = scratch.save(support.where((F.col("n") >= min_support) & F.col("kind").isNotNull()).join(inside, pattern)
                            .where((F.col("open") > 0) & (F.col("hits") / (F.col("sure") + 1) >= min_confidence)))
        new = able.select(*pattern).distinct()
        new = new if asked is None else new.join(asked, pattern, "left_anti")
        new = scratch.save(new)
        if new.take(1):  # counted once, in the round that first needs them
            found = scratch.save(_pattern_totals(texts, new).join(new, pattern, "left_semi"))
            asked, totals = (new, found) if asked is None else (asked.unionByName(new), totals.unionByName(found))
        if totals is None:
            return None
        others = F.greatest(F.col("total") - F.col("open"), F.col("sure"))
        strong = (able.join(totals, pattern).withColumn("confidence", F.col("hits") / (others + 1))
                  .where(F.col("confidence") >= min_confidence).select(*pattern, "kind", "confidence"))
        scored = (graph.where("kind is null").select(*pattern, "instance").distinct().join(strong, pattern)
                  .groupBy("instance", "kind")
                  .agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence"))))).alias("score"))
                  .where(F.col("score") >= min_confidence))
        best = scored.groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"),
                                              F.max("score").alias("score"))
        seeds_only = known.where("score = 1.0")
        grown = scratch.save(seeds_only.unionByName(
            best.join(seeds_only.select("instance").distinct(), "instance", "left_anti").select("instance", "kind", "score")))
        after = grown.count()
        known = grown
        if after == before:
            break
        before = after
    return known.where("score < 1.0").select("instance", F.col("kind").alias("found"))


def personal_data(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
                  rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: ``(id, base, added)``, arrays of ``(start, kind_no, stop)`` in code points.

    ``base`` holds the valid pattern matches, ``added`` the mentions that contexts revealed (never
    overlapping a base span), both in order.  A null or empty text has none.  Rows of equal id and
    text share their result.
    """
    scratch = Scratch(spark, "pii")
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t")).alias("doc")
    texts = docs.where(F.length(text_col) > 0).select(key, F.col(text_col).alias("text"))
    number = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    kind = F.col("kind")
    base = scratch.save(_mentions(texts, PATTERNS).where(_valid(kind, F.col("match")))
                        .withColumn("instance", F.lower("match")).dropDuplicates(["doc", "kind", "start"]))
    trim = r"^[^\p{L}\p{N}+]*|[^\p{L}\p{N}]*$"
    head = F.char_length(F.regexp_extract("match", r"^([^\p{L}\p{N}+]*)", 1))
    core = F.regexp_replace("match", trim, "")
    loose = (_mentions(texts, {"candidate": CANDIDATE})
             .select("doc", (F.col("start") + head).alias("start"),
                     (F.col("start") + head + F.char_length(core)).alias("stop"),
                     F.lower(core).alias("instance"), "left", "right").dropDuplicates(["doc", "start"]))
    b = base.select(F.col("doc").alias("b_doc"), F.col("start").alias("b_start"), F.col("stop").alias("b_stop"))
    unknown = scratch.save(loose.join(b, (F.col("doc") == F.col("b_doc")) & (F.col("start") < F.col("b_stop"))
                                      & (F.col("b_start") < F.col("stop")), "left_anti"))
    revealed = _grow(spark, scratch, texts, base, unknown, min_support, min_confidence, rounds)
    span = F.struct("start", number[kind].alias("kind_no"), "stop")
    spans = base.select("doc", span.alias("span"), F.lit(True).alias("is_base"))
    if revealed is not None:
        added = unknown.join(revealed, "instance").withColumn("kind", F.col("found"))
        spans = spans.unionByName(added.select("doc", span.alias("span"), F.lit(False).alias("is_base")))
    per = spans.groupBy("doc").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_base"), F.col("span")))).alias("base"),
        F.sort_array(F.collect_list(F.when(~F.col("is_base"), F.col("span")))).alias("added"))
    none = F.array().cast("array<struct<start:bigint,kind_no:int,stop:bigint>>")
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t"))
            .join(per.select(F.col("doc.id").alias("p_id"), F.col("doc.t").alias("p_t"), "base", "added"),
                  F.col("id").eqNullSafe(F.col("p_id")) & (F.col("t") == F.col("p_t")), "left")
            .select("id", F.coalesce("base", none).alias("base"), F.coalesce("added", none).alias("added")))


def spans_text(spans) -> F.Column:
    """``kind:start:stop`` of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")
