"""The registered queries against their SQL, and the pipeline's stages."""

from __future__ import annotations

import collections
import hashlib
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.test_oracle import _digest
from tiers.llm import toxicity
from tiers.llm.common import read_table
from tiers.llm.oracles import ORACLES
from tiers.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.sql(E.oracle_sql()[name])
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(res.columns)
    assert _digest(rows, df.columns) == _digest(res.fetchall(), res.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op13_spelling_variants"}))
def test_query_has_a_row_per_document(spark, name):
    ids = [r.doc_id for r in QUERIES[name](spark, SF_SMALL).select("doc_id").collect()]
    assert sorted(ids) == sorted(r.doc_id for r in read_table(spark, SF_SMALL, "documents").select("doc_id").collect())


def test_personal_data_counts_by_kind(spark, workdir):
    texts = ["a@b.c 1.2.3.4 x 4111 1111 1111 1111 x +1 (017) 555-7713", "a@b.c d@e.f g@h.i", "1.2.3.4 5.6.7.8", "none", None]
    spark.createDataFrame(enumerate(texts), "doc_id long, text string").write.parquet(f"{workdir}/documents.parquet")
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in QUERIES["op3_personal_data"](spark, workdir).collect()}
    assert got == {0: (1, 1, 1, 1), 1: (3, 0, 0, 0), 2: (0, 2, 0, 0), 3: (0,) * 4, 4: (0,) * 4}


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "MinHash near-dedup", "mixing", "byte-level BPE"]
    docs = read_table(spark, SF_SMALL, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (10 ** 6, "", "en", None, 0),
                                 (10 ** 6 + 1, "word " * 30000, "en", "s", 150000)], docs.schema)
    rows = docs.unionByName(odd)
    for c in ("cut_lines", "row_no", "_row_no", "_n", "copy", "label", "score", "t"):
        rows = rows.withColumn(c, F.lit(f"clash {c}"))
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, rows.where("false"), SF_SMALL)
        assert empty.count() == 0, name
        after = stage(spark, rows, SF_SMALL)
        if name == "byte-level BPE":
            after = after.drop("token_ids", "n_tokens", "decoded_sha256")
        assert after.columns == rows.columns and after.dtypes == rows.dtypes, name
        got = after.select("doc_id", "cut_lines", "row_no", "_row_no", "_n").collect()
        assert all(r[1:] == ("clash cut_lines", "clash row_no", "clash _row_no", "clash _n") for r in got), name
        ids = {r.doc_id for r in got}
        assert name == "mixing" or {None, 10 ** 6} <= ids and (name == "toxicity" or 10 ** 6 + 1 in ids), name
        assert len(ids) > 100, name


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    k = min(5, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def test_near_duplicates_stage_against_brute_force(spark):
    """All pairs compared: of every group the row of smallest id stays, and every row of another text of a repeated id."""
    docs = read_table(spark, SF_SMALL, "documents")
    some = {r.doc_id: r.text for r in docs.collect()}
    ids = sorted(some)
    extra = [(ids[0], "a text of its own under a used number", "en", "s", 1), (ids[0], some[ids[5]], "en", "s", 1),
             (None, some[ids[7]], "en", "s", 1), (None, "no number but a text", "en", "s", 1), (ids[9], some[ids[9]], "en", "s", 1),
             (10 ** 6, "   ", "en", "s", 3), (10 ** 6, "   ", "en", "s", 3)]
    rows = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    all_rows = [(r.doc_id, r.text, shingles(r.text)) for r in rows.collect()]
    root = list(range(len(all_rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, (_, _, a) in enumerate(all_rows):
        for j in range(i):
            b = all_rows[j][2]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = collections.defaultdict(list)
    for i, (d, t, _) in enumerate(all_rows):
        groups[top(i)].append((d is None, d if d is not None else 0))
    want = collections.Counter(min(g) for g in groups.values())
    got = corpus_pipeline.drop_near_duplicates(spark, rows, SF_SMALL).select("doc_id", "text").collect()
    assert collections.Counter((r.doc_id is None, r.doc_id or 0) for r in got) == want
    assert "a text of its own under a used number" in {r.text for r in got}
    texts = collections.Counter(shingles(r.text) for r in got if shingles(r.text))
    assert max(texts.values()) == 1


def test_toxic_stage_keeps_what_the_scores_say(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    labels = read_table(spark, SF_SMALL, "labels").select("doc_id", F.col("toxic").alias("label"))
    index = toxicity.fit_index(docs.select("doc_id", "text").join(labels, "doc_id"))
    want = {r.doc_id for r in docs.collect() if index.score(toxicity.features(r.text))[0] < 0.5}
    got = [r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF_SMALL).select("doc_id").collect()]
    assert sorted(got) == sorted(want) and len(want) < docs.count()


def test_line_stage_against_brute_force(spark):
    """Every pair of places compared: line runs of 50 words that an earlier place holds are cut."""
    run = "\n".join(f"line {i} of the passage that many documents share word for word" for i in range(8))
    texts = {r.doc_id: r.text for r in read_table(spark, SF_SMALL, "documents").limit(60).collect() if r.text}
    texts |= {10 ** 6 + i: f"head {i}\n{run}\ntail {i}" for i in range(5)} | {10 ** 7: run, 10 ** 8: "one\ntwo"}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], read_table(spark, SF_SMALL, "documents").schema)
    places = [(i, n, line) for i in sorted(texts) for n, line in enumerate(texts[i].split("\n"))]
    line_of = {(i, n): line for i, n, line in places}
    at = collections.defaultdict(list)
    for i, n, line in places:
        at[line].append((i, n))
    cut = set()
    for i, n, line in places:
        for j, m in at[line]:
            if (j, m) < (i, n):
                k = words = 0
                while (i, n + k) in line_of and line_of[i, n + k] == line_of.get((j, m + k)):
                    words += max(1, len(re.findall(r"[^\x20\x09-\x0D]+", line_of[i, n + k])))
                    k += 1
                if words >= 50:
                    cut |= {(i, n + x) for x in range(k)}
    want = {}
    for i, t in texts.items():
        kept = "\n".join(line for n, line in enumerate(t.split("\n")) if (i, n) not in cut)
        if kept or not any(c[0] == i for c in cut):
            want[i] = kept
    got = {r.doc_id: r for r in corpus_pipeline.drop_repeated_lines(spark, docs, SF_SMALL).collect()}
    assert {i: r.text for i, r in got.items()} == want and len(cut) >= 40 and 10 ** 7 not in got
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_mixing_stage_reaches_its_targets(spark):
    """Targets filled one by one; every source's words come near its own; whole documents only."""
    docs = read_table(spark, SF_SMALL, "documents")
    size = {r.doc_id: (r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")), r.text) for r in docs.collect()}
    per = collections.Counter()
    for s, n, _ in size.values():
        per[s] += n
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left = {}, set(names)
    while left:
        room = sum(per.values()) - sum(target.values())
        level = room / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > 3 * per[s]}
        target |= {s: 3.0 * per[s] for s in over} if over else {s: level * weight[s] for s in left}
        left -= over or left
    got = corpus_pipeline.mix_sources(spark, docs, SF_SMALL).collect()
    taken, times = collections.Counter(), collections.Counter(r.doc_id for r in got)
    for r in got:
        assert r.text == size[r.doc_id][2]
        taken[r.source] += size[r.doc_id][1]
    longest = {s: max(n for t, n, _ in size.values() if t == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= max(0.02 * target[s], 0.5 * longest[s]) for s in names)
    assert max(times.values()) <= 3


def test_pipeline_batches_are_small(spark):
    own, key = spark.newSession(), corpus_pipeline.BATCH_KEY
    for before, after in (("10000", 1024), ("0", 1024), ("100", 100)):
        own.conf.set(key, before)
        empty = own.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
        for name, stage in corpus_pipeline.STAGES[3:]:
            stage(own, empty, SF_SMALL)
        assert int(own.conf.get(key)) == after
        sizes = own.range(3000).coalesce(1).mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["id"]) for b in batches), "id long").collect()
        assert max(r.id for r in sizes) == after
    own.conf.set(key, "7000")
    corpus_pipeline.run(own, SF_SMALL)
    assert own.conf.get(key) == "7000"


def test_pipeline(spark):
    out = E.queries()["pipeline"](spark, SF_SMALL)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    for r in out.collect():
        assert r.n_tokens == len(r.token_ids)
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
