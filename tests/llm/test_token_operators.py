"""Token counts, token alignment and spelling variants against brute force and the libraries."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.test_operators import frame
from tiers.llm import align, piece_counts, spelling
from tiers.llm.common import read_table
from tiers.llm.queries import BYTE_LEVEL, PIECES, QUERIES

PARTS = ["a", "the", " ", "  ", "\n", "\t", "▁", "▁▁", "\r\n", " {\r\n", ");\r", "1", "23", "é", "ß", "!", "..", "漢字", "😀",
         "é", "x" * 30, " " * 20, "ing", "'re", "٣", "<s>", "</s>", "<0x41>", "\x00", "　", "﻿", "�", " word word",
         "<|endoftext|>"]
ODD = [(0, None), (1, ""), (2, " "), (3, "Hello  world's\n"), (3, "Hello  world's\n"), (None, "a ▁ b"), (5, "ab" * 4000),
       (6, "long words " * 40000), (7, " " * 5000), (8, "<|endoftext|> <s>")]


def random_texts(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(PIECES))


# ---- 11 --------------------------------------------------------------------------------------

def test_piece_counts_equal_the_library(pieces, monkeypatch):
    c = piece_counts.PieceCounter(public_tokenizers.path(PIECES))
    texts = random_texts(1500, 1) + ["a" * 3000, " " * 3000, "\n" * 900 + "x", "漢" * 900, "ab" * 2000]
    want = [len(x) for x in pieces.encode(texts)]
    assert [c.count(t) for t in texts] == want
    monkeypatch.setattr(piece_counts, "STREAM_CHARS", 10)
    monkeypatch.setattr(piece_counts, "KNOWN_UNITS", 50)
    monkeypatch.setattr(piece_counts, "KNOWN_CHARS", 4)
    assert [c.count(t) for t in texts] == want


def test_piece_counts_of_odd_rows(spark, pieces):
    df = frame(spark, ODD).withColumn("n_tokens", F.lit("clash")).withColumn("n_bytes", F.lit("clash"))
    got = piece_counts.count_tokens(df, PIECES, limit=3)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), len(pieces.encode(t or "")), len(pieces.encode(t or "")) > 3) for i, t in ODD]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert piece_counts.count_tokens(df.where("false"), PIECES).count() == 0


def test_piece_counts_of_documents(spark, pieces):
    texts = {r.doc_id: r.text or "" for r in read_table(spark, SF_SMALL, "documents").collect()}
    for r in QUERIES["op11_token_counts"](spark, SF_SMALL).collect():
        n = len(pieces.encode(texts[r.doc_id]))
        assert tuple(r) == (r.doc_id, len(texts[r.doc_id].encode()), n, n > 4096)


# ---- 12 --------------------------------------------------------------------------------------

def ends_of(rnd, size, n):
    return np.array(sorted({*rnd.sample(range(1, size), n - 1), size}))


def test_links_against_brute_force():
    rnd = random.Random(2)
    for _ in range(200):
        size = rnd.randint(2, 40)
        a, b = (ends_of(rnd, size, rnd.randint(1, size)) for _ in range(2))
        spans = [[*zip([0, *e[:-1].tolist()], e.tolist())] for e in (a, b)]
        both = sorted(set(a.tolist()) & set(b.tolist()))
        group = [[sum(c < e for c in both) for _, e in s] for s in spans]
        want = collections.defaultdict(dict)
        for i, (s, e) in enumerate(spans[0]):
            for j, (t, f) in enumerate(spans[1]):
                if (shared := min(e, f) - max(s, t)) > 0:
                    want["overlap"][i, j] = shared
                    if e == f:
                        want["end"][i, j] = shared
                if group[0][i] == group[1][j]:
                    want["group"][i, j] = 1
        for kind, links in want.items():
            i, j, v = align.links(a, b, kind)
            assert dict(zip(zip(i.tolist(), j.tolist()), v.tolist())) == links and len(i) == len(links)
        assert [x.tolist() for x in align.groups(a, b)[:2]] == group
    empty = np.empty(0, np.int64)
    assert all(len(x) == 0 for kind in ("overlap", "end", "group") for x in align.links(empty, empty, kind))


def test_sparse_product_against_dense():
    rng = np.random.default_rng(3)
    for _ in range(50):
        m, k, n = rng.integers(1, 12, 3)
        dense = [rng.integers(0, 4, s) * (rng.random(s) < 0.4) for s in ((m, k), (n, k))]
        a, b = (align.Csr(np.concatenate([[0], np.cumsum((d > 0).sum(1))]), np.nonzero(d)[1], d[d > 0], k) for d in dense)
        c = a.times(b.transposed())
        got = np.zeros((m, n), int)
        got[c.rows(), c.cols] = c.data
        assert (got == dense[0] @ dense[1].T).all() and len(c.cols) == (got > 0).sum()


def brute_alignment(texts, a, sp):
    """Straight from the definition, a document at a time."""
    letters = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if chr(b) not in letters)}
    docs, pairs = [], collections.Counter()
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = sp.encode(t) if t else []
        bx = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        by = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not t or b"".join(bx) != (" " + t).encode() or b"".join(by) != (" " + t).encode():
            docs.append(None)
            continue
        ex, ey = np.cumsum([len(z) for z in bx]).tolist(), np.cumsum([len(z) for z in by]).tolist()
        linked = [(i, j) for j, e in zip(y, ey) for i, f in zip(x, ex) if e == f] if len(x) < 3000 else \
            [(dict(zip(ex, x))[e], j) for j, e in zip(y, ey) if e in set(ex)]
        groups, low = [], 0
        for e in sorted(set(ex) & set(ey)):
            groups.append("|".join(",".join(str(i) for i, f in zip(ids, es) if low < f <= e) for ids, es in ((x, ex), (y, ey))))
            low = e
        pairs.update(linked)
        docs.append((len(x), len(y), groups, linked))
    most = collections.defaultdict(int)
    for (_, j), n in pairs.items():
        most[j] = max(most[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (d[0], d[1], len(d[2]), len(d[3]), sum(pairs[p] == most[p[1]] for p in d[3]), sum(pairs[p] for p in d[3]),
             hashlib.sha256(";".join(d[2]).encode()).hexdigest()) for d in docs]


@pytest.fixture(scope="module")
def byte_level():
    t = Tokenizer.from_file(public_tokenizers.path(BYTE_LEVEL))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("hot", [0, 5, 500_000])
def test_alignment_against_brute_force(spark, byte_level, pieces, hot):
    rows = [r for r in ODD if r[0] != 6] + [(100 + i, t) for i, t in enumerate(random_texts(150, 4))]
    df = frame(spark, rows).withColumn("n_a", F.lit("clash")).withColumn("row", F.lit("clash")).withColumn("links", F.lit(1))
    got = align.align(spark, df, BYTE_LEVEL, PIECES, hot_pairs=hot)
    assert got.columns == ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(i, *x) for (i, _), x in zip(rows, brute_alignment([t for _, t in rows], byte_level, pieces))]
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    if not hot:
        assert align.align(spark, df.where("false"), BYTE_LEVEL, PIECES).count() == 0


def test_parts_of_long_texts_join(byte_level, pieces, monkeypatch):
    texts = ["word 12 é and " * 400, "a" * 3000 + " b c", " lead", "two  spaces here " * 300, "bad ▁ one " * 300]
    al = align.Aligner(public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
    whole = al.texts(texts)
    monkeypatch.setattr(align, "BLOCK_CHARS", 50)
    monkeypatch.setattr(align, "KNOWN_UNITS", 3)
    monkeypatch.setattr(align, "KNOWN_CHARS", 4)
    assert len(al.stretches(texts[0])) > 100
    assert al.texts(texts) == whole
    assert whole[4] == (0, 0, 0, b"", "")


def test_new_units_share_lines_and_late_ones_stay_known(monkeypatch):
    al = align.Aligner(public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
    rnd = random.Random(7)
    units = list(dict.fromkeys([rnd.choice(PARTS).strip() + str(i) + rnd.choice(PARTS) for i in range(300)] +
                               ["'re", "n't", "a\u0301", "\u0301a", "\u2581", "x\n", "\ty", "<s>", "a  b", "a\nb"]))
    want = [al.lines([[u]])[u] for u in units]
    assert None in want and al.block(units) == want
    asked = []
    encode = al.a.encode
    monkeypatch.setattr(al.a, "encode", lambda parts: asked.extend(parts) or encode(parts))
    al.block([f"w{i}" for i in range(64)])
    assert len(asked) == 64 / align.LINE_UNITS
    # A unit in use stays known while others come and go: it was forgotten with all others before.
    monkeypatch.setattr(align, "KNOWN_UNITS", 40)
    for i in range(30):
        al.learn(["often", *(f"u{i}x{k}" for k in range(15))])
    assert sum("often" in line.split() for line in asked) == 1
    assert len(al.known) + len(al.older) <= 40 + 2 * 16
    assert al.texts(["often u3x1 " * 40])[0][0] == len(encode(["often u3x1 " * 40])[0])


def test_new_units_cost_few_lines_and_little_memory(monkeypatch):
    al = align.Aligner(public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES))
    units = [f"w{i}é" for i in range(511)] + ["n't"]
    want = [al.lines([[u]])[u] for u in units]
    ids = [x.encode([u])[0] for x in (al.a, al.b) for u in units]
    assert [len(x) for x in want] == [4 * (len(a) + len(b)) for a, b in zip(ids, ids[len(units):])]
    asked = []
    encode = al.a.encode
    monkeypatch.setattr(al.a, "encode", lambda parts: asked.extend(parts) or encode(parts))
    assert al.block(units[:-1]) == want[:-1] and len(asked) == 8  # 32 lines before
    asked.clear()
    bad = [*units, "\u2581"]  # costs its own lines, not those of all
    assert al.block(bad) == [*want, None] and len(asked) <= 9 + 8 + 8
    # At most as many units as in the text's own cuts, wherever spaces have odd neighbours.
    rnd = random.Random(11)
    for _ in range(2000):
        text = "".join(rnd.choice(["a", "é", " ", " ", "\n", "–", "\u0301", ".", "_", "\u00a0"]) for _ in range(rnd.randint(1, 9)))
        assert al.units(text) == align.CUT.split(text)


# ---- 13 --------------------------------------------------------------------------------------

def brute_variants(docs, every=199, min_chars=6, min_count=5, ratio=5):
    n = collections.Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{i}:{run}".encode())
            if every and i is not None and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_chars and c >= min_count}
    by_hole = collections.defaultdict(set)
    for w in n:
        for k in range(len(w)):
            by_hole[w[:k] + "*" + w[k + 1:]].add(w)
    near = collections.defaultdict(set)
    for ws in by_hole.values():
        for w in ws:
            near[w] |= ws - {w}
    for w in n:
        for k in range(len(w)):
            if (x := w[:k] + w[k + 1:]) in n:
                near[w].add(x)
                near[x].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return {(w, n[w], len(near[w]), form[w], n.get(form[w]), root(w)) for w in n}


def variant_rows(df):
    return [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]


def spelled(rnd, n):
    parts = ["an", "on", "the", "ti", "tion", "ing", "ha", "re", "ou", "É", "er", "é"]
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(2, 4))) for _ in range(n)]
    out = []
    for w in words:
        out += [w] * rnd.choice([5, 6, 30, 200])
        for _ in range(3):
            k, c = rnd.randrange(len(w)), rnd.choice("anothe")
            out += [rnd.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])] * rnd.choice([1, 5, 9, 40])
    rnd.shuffle(out)
    return [(i, ", ".join(out[i * 50:i * 50 + 50])) for i in range(len(out) // 50 + 1)]


@pytest.mark.parametrize("q_max, share, every, chars, salt", [(2, 1, 199, 6, 20_000), (3, 1 / 300, 7, 2, 20), (4, 1 / 5000, 199, 6, 20_000), (5, 1e-5, 3, 2, 9)])
def test_variants_against_brute_force(spark, monkeypatch, q_max, share, every, chars, salt):
    docs = spelled(random.Random(q_max), 60) + [(None, "thetion aaaaaa aaaaaaa"), (7, None), (8, ""), (9, "abababab ababab" * 3)]
    docs += docs[:9] + [(11, "aaaaaaa aaaaaa aaaaaaaa aa aaa a ab ba b " * 6)]
    docs += [(None, "charting " * 999), (None, "charing " * 150), (None, "haring " * 25), (None, "harin " * 5)]
    monkeypatch.setattr(spelling.near_words, "__defaults__", (*spelling.near_words.__defaults__[:2], salt, None))
    got = variant_rows(spelling.variant_groups(spark, frame(spark, docs).withColumn("word", F.lit(1)), every=every,
                                               min_chars=chars, q_max=q_max, share=share))
    want = brute_variants(docs, every, chars)
    assert len(got) == len(want) > 50 and set(got) == want
    assert any(r[3] and r[5] != r[3] for r in want)


def test_affected_grams_bound_every_edit():
    rnd = random.Random(9)
    parts = ["an", "on", "the", "ti", "tion", "ing", "ha", "re"]
    words = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4))) for _ in range(150)]
    longer = {"tion", "tio", "ing", "the", "tha", "han", "han\x03", "an\x03", "\x02th", "hat", "onr", "ont", "onti"}
    g = spelling.Grams(longer, 4)
    for w in words:
        chosen = g.split(f"\x02{w}\x03")
        most = g.affected(f"\x02{w}\x03", chosen)
        edits = [(w[:i] + c + w[i + d:], 1 - d) for i in range(len(w) + 1) for c in "anotheirg" for d in (0, 1) if i + d <= len(w)]
        edits += [(w[:i] + w[i + 1:], -1) for i in range(len(w))]
        for other, shift in edits:
            kept = set(g.split(f"\x02{other}\x03"))
            assert sum((p, x) not in kept and (p + shift, x) not in kept for p, x in chosen) <= most


def test_no_words(spark):
    assert spelling.variant_groups(spark, frame(spark, [(1, None), (2, "a b"), (3, "")])).count() == 0
    assert spelling.variant_groups(spark, frame(spark, []), min_chars=2).count() == 0
    with pytest.raises(ValueError):
        spelling.variant_groups(spark, frame(spark, []), min_chars=1)


def test_variants_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()]
    got = variant_rows(QUERIES["op13_spelling_variants"](spark, SF_SMALL))
    assert len(got) == len(set(got)) and set(got) == brute_variants(docs)
