"""Collocations, repeated passages and vector codes against brute force, and over awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_frames import SCHEMA, TEXTS
from tidemark.llm import anchor_dedup, common, fm_phrases, lloyd_codes


@pytest.fixture(scope="module")
def docs(spark):
    common.prepare(spark)
    clash = {c: F.lit(1) for c in ("chunk", "bucket", "words", "n", "phrase", "f", "id", "label", "q", "code", "codes", "kind", "outer")}
    return spark.createDataFrame(TEXTS, SCHEMA).withColumns(clash).coalesce(1)


def phrases_of(rows, max_words, least, share, top):
    """(lang, rank, phrase, a, l, r, n, score) from plain counting."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, max_words + 1) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        inside = [b for (other, q), b in found.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if not any(100 * b >= share * a for b in inside):
            score, _, left, right = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(mine[:top])]
    return sorted(ranked)


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_collocations_are_those_of_plain_counting(spark, monkeypatch, max_words):
    monkeypatch.setattr(fm_phrases, "SHARD_BYTES", 2_000)  # many shards and buckets
    monkeypatch.setattr(fm_phrases, "BUCKET_WORDS", 500)
    r = random.Random(4)
    word = lambda: r.choice(["ab", "Ab", "b", "ça", "d", "e" * 30, "f g", "h"])
    text = lambda: "".join(word() + r.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(r.randint(0, 60)))
    rows = [(r.choice(["x", "y", None, "und"]), text()) for _ in range(300)] + [("x", None), ("z", "few words"), ("y", "")] + [("x", "ab ab ab ab b b")] * 40
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = [tuple(x) for x in fm_phrases.collocations(frame, max_words, least=4, share=50, top=60).collect()]
    assert sorted(got) == phrases_of(rows, max_words, 4, 50, 60) and got


def test_collocations_of_awkward_rows(docs):
    got = sorted(tuple(x) for x in fm_phrases.collocations(docs.withColumn("lang", F.col("lang")), least=3).collect())
    assert got == phrases_of([(lang, text) for _, text, lang, _ in TEXTS], 3, 3, 50, 2000) and got
    assert fm_phrases.collocations(docs.where("false")).count() == 0


def test_index_counts_both_extensions():
    """Every phrase's intervals in both transforms hold its occurrences; extensions to either side agree with them."""
    r = np.random.default_rng(3)
    words = np.append(r.integers(0, 5, 3_000), 0).astype(np.int32)
    words = words[np.flatnonzero(words)[0] :]
    index = fm_phrases.Index.build(words, 4)
    at = lambda p: sum(tuple(words[i : i + len(p)]) == p for i in range(len(words)))
    level = index.first()
    for left in (False, True, False):
        level = index.extend(level, left)
        assert all(at(tuple(p)) == n for p, n in list(zip(level.words.tolist(), level.count.tolist(), strict=True))[::7])
        for own, symbols, side in ((level.forward, index.forward, 0), (level.reverse, index.reverse, 1)):
            for i in range(0, len(own), 11):
                p = tuple(level.words[i].tolist())
                around = Counter(words[k - 1 if side == 0 else (k + len(p)) % len(words)] for k in range(len(words)) if tuple(words[k : k + len(p)].tolist()) == p)
                assert Counter(symbols[own[i] : own[i] + level.count[i]].tolist()) == Counter({int(a): b for a, b in around.items()})


def left_of(texts, least):
    """(n_words, n_removed, kept text) of each, by looking at all windows."""
    words = [[w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w] for t in texts]
    seen = Counter(tuple(w[i : i + least]) for w in words for i in range(len(w) - least + 1))
    out = []
    for w in words:
        gone = {i + j for i in range(len(w) - least + 1) if seen[tuple(w[i : i + least])] > 1 for j in range(least)}
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("least", [3, 8, 35])
def test_repeats_are_those_of_all_windows(spark, monkeypatch, least):
    monkeypatch.setattr(anchor_dedup, "CHUNK_BYTES", 3_000)
    monkeypatch.setattr(anchor_dedup, "BUCKET", 300)
    r = random.Random(least)
    fresh = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    passages = [fresh(n) for n in (least - 1, least, least + 1, 3 * least, 90)]
    texts = [" ".join(sum((r.choice([fresh(r.randint(0, 30)), r.choice(passages)]) for _ in range(r.randint(0, 5))), [])) for _ in range(120)]
    texts += [texts[5]] * 40 + [texts[6] + " end", None, "", " \n ", "a " * 100, "b " * (least + 1), "c " * least, ("p q " * 60)] + [" ".join(passages[3][k:]) for k in range(6)]
    r.shuffle(texts)
    frame = spark.createDataFrame([(i % 50 or None, i, t) for i, t in enumerate(texts)], "doc_id long, n long, text string").repartition(5)
    frame = frame.withColumn("key", F.struct("doc_id", "n"))
    got = {x.key.n: (x.n_words, x.n_removed, x.text) for x in anchor_dedup.remove_repeats(frame, least, id_col="key").collect()}
    assert got == dict(enumerate(left_of(texts, least))) and sum(x[1] for x in got.values())
    spans = anchor_dedup.remove_repeats(frame, least, id_col="key").select("n_removed", "removed").collect()
    assert all(sum(s.end - s.start for s in x.removed) == x.n_removed for x in spans)


def test_repeats_of_awkward_rows(docs):
    got = sorted((x.doc_id or -1, x.n_words, x.n_removed, x.text) for x in anchor_dedup.remove_repeats(docs).collect())
    assert got == sorted((d or -1, *x) for (d, *_), x in zip(TEXTS, left_of([t for _, t, _, _ in TEXTS], 35), strict=True))
    assert anchor_dedup.remove_repeats(docs.where("false")).count() == 0


def codes_of(rows):
    """Codes, errors and codebooks by full scans; rows: (id, integers), equal lengths."""
    q = {i: np.array(v, object).reshape(16, -1) for i, v in rows}
    books = [[q[i][p] for i in sorted(q)[:64]] for p in range(16)]
    nearest = lambda x, book: min((int(((x - e) ** 2).sum()), k) for k, e in enumerate(book))
    for _ in range(2):
        for p in range(16):
            to = {i: nearest(q[i][p], books[p])[1] for i in q}
            books[p] = [sum(q[i][p] for i in mine) // len(mine) if (mine := [i for i in q if to[i] == k]) else e for k, e in enumerate(books[p])]
    found = {i: [nearest(q[i][p], books[p]) for p in range(16)] for i in q}
    text = ",".join(str(c) for book in books for e in book for c in e)
    return {i: ("".join(f"{k:02x}" for _, k in x), sum(d for d, _ in x)) for i, x in found.items()}, hashlib.sha256(text.encode()).hexdigest()


def test_codes_are_those_of_full_scans(spark):
    r = random.Random(8)
    rows = [(i, [r.choice([-0.5, 0.25, 0.2501, 1.0, -3.0]) * r.choice([1, 1, 1, 0]) for _ in range(32)], r.choice([1, 2, None])) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    codes = lloyd_codes.encode(frame)
    got = {x.id: (x.code.hex(), x.error) for x in codes.rows.collect()}
    want, digest = codes_of([(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows])
    assert got == want and codes.sha256() == digest
    sums = {x.id: x.label_error for x in lloyd_codes.label_errors(codes).collect()}
    assert sums == {i: sum(want[k][1] for k, _, other in rows if other == label) for i, _, label in rows}


def test_active_entries_give_the_full_scan():
    r = np.random.default_rng(5)
    for _ in range(30):
        x, books = r.integers(-2, 3, (80, 4, 2)), r.integers(-2, 3, (4, 9, 2))  # many ties
        new = np.where(r.random((4, 9, 1)) < 0.3, r.integers(-2, 3, books.shape), books)
        first = lloyd_codes.assign(x, books)
        code, dist = lloyd_codes.assign(x, new, *first, (new != books).any(2))
        full = lloyd_codes.assign(x, new)
        assert (code == full[0]).all() and (dist == full[1]).all()


def test_codes_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5] * 16, 1), (1, [0.25] * 16, 1), (None, [1.0] * 16, None), (2, None, 1), (3, [nan] * 16, 1), (4, [inf] + [0.0] * 15, 2), (5, [None] * 16, 2), (6, [], 2), (7, [1.0, 2.0], None), (8, [1e300] * 17, 3), (9, [0.0] * 16, 3), (9, [0.0] * 16, 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(1) for c in ("id", "q", "code", "dist")})
    codes = lloyd_codes.encode(frame)
    got = sorted((x.id or -1, x.error) for x in codes.rows.collect())
    assert got == [(-1, 0), (1, 0), (1, 0), (6, 0), (7, 0), (8, 0), (9, 0), (9, 0)] and codes.books.shape == (16, 8, 2)
    assert lloyd_codes.label_errors(codes).count() == 8
    none = lloyd_codes.encode(frame.where("false"))
    assert none.rows.count() == 0 and none.sha256() == hashlib.sha256(b"").hexdigest()
    assert lloyd_codes.quantise(pa.array([], pa.list_(pa.float32())))[0].shape == (0,)
