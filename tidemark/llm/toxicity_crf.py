"""Toxicity by a linear-chain conditional random field over words.

Words are labelled toxic or not; a chain's state is the word's label, and a word is seen through how strongly it, its
first four and its first five letters go with toxic documents (classes of log-odds). Forward-backward marginals give
each word's probability: toxic spans with their offsets, and, summed and at their largest, the document's score.

Learning: document frequencies of words and beginnings over all labelled rows (a shuffle; the beginnings that toxic rows
hold first, then, by a fixed-size bitmap, the others' counts of them) give the classes. A word of a toxic row that is of
the highest class in any way is a toxic token; all others are not. Log-odds are lower bounds by the number of toxic
rows that hold the entry, so rare entries count by their evidence at every size of the corpus. The field's weights and
the document score's are fitted on a sample of at most SAMPLE labelled rows, as classes only; the lexicon keeps every
entry of a class, as a sorted array of 62 bits of its hash and 2 of its class (8 bytes an entry).

In scoring, a run of more than 2 * REACH words of class 0 separates chains: what lies beyond has no measurable influence,
so only words near others are passed through, with the stationary messages at either side.

Defined cases: null or empty text has no words and the least score; without labelled toxic rows every score is 0; a
document labelled more than once counts as its highest label; repeated rows repeat; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

SAMPLE = 3000
SURE = 1.645  # the classes are of log-odds so many standard errors of the toxic count below the estimate
CLASSES = (1.0, 2.0, 3.5)  # log-odds where the classes 1, 2, 3 begin
REACH, STEPS, PIECE = 12, 60, 64
_WORD = re.compile(r"[^\W\d_]+")


def _views(word: str) -> tuple[str, str, str]:
    return f"w{word}", f"4{word[:4]}", f"5{word[:5]}"


def _features(batch: pa.RecordBatch) -> dict:
    seen: dict[str, int] = {}
    for t in batch.column(0).to_pylist():
        for v in {v for w in set(_WORD.findall((t or "").lower())) for v in _views(w)}:
            seen[v] = seen.get(v, 0) + 1
    return {"feature": list(seen), "n": list(seen.values())}


def _known_features(bits: np.ndarray):
    def run(batch: pa.RecordBatch) -> dict:
        cols = _features(batch)
        h = _hashes(cols["feature"]).view(np.int64)
        keep = np.flatnonzero(C.in_bitmap(bits, h)) if len(h) else []
        return {"feature": [cols["feature"][i] for i in keep], "n": [cols["n"][i] for i in keep]}

    return run


def _hashes(features: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(f.encode()) for f in features), np.uint64, len(features))


def _hashed(batch: pa.RecordBatch) -> dict:
    return {"h": _hashes(batch.column(0).to_pylist()).view(np.int64)}


def pack(features: list[str], classes: np.ndarray) -> np.ndarray:
    """Entries of the lexicon: a feature's hash, its last two bits replaced by the class 1..3."""
    return _hashes(features) & ~np.uint64(3) | np.asarray(classes).astype(np.uint64)


def _packed(batch: pa.RecordBatch) -> dict:
    return {"entry": pack(batch.column(0).to_pylist(), np.asarray(batch.column(1))).view(np.int64)}


@dataclass
class Model:
    lexicon: np.ndarray  # sorted entries (see pack) of the views of words that have a class
    emit: np.ndarray  # by code (classes of the three views): score of label 1
    move: np.ndarray  # (2, 2) transition scores
    weigh: np.ndarray  # document score: bias, log(1 + expected toxic words), largest marginal

    def classes(self, features: list[str]) -> np.ndarray:
        """0, or the class 1..3 of each view of a word."""
        if not len(self.lexicon) or not features:
            return np.zeros(len(features), np.int64)
        h = _hashes(features) & ~np.uint64(3)
        at = np.minimum(np.searchsorted(self.lexicon, h), len(self.lexicon) - 1)
        entry = self.lexicon[at]
        return np.where(entry & ~np.uint64(3) == h, entry & np.uint64(3), 0).astype(np.int64)

    def codes(self, docs: list[list[str]]) -> list[np.ndarray]:
        """Of each document's words, the classes of the three views as one number."""
        words = list({w for d in docs for w in d})
        code = 0
        for size, cut in ((16, lambda w: "w" + w), (4, lambda w: "4" + w[:4]), (1, lambda w: "5" + w[:5])):
            views = [cut(w) for w in words]
            known = list(set(views))
            found = dict(zip(known, self.classes(known).tolist(), strict=True))
            code = code + size * np.array([found[v] for v in views], np.int64)
        get = dict(zip(words, code.tolist(), strict=True)).__getitem__
        return [np.fromiter(map(get, d), np.int64, len(d)) for d in docs]

    def stationary(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Forward and backward messages, and the marginal, inside an endless run of class 0."""
        m = np.exp(self.move) * np.exp([0.0, self.emit[0]])[None, :]
        f, b = np.ones(2), np.ones(2)
        for _ in range(200):
            f, b = f @ m, m @ b
            f, b = f / f.sum(), b / b.sum()
        return f, b, float(f[1] * b[1] / (f @ b))


def passed_on(parts: list[np.ndarray], chain: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward messages that reach each part; parts of one chain follow each other, the ends of a chain lie in
    class-0 surroundings. A part passes messages on by the product of its words' matrices, taken for all parts at once."""
    f0, b0, _ = model.stationary()
    f, b = np.tile(f0, (len(parts), 1)), np.tile(b0, (len(parts), 1))
    same = np.append(chain[1:] == chain[:-1], False)  # the next part goes on with the chain
    long = np.flatnonzero(same | np.append(False, same[:-1]))
    if not len(long):
        return f, b
    grid = np.full((len(long), max(len(parts[i]) for i in long)), -1)
    for k, i in enumerate(long):
        grid[k, : len(parts[i])] = parts[i]
    move, up, across = np.exp(model.move), np.exp(model.emit), np.tile(np.eye(2), (len(long), 1, 1))
    for t in range(grid.shape[1]):
        new = across @ move
        new[:, :, 1] *= up[grid[:, t]][:, None]
        across = np.where((grid[:, t] >= 0)[:, None, None], new / new.sum((1, 2), keepdims=True), across)
    for k, i in enumerate(long):
        if same[i]:
            out = f[i] @ across[k]
            f[i + 1] = out / out.sum()
    for k, i in reversed(list(enumerate(long))):
        if i and same[i - 1]:
            out = across[k] @ b[i]
            b[i - 1] = out / out.sum()
    return f, b


def marginals(codes: np.ndarray, lengths: np.ndarray, model: Model, reach: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """P(label 1) of each word of chains laid one after another, all chains at once; chains lie in class-0 surroundings, or
    the messages of ``reach`` reach them."""
    f0, b0, _ = model.stationary()
    n, most = len(lengths), int(lengths.max())
    start = np.cumsum(lengths) - lengths
    grid = np.full((n, most), -1)
    for i in range(n):
        grid[i, : lengths[i]] = codes[start[i] : start[i] + lengths[i]]
    emit = np.where(grid >= 0, model.emit[np.maximum(grid, 0)], 0.0)
    move, inside = np.exp(model.move), grid >= 0
    f, b = reach or (np.tile(f0, (n, 1)), np.tile(b0, (n, 1)))
    fs = np.zeros((most, n, 2))
    for t in range(most):
        new = f @ move
        new[:, 1] *= np.exp(emit[:, t])
        f = np.where(inside[:, t : t + 1], new / new.sum(1, keepdims=True), f)
        fs[t] = f
    p = np.zeros((n, most))
    for t in range(most - 1, -1, -1):
        both = fs[t] * b
        p[:, t] = both[:, 1] / both.sum(1)
        back = b * np.exp(np.stack([np.zeros(n), emit[:, t]], 1))
        back = back @ move.T
        b = np.where(inside[:, t : t + 1], back / back.sum(1, keepdims=True), b)
    return p[inside]


def chains(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches around the words of a class other than 0."""
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(codes):
        a, b = max(0, int(i) - REACH), min(len(codes), int(i) + REACH + 1)
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def summaries(all_codes: list[np.ndarray], model: Model) -> tuple[np.ndarray, list[list[tuple[int, float]]]]:
    """For each document: (expected toxic words beyond chance, largest marginal), and its words' marginals of 0.5 or more."""
    flat, owner, first, chain = [], [], [], []
    for d, codes in enumerate(all_codes):
        for a, b in chains(codes):
            for at in range(a, b, PIECE):  # parts of a chain, with the messages that the others pass on
                flat.append(codes[at : min(b, at + PIECE)])
                owner.append(d)
                first.append(at)
                chain.append((d, a))
    out, spans = np.zeros((len(all_codes), 2)), [[] for _ in all_codes]
    if flat:
        number = np.cumsum([0] + [x != y for x, y in zip(chain[1:], chain, strict=False)])
        p = marginals(np.concatenate(flat), np.array([len(x) for x in flat]), model, passed_on(flat, number, model))
        base = model.stationary()[2]
        at = 0
        for x, d, s in zip(flat, owner, first, strict=True):
            part = p[at : at + len(x)]
            out[d, 0] += np.maximum(0, part - base).sum()
            out[d, 1] = max(out[d, 1], part.max())
            spans[d] += [(s + int(i), float(part[i])) for i in np.flatnonzero(part >= 0.5)]
            at += len(x)
    return out, spans


def document_scores(summary: np.ndarray, weigh: np.ndarray) -> np.ndarray:
    x = weigh[0] + weigh[1] * np.log1p(summary[:, 0]) + weigh[2] * summary[:, 1]
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_field(codes: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood (with a small quadratic prior) of the field on labelled tokens, by scaled gradient ascent.

    All words count, in pieces of at most PIECE; pieces of class 0 alone are equal, so one of each length stands for all.
    """
    strong = np.array([3 in (c // 16, c // 4 % 4, c % 4) for c in range(64)])
    seqs, labels, plain = [], [], np.zeros(PIECE + 1)
    for c, y in zip(codes, toxic, strict=True):
        end = 0
        for a, b in [*chains(c), (len(c), len(c))]:
            plain[PIECE] += (a - end) // PIECE  # words of class 0 between chains: pieces that are all alike are counted
            plain[(a - end) % PIECE] += 1
            end = b
            for s in range(a, b, PIECE):
                seqs.append(c[s : min(b, s + PIECE)])
                labels.append((strong[seqs[-1]] & bool(y)).astype(int))
    alike = [k for k in range(1, PIECE + 1) if plain[k]]
    weight = np.concatenate([np.ones(len(seqs)), plain[alike]])
    seqs, labels = seqs + [np.zeros(k, np.int64) for k in alike], labels + [np.zeros(k, int) for k in alike]
    emit, move = np.full(64, -2.0), np.zeros((2, 2))
    if not seqs:
        return emit, move
    n, most = len(seqs), max(map(len, seqs))
    grid, lab = np.full((n, most), -1), np.zeros((n, most), int)
    for i, (s, y) in enumerate(zip(seqs, labels, strict=True)):
        grid[i, : len(s)], lab[i, : len(s)] = s, y
    inside = grid >= 0
    times = weight[:, None] * inside
    toxic_word = inside & (lab == 1)
    want_emit = np.bincount(grid[toxic_word], weights=times[toxic_word], minlength=64)
    pair = inside[:, 1:]
    want_move = np.bincount((lab[:, :-1] * 2 + lab[:, 1:])[pair], weights=times[:, 1:][pair], minlength=4).reshape(2, 2)
    seen = np.bincount(grid[inside], weights=times[inside], minlength=64)
    for _ in range(STEPS):
        e, m = np.exp(np.where(inside, emit[np.maximum(grid, 0)], 0.0)), np.exp(move)
        f = np.ones((n, 2)) * 0.5
        fs = []
        for t in range(most):
            new = f @ m if t else np.ones((n, 2))
            new = new * np.stack([np.ones(n), e[:, t]], 1)
            f = np.where(inside[:, t : t + 1], new / new.sum(1, keepdims=True), f)
            fs.append(f)
        b, got_emit, got_move = np.ones((n, 2)), np.zeros(64), np.zeros((2, 2))
        for t in range(most - 1, -1, -1):
            both = fs[t] * b
            p = both[:, 1] / both.sum(1)
            ok = inside[:, t]
            got_emit += np.bincount(grid[ok, t], weights=(p * weight)[ok], minlength=64)
            right = b * np.stack([np.ones(n), e[:, t]], 1)
            if t:
                joint = fs[t - 1][:, :, None] * m[None] * right[:, None, :]
                joint /= joint.sum((1, 2), keepdims=True)
                got_move += (joint * weight[:, None, None])[ok].sum(0)
            back = right @ m.T
            b = np.where(ok[:, None], back / back.sum(1, keepdims=True), b)
        emit = np.clip(emit + 4 * (want_emit - got_emit - 0.01 * emit) / (seen + 10), -12, 12)
        move = np.clip(move + (want_move - got_move - 0.01 * move) / (want_move + got_move + 10), -6, 6)
    return emit, move


def fit_scores(summary: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small quadratic prior."""
    x = np.stack([np.ones(len(summary)), np.log1p(summary[:, 0]), summary[:, 1]], 1)
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3), x.T @ (toxic - p) - 0.05 * w)
    return w


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic, order: the rows of docs that labels has, without shuffling the texts of the others."""
    marks = C.cut(labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    bits = C.bitmap(marks.select(F.xxhash64("doc_id").alias("h")), "h")

    def keep(batches):
        for b in batches:
            ok = C.in_bitmap(bits, np.asarray(b.column(2), dtype=np.int64))
            if ok.any():
                yield b.filter(pa.array(ok)).select([0, 1])

    near = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text", F.xxhash64(F.col("doc_id").cast("long")).alias("h")).mapInArrow(keep, "doc_id long, text string")
    return C.cut(near.join(marks, "doc_id").select("text", "toxic", F.md5(F.col("doc_id").cast("string")).alias("order")))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """docs: doc_id, text of the rows to learn from; labels: doc_id, toxic."""
    C.prepare(docs.sparkSession)
    rows = labelled(docs, labels)
    n = dict(rows.groupBy("toxic").count().collect())
    n1, n0 = sum(v for k, v in n.items() if k >= 1), sum(v for k, v in n.items() if k < 1)
    if not n1:
        return Model(np.zeros(0, np.uint64), np.full(64, -8.0), np.zeros((2, 2)), np.array([-40.0, 0, 0]))
    bad = C.map_arrow(rows.where("toxic >= 1").select("text"), _features, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n1"))
    bad = C.cut(bad)
    bits = C.bitmap(C.map_arrow(bad.select("feature"), _hashed, "h long"), "h")
    good = C.map_arrow(rows.where("toxic < 1").select("text"), _known_features(bits), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n0"))
    odds = F.log(((F.col("n1") + 0.5) / (n1 + 1)) / ((F.coalesce("n0", F.lit(0)) + 0.5) / (n0 + 1)))
    odds = odds - SURE / F.sqrt(F.col("n1") + 0.5)
    grade = sum((F.col("odds") >= c).cast("int") for c in CLASSES)
    top = bad.join(good, "feature", "left").select("feature", odds.alias("odds")).where(F.col("odds") >= CLASSES[0]).select("feature", grade.alias("class"))
    lexicon = np.sort(C.map_arrow(top, _packed, "entry long").toArrow()["entry"].to_numpy().view(np.uint64))
    model = Model(lexicon, np.full(64, -2.0), np.zeros((2, 2)), np.zeros(3))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def coded(batch: pa.RecordBatch) -> dict:
        found = shared.value.codes([_WORD.findall((t or "").lower()) for t in batch.column(0).to_pylist()])
        return {"codes": [c.astype(np.int8).tobytes() for c in found], "toxic": batch.column(1)}

    # md5 orders the rows, so about twice SAMPLE of them lie below this prefix: only their texts go to the task that takes the first
    prefix = f"{min(2**32 - 1, 2 * SAMPLE * 2**32 // (n0 + n1)):08x}"
    first = rows.where(F.substring("order", 1, 8) <= prefix).orderBy("order").limit(SAMPLE)
    sample = C.map_arrow(first.select("text", "toxic"), coded, "codes binary, toxic int").collect()
    codes = [np.frombuffer(bytes(r[0]), np.int8).astype(np.int64) for r in sample]
    toxic = np.array([r[1] >= 1 for r in sample], float)
    model.emit, model.move = fit_field(codes, toxic)
    model.weigh = fit_scores(summaries(codes, model)[0], toxic)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with score and toxic_spans (start, end, p of words whose marginal is 0.5 or more) added."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("score", "toxic_spans")]
    frame = docs.select(*(docs[c] for c in kept))
    col = kept.index(text_col)
    fields = ", ".join(f"`{c}` {t}" for c, t in frame.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        m = shared.value
        scores, spans = [], []
        for _, part in C.text_slices(batch.column(col)):
            texts = [t.lower() for t in part.to_pylist()]
            found, words = summaries(m.codes([_WORD.findall(t) for t in texts]), m)
            scores.append(document_scores(found, m.weigh))
            for t, raw, w in zip(texts, part.to_pylist(), words, strict=True):
                at = [x.span() for x in _WORD.finditer(raw if len(raw) == len(t) else t)] if w else []
                spans.append([{"start": at[i][0], "end": at[i][1], "p": p} for i, p in w if i < len(at)])
        out = dict(zip(kept, batch.columns, strict=True))
        return out | {"score": np.concatenate([*scores, []]), "toxic_spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))}

    return C.map_arrow(frame, run, f"{fields}, score double, toxic_spans array<struct<start:bigint,end:bigint,p:double>>")
