"""Language identification with bit-sliced Bloom filters of n-grams.

Every position of one table holds a mask with a bit for each language; the AND of an n-gram's positions tells
all languages that contain it at once. A document's languages are compared by how many of its n-grams each contains,
less what its filter's fill leads to expect from chance.

Learning counts the n-grams of all learning rows on the executors; an n-gram enters a language's filter when its share
there is at least RELATIVE of its largest share in any language and it was seen MIN_COUNT times. For the largest share
only languages count that saw it as often, over SMOOTH n-grams more than they have, so a few short texts under a rare or
wrong label do not push n-grams out of the large languages. The table has SPARSE
positions, or up to twice as many, for each n-gram of the language that has most (2**BITS at least), so a filter's fill
stays below 1 - exp(-HASHES / SPARSE) = 0.18. A position has 1, 2, 4 or 8 bytes for up to 8, 16, 32, 64 languages, and 8
more for each further 64. A table of up to DRIVER_BYTES is sent to every task; a larger one stays a table of its occupied
positions, partitioned by position, and the distinct n-grams of the texts are looked up by a join. Filters, correction and
results are the same either way.

Defined cases: text null or without a letter: ``und``, score 0; nothing to learn from: ``und`` throughout; equal counts:
the language first in code point order; rows repeat as they come; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

SIZES = (3, 4)
BITS, HASHES, SPARSE = 20, 3, 16
DRIVER_BYTES, SALTS = 1 << 26, 16
MIN_COUNT, RELATIVE, SMOOTH = 3, 0.1, 10_000
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams whose second character is a letter (anything else counts as one word end), and their texts' numbers."""
    low = [t.lower() for t in texts]
    code = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    letter = _is_letter()[code]
    code = np.where(letter, code, 0).astype(np.uint64)
    code, letter = np.concatenate([[np.uint64(0)], code, np.zeros(max(SIZES), np.uint64)]), np.concatenate([[False], letter, np.zeros(max(SIZES), bool)])
    hashes, owners = [], []
    for n in SIZES:
        total = len(owner)
        real = letter[1 : total + 1].copy()
        for i in range(2, n - 1):
            real &= letter[i : total + i]  # word ends only at either side
        h = np.full(total, np.uint64(n))
        for i in range(n):
            h = (h ^ code[i : total + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        hashes.append(C.mix(h[real]))
        owners.append(owner[real])
    return np.concatenate(hashes), np.concatenate(owners)


def _slots(h: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """Positions by double hashing: the two halves of the hash, added up."""
    a, b = h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)
    return [((a + np.uint64(i) * b) & np.uint64((1 << bits) - 1)).astype(np.int64) for i in range(HASHES)]


def _shape(languages: int, most: int) -> tuple[int, int, np.dtype]:
    """Bits of a position's number, words a position and their type, for so many languages of at most so many n-grams."""
    bits = max(BITS, (SPARSE * most - 1).bit_length())
    kind = np.dtype(next((f"u{k}" for k in (1, 2, 4) if languages <= 8 * k), "u8"))
    return bits, max(1, -(-languages // 64)), kind


@dataclass
class Model:
    """table: (positions, words) unsigned; languages in code point order, bit i of word i // 64. Where it is too large for
    a task, slots: slot, word, mask of the occupied positions, and filled: each language's share of the 2**bits positions."""

    languages: list[str]
    table: np.ndarray | None
    slots: DataFrame | None = None
    bits: int = BITS
    filled: np.ndarray | None = None

    def fill(self) -> np.ndarray:
        if self.filled is not None:
            return self.filled
        return np.array([np.count_nonzero(self.table[:, i // 64] & self.table.dtype.type(1 << i % 64)) for i in range(len(self.languages))]) / len(self.table)

    @cached_property
    def false_positive(self) -> np.ndarray:
        return self.fill() ** HASHES


def _count(batch: pa.RecordBatch):
    langs = batch.column(1).to_pylist()
    for start, part in C.text_slices(batch.column(0)):
        h, owner = ngrams(part.to_pylist())
        names = sorted(set(langs[start : start + len(part)]))
        code = np.array([names.index(x) for x in langs[start : start + len(part)]], np.int64)
        for i, name in enumerate(names):
            grams, n = np.unique(h[code[owner] == i], return_counts=True)
            yield {"lang": [name] * len(grams), "gram": grams.view(np.int64), "n": n}


def train(rows: DataFrame) -> Model:
    """rows: text, lang; those with a null in either are left out."""
    rows = rows.select("text", "lang").where("text is not null and lang is not null")
    counts = C.cut(C.map_arrow(rows, _count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = sorted(r[0] for r in totals.select("lang").collect())  # as many as there are languages
    if not languages:
        return Model([], np.zeros((1 << BITS, 1), np.uint8))
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    top = shares.where(F.col("n") >= MIN_COUNT).groupBy("gram").agg(F.max(F.col("n") / (F.col("total") + SMOOTH)).alias("top"))
    member = C.cut(shares.join(top, "gram").where((F.col("n") >= MIN_COUNT) & (F.col("share") >= RELATIVE * F.col("top"))).select("lang", "gram"))
    most = member.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    bits, words, kind = _shape(len(languages), most)
    number = F.array_position(F.array(*map(F.lit, languages)), F.col("lang")) - 1
    member = member.withColumn("b", number).select("gram", F.expr("cast(b div 64 as int)").alias("word"), F.expr("shiftleft(1L, cast(b % 64 as int))").alias("mask"))
    slots = member.select(F.explode(_slot_columns(bits)).alias("slot"), "word", "mask").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    if (words << bits) * kind.itemsize > DRIVER_BYTES:
        slots = C.cut(slots)
        full = {(r["word"], r["bit"]): r["count"] for r in slots.select("word", _set_bits("mask").alias("bit")).groupBy("word", "bit").count().collect()}  # one row a language
        return Model(languages, None, slots, bits, np.array([full.get((i // 64, i % 64), 0) for i in range(len(languages))]) / (1 << bits))
    table = np.zeros((1 << bits, words), kind)
    masks = slots.toArrow()
    table[masks["slot"].to_numpy(), masks["word"].to_numpy()] = masks["mask"].to_numpy().view(np.uint64).astype(kind)
    return Model(languages, table)


def _slot_columns(bits: int):
    """The positions of the column gram, as in _slots."""
    return F.array(*(F.expr(f"((gram & 4294967295L) + {i} * (shiftrightunsigned(gram, 32) | 1L)) & {(1 << bits) - 1}L") for i in range(HASHES)))


def _set_bits(mask: str):
    return F.explode(F.expr(f"filter(sequence(0, 63), i -> (shiftrightunsigned({mask}, i) & 1L) = 1L)"))


def classify(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score (the corrected share of n-grams the language contains) of each text."""
    names, score = ["und"] * len(texts), np.zeros(len(texts))
    h, owner = ngrams([t or "" for t in texts])
    if not len(h) or not model.languages:
        return names, score
    first, *others = _slots(h, len(model.table).bit_length() - 1)
    masks = model.table[first]
    for s in others:
        masks = masks & model.table[s]
    total = np.bincount(owner, minlength=len(texts)).astype(float)
    chance = model.false_positive
    hits = np.zeros((len(texts), len(model.languages)))
    for i in range(len(model.languages)):
        has = (masks[:, i // 64] & masks.dtype.type(1 << i % 64)) != 0
        found = np.bincount(owner[has], minlength=len(texts))
        hits[:, i] = np.maximum(0, (found - total * chance[i]) / max(1e-9, 1 - chance[i]))
    best = hits.argmax(1)
    for t in np.flatnonzero(total > 0):
        names[t] = model.languages[best[t]]
        score[t] = min(1.0, hits[t, best[t]] / total[t])
    return names, score


def _grams(batch: pa.RecordBatch):
    keys = batch.column(0).to_pylist()
    for start, part in C.text_slices(batch.column(1)):
        h, owner = ngrams(part.to_pylist())
        at = np.lexsort((h, owner))
        h, owner = h[at], owner[at]
        first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))[: len(h)])
        yield {"key": [keys[start + i] for i in owner[first]], "gram": h[first].view(np.int64), "n": np.diff(np.append(first, len(h)))}


def _identify_joined(frame: DataFrame, model: Model, text_col: str) -> DataFrame:
    """classify where the table is too large for a task: positions of the distinct n-grams are looked up by a join.

    An n-gram that very many texts hold is one row in that join; in the join back to the texts it is dealt to SALTS tasks.
    """
    key = F.sha2(F.col(f"`{text_col}`"), 256)
    texts = frame.where(F.col(f"`{text_col}`").isNotNull()).select(key.alias("key"), F.col(f"`{text_col}`").alias("text")).dropDuplicates(["key"])
    grams = C.cut(C.map_arrow(texts, _grams, "key string, gram long, n long"))
    total = grams.groupBy("key").agg(F.sum("n").alias("total"))
    probes = grams.select("gram").distinct().select("gram", F.explode(_slot_columns(model.bits)).alias("slot"))
    masks = probes.join(model.slots, "slot").groupBy("gram", "word").agg(F.bit_and("mask").alias("mask"), F.count("*").alias("at")).where((F.col("at") == HASHES) & (F.col("mask") != 0))
    masks = C.cut(masks.select("gram", "word", "mask")).withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    dealt = grams.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
    hits = dealt.join(masks, ["gram", "salt"]).groupBy("key", "word", "mask").agg(F.sum("n").alias("n"))
    hits = hits.select("key", "word", "n", _set_bits("mask").alias("bit"))
    hits = hits.groupBy("key", (F.col("word") * 64 + F.col("bit")).alias("lang")).agg(F.sum("n").alias("found"))
    chance = F.element_at(F.array(*(F.lit(float(x)) for x in model.false_positive)), (F.col("lang") + 1).cast("int"))
    above = F.greatest(F.lit(0.0), (F.col("found") - F.col("total") * chance) / F.greatest(F.lit(1e-9), 1 - chance))
    best = hits.join(total, "key").groupBy("key").agg(F.min(F.struct((-above).alias("less"), "lang")).alias("best"))
    name = F.when(-F.col("best.less") > 0, F.element_at(F.array(*map(F.lit, model.languages)), (F.col("best.lang") + 1).cast("int"))).otherwise(model.languages[0])
    found = total.join(best, "key", "left").select(F.col("key").alias("_key"), name.alias("_lang"), F.least(F.lit(1.0), F.coalesce(-F.col("best.less") / F.col("total"), F.lit(0.0))).alias("_score"))
    out = frame.withColumn("_key_", key).join(found, F.col("_key_") == F.col("_key"), "left")
    return out.select(*(frame[c] for c in frame.columns), F.coalesce("_lang", F.lit("und")).alias("lang_pred"), F.coalesce("_score", F.lit(0.0)).alias("score"))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score added (columns of those names are replaced)."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    frame = docs.select(*(docs[c] for c in kept))
    if model.table is None:
        return _identify_joined(frame, model, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{c}` {t}" for c, t in frame.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        names, scores = [], []
        for _, part in C.text_slices(batch.column(kept.index(text_col))):
            n, s = classify(part.to_pylist(), shared.value)
            names += n
            scores.append(s)
        return dict(zip(kept, batch.columns, strict=True)) | {"lang_pred": names, "score": np.concatenate([*scores, []])}

    return C.map_arrow(frame, run, f"{fields}, lang_pred string, score double")
