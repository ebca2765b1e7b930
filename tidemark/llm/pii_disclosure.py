"""Personal data: base patterns, and information-theoretic sanitisation of the terms that give protected entities away.

The base patterns find e-mail addresses, IP addresses, cards and phone numbers: the protected entities. A term (a word of
letters) discloses an entity as far as seeing the term tells that the entity is near: P(entity | term), the term's
occurrences within WINDOW words of the entity over all its occurrences in the corpus. Terms that occur so in at least
SUPPORT different contexts (copies of a passage are one context), with P >= GENERALISE and at least BITS bits more than
the entity's own frequency tells, are generalised; from P >= REMOVE on they are removed.

Work over the corpus: one pass finds entities and the terms around them; pairs are counted by a shuffle; the occurrences
of the terms still in question are counted by a pass that a fixed-size bitmap keeps short; a last pass places the spans
of disclosing terms, keyed by a hash of the text. Every join is left to Spark's size check.

Defined cases: null text is empty; repeated rows repeat; an empty corpus gives no terms; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

KINDS = ("email", "ip", "card", "phone", "general", "removed")
WINDOW, SUPPORT, GENERALISE, REMOVE, BITS = 5, 3, 0.5, 0.9, 3.0
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){12,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]+")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost non-overlapping matches of each kind that pass its condition."""
    out = []
    at, free = t.find("@"), 0
    while at >= 0:
        m = _DOMAIN.match(t, at)
        s = at
        while m and s > free and t[s - 1] in _LOCAL:
            s -= 1
        if s < at:
            out.append((0, s, m.end()))
            free = m.end()
        at = t.find("@", max(at + 1, free))
    for m in _IP.finditer(t):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(t):
        digits = _NOT_DIGIT.sub("", m[0])
        if len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in t:
        for m in _PHONE.finditer(t):
            if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append((3, *m.span()))
    return out


def _hash(x: str) -> int:
    return xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) - (1 << 63)


def terms(t: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """Words of letters, lower-cased, outside the spans."""
    cover = sorted((s, e) for _, s, e in spans)
    out, k = [], 0
    for m in _TERM.finditer(t):
        while k < len(cover) and cover[k][1] <= m.start():
            k += 1
        if k == len(cover) or m.end() <= cover[k][0]:
            out.append((m[0].lower(), m.start(), m.end()))
    return out


def neighbours(t: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(term, entity, context) hashes of the words within WINDOW words of each entity."""
    words = terms(t, spans) if spans else []
    starts = [w[1] for w in words]
    out = []
    for kind, s, e in spans:
        i = int(np.searchsorted(starts, s))
        near = words[max(0, i - WINDOW) : i + WINDOW]
        entity = _hash(f"{kind}:{t[s:e]}")
        context = _hash(" ".join(w[0] for w in near))
        out += [(_hash(w[0]), entity, context) for w in near]
    return out


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def _scan(batch: pa.RecordBatch) -> dict:
    texts = [x or "" for x in batch.column(1).to_pylist()]
    spans = [base_spans(t) for t in texts]
    near = [neighbours(t, s) for t, s in zip(texts, spans, strict=True)]
    out = {"doc_id": batch.column(0), "text_key": batch.column(2)}
    for k, name in enumerate(("n_email", "n_ip", "n_card", "n_phone")):
        out[name] = [sum(x[0] == k for x in s) for s in spans]
    out["base"] = [_listed(s) for s in spans]
    out["base_sha256"] = [hashlib.sha256(x.encode()).hexdigest() for x in out["base"]]
    for k, name in enumerate(("term", "entity", "context")):
        out[name] = [[x[k] for x in n] for n in near]
    return out


class _Wanted:
    """Hashes of the words that a bitmap lets pass; other words are remembered, up to a number, to be asked once."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.yes, self.no = bits, {}, set()

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.no and w not in self.yes]
        if len(self.no) + len(new) > 500_000:
            self.no.clear()
        if new:
            h = np.array([_hash(w.lower()) for w in new], np.int64)
            ok = C.in_bitmap(self.bits, h)
            self.yes.update((new[i], int(h[i])) for i in np.flatnonzero(ok))
            self.no.update(w for w, k in zip(new, ok.tolist(), strict=True) if not k)


def _occurrences(bits: np.ndarray):
    """(term, occurrences) of the terms that the bitmap lets pass, a row a term and batch at most."""

    def run(batches):
        wanted = _Wanted(bits)
        for batch in batches if bits.any() else ():
            seen: Counter = Counter()
            for t in batch.column(0).to_pylist():
                seen.update(_TERM.findall(t or ""))
            wanted.learn(seen.keys())
            total: dict[int, int] = {}
            for w in seen.keys() & wanted.yes.keys():
                total[wanted.yes[w]] = total.get(wanted.yes[w], 0) + seen[w]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])

    return run


def _place(bits: np.ndarray):
    def run(batches):
        wanted = _Wanted(bits)
        schema = pa.schema([("text_key", pa.int64()), ("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in batches if bits.any() else ():
            rows: list = []
            texts = batch.column(0).to_pylist()
            words = [set(_TERM.findall(t or "")) for t in texts]
            wanted.learn(set().union(*words))
            for key, t, own in zip(batch.column(1).to_pylist(), texts, words, strict=True):
                if wanted.yes.keys().isdisjoint(own):
                    continue
                cover = [(s, e) for _, s, e in base_spans(t)]
                hits = [(key, wanted.yes[m[0]], *m.span()) for m in _TERM.finditer(t) if m[0] in wanted.yes]
                rows += [x for x in hits if not any(x[2] < e and s < x[3] for s, e in cover)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], schema=schema)

    return run


def disclosures(scanned: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, disclosure): hashes of the terms to generalise or remove, with the largest P(entity | term)."""
    near = scanned.where(F.size("term") > 0).select(F.explode(F.arrays_zip("term", "entity", "context")).alias("x")).select("x.*")
    rare = near.groupBy("entity").agg(F.count("*").alias("mass"))
    near = near.groupBy("term", "entity", "context").agg(F.count("*").alias("n"))
    pairs = C.cut(near.groupBy("term", "entity").agg(F.sum("n").alias("n"), F.count("*").alias("contexts")).where(F.col("contexts") >= SUPPORT))
    bits = C.bitmap(pairs, "term")
    seen = docs.select("text").mapInArrow(_occurrences(bits), "term long, n long").groupBy("term").agg(F.sum("n").alias("total"))
    whole = scanned.agg(F.sum(F.size("term"))).first()[0] or 1
    rare = rare.select("entity", (F.col("mass") / whole).alias("prior"))
    told = pairs.join(seen, "term").join(rare, "entity").withColumn("p", F.least(F.lit(1.0), F.col("n") / F.col("total")))
    return told.where((F.col("p") >= GENERALISE) & (F.log2(F.col("p") / F.col("prior")) >= BITS)).groupBy("term").agg(F.max("p").alias("disclosure"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row of docs."""
    spark = docs.sparkSession
    C.prepare(spark)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    scanned = C.cut(C.map_arrow(rows.withColumn("text_key", key), _scan, "doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, term array<long>, entity array<long>, context array<long>"))
    told = C.cut(disclosures(scanned, rows))
    placed = rows.select("text", key.alias("text_key")).mapInArrow(_place(C.bitmap(told, "term")), "text_key long, term long, start long, end long").distinct()
    kind = F.when(F.col("disclosure") >= REMOVE, F.lit(KINDS[5])).otherwise(F.lit(KINDS[4]))
    named = placed.join(told, "term").select("text_key", F.struct(kind.alias("k"), F.col("start").alias("s"), F.col("end").alias("e")).alias("x"))
    added = named.groupBy("text_key").agg(F.array_sort(F.collect_list("x")).alias("x"))
    added = added.select(F.col("text_key").alias("at"), F.array_join(F.transform("x", lambda v: F.concat_ws(":", v["k"], v["s"].cast("string"), v["e"].cast("string"))), ",").alias("more"))
    out = scanned.join(added, scanned["text_key"] == added["at"], "left")
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), F.col("more"))
    return out.select("doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", spans.alias("spans"))


def _rewrite(batch: pa.RecordBatch) -> dict:
    out = []
    for t, listed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
        parts, at = [], 0
        for s, e, k in sorted((int(s), int(e), k) for k, s, e in (x.split(":") for x in (listed or "").split(",") if x)):
            if s >= at:
                parts += [t[at:s], "" if k == KINDS[5] else "[TERM]" if k == KINDS[4] else f"[{k.upper()}]"]
            at = max(at, e)
        out.append(t if t is None else "".join([*parts, t[at:]]))
    return {"doc_id": batch.column(0), "text": pa.array(out, pa.string())}


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text without its entities and disclosing terms: entities and general terms become marks, others go."""
    found = find(docs, id_col, text_col).select(F.col("text_key").alias("at"), "spans").distinct()
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), F.xxhash64(F.coalesce(docs[text_col], F.lit(""))).alias("text_key"))
    return C.map_arrow(rows.join(found, F.col("text_key") == F.col("at"), "left").select("doc_id", "text", "spans"), _rewrite, "doc_id long, text string")
