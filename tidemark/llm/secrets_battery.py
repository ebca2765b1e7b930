"""Secret scan: base patterns, and a randomness test battery over long tokens.

A token of 16 or more of ``[A-Za-z0-9+/_=-]`` gets an encoding by its characters (hex, base 32, else base 64), and three
tests of the hypothesis that its symbols are random: chi-squared uniformity over the alphabet, runs about the alphabet's
middle, and lag-1 serial correlation. Their smallest p-value, times three, is the token's randomness.

How rarely ordinary words reach such a randomness is counted over the distinct tokens of the whole corpus, so copies
count once: words of letters alone, in classes of length. That share, drawn towards the share among the words of this
and all shorter classes with the weight of PRIOR words, is a token's p-value against "an ordinary word". That share is
itself drawn, with the same weight, towards an assumed one (ASSUMED: inverse to the randomness, FALSE_DISCOVERY at a
randomness of FALSE_DISCOVERY), which fades as words are seen; one rule holds from no words at all to any number. A
Benjamini-Hochberg threshold over all distinct tokens that mix letters and digits keeps the expected share of ordinary
words among the findings below FALSE_DISCOVERY. Counts are kept by class of length and by bin of randomness, so that what
reaches the driver has a fixed size.

Defined cases: null text is empty and has no findings; repeated rows repeat; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
TOKEN = re.compile(r"(?<![\w+/=-])[A-Za-z0-9+/_=-]{16,}(?![\w+/=-])")
#: Classes of length begin here; bins of randomness, on a logarithmic scale.
LENGTHS, BINS = np.array([16, 20, 24, 32, 48, 64]), 40
FALSE_DISCOVERY, LEAST_RANDOM, PRIOR = 0.05, 0.01, 19
#: By bin, the share of ordinary words taken to be at least as random before any is seen.
ASSUMED = np.minimum(1, FALSE_DISCOVERY**2 / 10 ** (4 * np.arange(BINS) / BINS - 4))

_ORD = np.zeros((4, 128), np.int64)
for _row, _alphabet in enumerate(("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")):
    for _i, _c in enumerate(_alphabet):
        _ORD[_row, ord(_c)] = _i
_ORD[3, ord("-")], _ORD[3, ord("_")] = 62, 63
_SIZE = np.array([16, 16, 32, 64])
_erfc = np.vectorize(math.erfc, otypes=[float])


def battery(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: class of length, randomness in 0..1, and what it is (0 word of letters, 1 letters and digits, 2 other)."""
    size = np.array([len(t) for t in tokens])
    flat = np.frombuffer("".join(tokens).encode("ascii"), np.uint8)
    ends = np.cumsum(size)
    start = ends - size
    digit = (flat >= 48) & (flat <= 57)
    lower, upper = (flat >= 97) & (flat <= 122), (flat >= 65) & (flat <= 90)
    every = lambda x: np.logical_and.reduceat(x, start)
    some = lambda x: np.logical_or.reduceat(x, start)
    letters = lower | upper
    kind = np.where(every(letters), 0, np.where(some(letters) & some(digit), 1, 2))
    code = np.where(every(digit | ((flat >= 97) & (flat <= 102))), 0, np.where(every(digit | ((flat >= 65) & (flat <= 70))), 1, np.where(every(upper | ((flat >= 50) & (flat <= 55))), 2, 3)))
    owner = np.repeat(np.arange(len(size)), size)
    symbol = _ORD[code[owner], flat]
    alphabet = _SIZE[code]
    pairs, count = np.unique(owner * 64 + symbol, return_counts=True)
    squares = np.bincount(pairs // 64, weights=count.astype(float) ** 2, minlength=len(size))
    df = alphabet - 1
    chi = squares * alphabet / size - size
    z_chi = (np.cbrt(np.maximum(chi, 0) / df) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df))
    p_chi = 0.5 * _erfc(z_chi / math.sqrt(2))
    high = (symbol >= alphabet[owner] // 2).astype(float)
    inner = np.ones(len(flat), bool)
    inner[start] = False
    change = np.append(0, np.abs(np.diff(high))) * inner
    runs = 1 + np.add.reduceat(change, start)
    n1 = np.add.reduceat(high, start)
    n0 = size - n1
    mean, var = 2 * n1 * n0 / size + 1, 2 * n1 * n0 * (2 * n1 * n0 - size) / (size**2 * np.maximum(size - 1, 1.0))
    one_sided = np.minimum(n1, n0) == 0
    p_runs = np.where(one_sided, 2.0 ** (1 - size), _erfc(np.abs(runs - mean) / np.sqrt(np.maximum(var, 1e-9)) / math.sqrt(2)))
    dev = symbol - (np.add.reduceat(symbol.astype(float), start) / size)[owner]
    lagged = np.append(0, dev[1:] * dev[:-1]) * inner
    spread = np.add.reduceat(dev**2, start)
    r = np.where(spread > 0, np.add.reduceat(lagged, start) / np.maximum(spread, 1e-12), 1.0)
    p_serial = _erfc(np.abs(r) * np.sqrt(size) / math.sqrt(2))
    random = np.minimum(1, 3 * np.minimum(p_chi, np.minimum(p_runs, p_serial)))
    return np.searchsorted(LENGTHS, size, side="right") - 1, random, kind


def bins(random: np.ndarray) -> np.ndarray:
    """0 (least random, p <= 1e-4) to BINS - 1."""
    return np.clip(((np.log10(np.maximum(random, 1e-4)) + 4) / 4 * BINS).astype(int), 0, BINS - 1)


def _tokens(texts: list[str]) -> tuple[list[str], list[tuple[int, int, int]]]:
    words, at = [], []
    for i, t in enumerate(texts):
        for m in TOKEN.finditer(t):
            words.append(m[0])
            at.append((i, m.start(), m.end()))
    return words, at


def _cells(batches):
    """The distinct tokens of each batch: a hash, and the kind, class of length and bin as one number."""
    for batch in batches:
        seen: set[str] = set()
        for _, part in C.text_slices(batch.column(0)):
            seen.update(_tokens(part.to_pylist())[0])
        if seen:
            words = list(seen)
            length, random, kind = battery(words)
            h = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words)).view(np.int64)
            cell, keep = (kind * len(LENGTHS) + length) * BINS + bins(random), kind < 2
            yield pa.RecordBatch.from_arrays([pa.array(h[keep], pa.int64()), pa.array(cell[keep], pa.int64())], names=["h", "cell"])


def limits_of(seen: np.ndarray) -> np.ndarray:
    """thresholds from the counts of distinct tokens by kind (0, 1), class of length and bin of randomness."""
    tail = np.cumsum(seen[0][:, ::-1], axis=1)[:, ::-1]  # words at least as random
    n = seen[0].sum(1, keepdims=True)
    shorter = (PRIOR * ASSUMED + np.cumsum(tail, axis=0)) / (PRIOR + np.cumsum(n, axis=0))
    p = (tail + PRIOR * shorter) / (n + PRIOR)
    order = np.argsort(p, axis=None)
    tested = np.cumsum(seen[1].ravel()[order])
    m = max(1.0, seen[1].sum())
    passed = np.flatnonzero((p.ravel()[order] <= FALSE_DISCOVERY * tested / m) & (tested > 0))
    limit = p.ravel()[order][passed[-1]] if len(passed) else -1.0
    least = np.arange(BINS) >= bins(np.array([LEAST_RANDOM]))[0]
    return (p <= limit) & least[None, :]


def thresholds(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Boolean (class of length, bin of randomness): tokens there that mix letters and digits count as secrets."""
    single = docs.select(docs[text_col].alias("text")).mapInArrow(_cells, "h long, cell long").distinct()
    seen = np.zeros(2 * len(LENGTHS) * BINS)
    for cell, n in single.groupBy("cell").count().collect():
        seen[cell] = n
    return limits_of(seen.reshape(2, len(LENGTHS), BINS))


def base_spans(t: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start, then kind."""
    found = []
    low = t.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    if "AKIA" in t:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(t)]
    return sorted(found)


def listed(spans: list[tuple[int, int, int]], names: tuple[str, ...]) -> str:
    return ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)


def scan_texts(texts: list[str], limits: np.ndarray) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text."""
    out = [(x := base_spans(t), list(x)) for t in texts]
    words, at = _tokens(texts)
    if words:
        length, random, kind = battery(words)
        hit = (kind == 1) & limits[length, bins(random)]
        for i in np.flatnonzero(hit):
            doc, s, e = at[i]
            if not any(s >= a and e <= b for a, _, b in out[doc][0]):
                out[doc][1].append((s, 3, e))
    for _, spans in out:
        spans.sort()
    return out


def scan(docs: DataFrame, text_col: str = "text", redact: Callable[[int], str] | None = None) -> DataFrame:
    """docs with n_assign, n_access, n_hex, base_sha256, spans added; with redact, findings in the text are replaced.

    redact gets the number of a finding's kind in KINDS. Overlapping findings are replaced as one, by their first kind.
    """
    added = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
    limits = thresholds(docs, text_col)
    kept = [c for c in docs.columns if c not in added]
    frame = docs.select(*(docs[c] for c in kept))
    col = kept.index(text_col)
    fields = ", ".join(f"`{c}` {t}" for c, t in frame.dtypes)

    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column(col).to_pylist()
        got = []
        for start, part in C.text_slices(batch.column(col)):
            got += scan_texts(part.to_pylist(), limits)
        cols = dict(zip(kept, batch.columns, strict=True))
        for k, name in enumerate(added[:3]):
            cols[name] = [sum(x[1] == k for x in base) for base, _ in got]
        cols["base_sha256"] = [hashlib.sha256(listed(base, KINDS).encode()).hexdigest() for base, _ in got]
        cols["spans"] = [listed(spans, KINDS) for _, spans in got]
        if redact:
            cols[text_col] = [t if t is None or not spans else replaced(t, spans, redact) for t, (_, spans) in zip(texts, got, strict=True)]
        return cols

    return C.map_arrow(frame, run, f"{fields}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def replaced(t: str, spans: list[tuple[int, int, int]], name: Callable[[int], str]) -> str:
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [t[at:s], name(k)]
        at = max(at, e)
    return "".join([*out, t[at:]])
