"""Vector codes by product quantisation, its codebooks fitted with active-entry Lloyd rounds.

Components become integers (floor(SCALE * x)), vectors are cut into PARTS consecutive parts, and each part position has a
codebook of at most ENTRIES entries. Each row keeps, for each of its parts, the assigned entry and the exact squared
distance to it. After a round's update an entry is active if it moved. A part whose own entry stayed fixed compares only
the active entries against its stored distance: among the fixed ones its entry is still the nearest, of the lowest index.
The other parts rescan their whole codebook. A tie goes to the lower index in either case, so the codes are those of a
full scan.

Rows stay on the executors: each round reads the rows' table and writes the next (the one before is then removed). Entry
sums are added up in the tasks and then by Spark; the driver holds the codebooks alone, ENTRIES vectors.

Defined cases: rows whose vector is null or holds a null or non-finite component are left out; zero vectors stay. Parts
have as many components as the longest vector needs, shorter vectors count as padded with zeros (an empty vector is all
zeros). Integers beyond +-LIMIT (components of 65536 and more) are clamped there, so that all sums are exact in 64 bits.
Equal ids: all rows stay; the codebooks start from the smallest ids, among equal ones from the smaller vectors, null ids
last. With fewer than ENTRIES rows the codebooks have as many entries as there are rows. Null labels form one group. An
empty table gives no rows and codebooks without entries. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 24


@dataclass
class Codes:
    """rows: id, label, code (a byte a part), error; books: int64 (parts, entries, components of a part)."""

    rows: DataFrame
    books: np.ndarray

    def sha256(self) -> str:
        """Lowercase hex of all entries' components in decimal, by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def quantise(vectors: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Which vectors count, and those vectors' integers."""
    lists = vectors.cast(pa.list_(pa.float64()))
    size = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
    flat = pc.list_flatten(lists)
    x = np.asarray(pc.fill_null(flat, float("nan")), dtype=np.float64)
    good = np.asarray(pc.is_valid(lists)).astype(bool)
    good[np.repeat(np.arange(len(size)), size)[~np.isfinite(x)]] = False
    x, size = x[np.repeat(good, size)], size[good]
    with np.errstate(over="ignore"):
        q = np.clip(np.floor(x * SCALE), -LIMIT, LIMIT).astype(np.int32)
    return good, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(q))


def parts(lists: pa.Array, width: int) -> np.ndarray:
    """(rows, PARTS, width) int64 of integer vectors, padded with zeros."""
    size = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    out = np.zeros((len(size), PARTS * width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = np.asarray(pc.list_flatten(lists))
    return out.reshape(len(size), PARTS, width)


def _nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest entry, the lower number on a tie."""
    d = ((x[:, None, :] - entries[None]) ** 2).sum(2)
    best = d.argmin(1)
    return best, d[np.arange(len(x)), best]


def assign(x: np.ndarray, books: np.ndarray, code: np.ndarray | None = None, dist: np.ndarray | None = None, moved: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Entry and distance of every part; given the last ones and which entries moved since, only what can have changed is compared."""
    new_code, new_dist = np.zeros(x.shape[:2], np.uint8), np.zeros(x.shape[:2], np.int64)
    for p in range(x.shape[1]):
        rescan = np.arange(len(x))
        if code is not None:
            new_code[:, p], new_dist[:, p] = code[:, p], dist[:, p]
            mine = moved[p][code[:, p]]
            rescan, fixed, active = np.flatnonzero(mine), np.flatnonzero(~mine), np.flatnonzero(moved[p])
            if len(active) and len(fixed):
                best, d = _nearest(x[fixed, p], books[p][active])
                best = active[best]
                closer = (d < dist[fixed, p]) | ((d == dist[fixed, p]) & (best < code[fixed, p]))
                new_code[fixed[closer], p], new_dist[fixed[closer], p] = best[closer], d[closer]
        if len(rescan):
            new_code[rescan, p], new_dist[rescan, p] = _nearest(x[rescan, p], books[p])
    return new_code, new_dist


def _bytes(rows: np.ndarray) -> pa.Array:
    """One binary value a row."""
    width = rows.shape[1] * rows.itemsize
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _round(rows: DataFrame, label: str, books: np.ndarray, moved: np.ndarray | None) -> DataFrame:
    """rows with code and dist for these codebooks."""
    width = books.shape[2]

    def run(batch: pa.RecordBatch) -> dict:
        x = parts(batch.column(2), width)
        last = () if moved is None else (np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, PARTS), np.frombuffer(b"".join(batch.column(4).to_pylist()), np.int64).reshape(-1, PARTS), moved)
        code, dist = assign(x, books, *last)
        return {"id": batch.column(0), "label": batch.column(1), "q": batch.column(2), "code": _bytes(code), "dist": _bytes(dist)}

    kinds = dict(rows.dtypes)
    return C.map_arrow(rows, run, f"id {kinds['id']}, label {label}, q array<int>, code binary, dist binary")


def _update(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The next codebooks: floor of the mean of an entry's parts; unused entries stay."""
    entries, width = books.shape[1:]

    def add(batches):
        total, n = np.zeros((PARTS, entries, width), np.int64), np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            x = parts(batch.column(0), width)
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, PARTS)
            for p in range(PARTS):
                np.add.at(total[p], code[:, p], x[:, p])
                n[p] += np.bincount(code[:, p], minlength=entries)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_pydict({"p": pa.array(p, pa.int32()), "e": pa.array(e, pa.int32()), "n": pa.array(n[p, e], pa.int64()), "s": pa.array(list(total[p, e]), pa.list_(pa.int64()))})

    partial = rows.select("q", "code").mapInArrow(add, "p int, e int, n long, s array<long>")
    sums = [F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)]
    new = books.copy()
    for p, e, n, *s in partial.groupBy("p", "e").agg(F.sum("n").alias("n"), *sums).collect():  # PARTS x ENTRIES rows at most
        new[p, e] = np.array(s, np.int64) // n
    return new


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> Codes:
    """Codes of all vectors that count, with the codebooks fitted on all of them."""
    kinds = dict(vectors.dtypes)
    label = kinds[label_col]

    def run(batch: pa.RecordBatch) -> dict:
        good, q = quantise(batch.column(2))
        keep = pa.array(good)
        return {"id": batch.column(0).filter(keep), "label": batch.column(1).filter(keep), "q": q}

    rows = C.cut(C.map_arrow(C.only(vectors, id_col, label_col, vector_col), run, f"id {kinds[id_col]}, label {label}, q array<int>"))
    longest = rows.agg(F.max(F.size("q"))).first()[0] or 0
    width = -(-longest // PARTS)
    first = rows.orderBy(F.col("id").asc_nulls_last(), "q").select("q").limit(ENTRIES).toArrow()
    books = np.ascontiguousarray(parts(first.column(0).combine_chunks(), width).transpose(1, 0, 2))
    moved = None
    for turn in range(ROUNDS + 1):
        done, rows = rows, C.cut(_round(rows, label, books, moved))
        C.discard(done)
        if turn < ROUNDS:
            new = _update(rows, books)
            books, moved = new, (new != books).any(2)
    def total(batch: pa.RecordBatch) -> dict:
        dist = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int64).reshape(-1, PARTS)
        return {"id": batch.column(0), "label": batch.column(1), "code": batch.column(2), "error": dist.sum(1)}

    return Codes(C.map_arrow(rows.select("id", "label", "code", "dist"), total, f"id {kinds[id_col]}, label {label}, code binary, error long"), books)


def label_errors(codes: Codes) -> DataFrame:
    """The rows with label_error: the error summed over the rows of an equal label."""
    sums = codes.rows.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")).withColumnRenamed("label", "_label")
    return codes.rows.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
