"""Removal of repeated passages with fixed-block anchors.

Texts are taken as words. Every text is cut into non-overlapping reference blocks of BLOCK words, and every rolling window
of BLOCK words probes the index of these blocks. A passage of LEAST = 2 * BLOCK - 1 words or more holds a whole block
wherever it starts, so each of its occurrences has a window that hits. Hits are then extended: of the windows of LEAST
words that hold a hit, those whose words start anywhere else too are kept, and their union is what the maximal exact
repeats of LEAST words or more cover.

Partitions write chunks of documents (word numbers and the chunk's words). A chunk sends its distinct windows, with marks
for blocks and for windows it holds twice, in packed arrays to the bucket of their hash; a bucket answers with a byte for
each; the answers join the chunks again by chunk. So nothing is broadcast, no pairs are made, and a passage that a third
of all documents hold is one entry a chunk. Documents with equal words are found by digest in the same exchange: they are
covered whole, and only one of a group takes part in the extension.

Anchors have log2(buckets) + 32 bits; a false hit costs a comparison and changes nothing. Windows of LEAST words are equal if
two polynomial hashes of 64 bits each, of words hashed to 128 bits, are equal.

Defined cases: null and empty texts have no words, nothing removed and an empty text kept; a text of less than LEAST words
loses nothing; overlapping repeats within one document count; rows of equal id are documents of their own; kept words are
joined by one space. Further columns are ignored. The result has a row for each document, null ids included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

LEAST = 35
#: Bytes of text of a chunk, and windows of a bucket.
CHUNK_BYTES, BUCKET = 8_000_000, 1_000_000
SPACE = b" \t\n\x0b\x0c\r"
WINDOWS, DOCUMENTS, REPEATS = 0, 1, 2
TWICE, BLOCK_HERE = 1, 2
REPEATED, FIRST = 1, 2
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _chunk_rows(ids: pa.Array, texts: pa.Array) -> dict:
    words, owner, _ = C.split_words(texts, SPACE)
    coded = words.dictionary_encode()
    n = np.bincount(owner, minlength=len(ids))
    vocabulary = coded.dictionary
    codes = np.asarray(coded.indices, dtype=np.uint32)
    at = np.concatenate([[0], np.cumsum(n)])
    both = np.stack(_word_hashes(vocabulary), 1)[codes]
    digests = [hashlib.sha256(part.tobytes()).digest() for part in np.split(both, at[1:-1])]
    return {"ids": ids, "n": n.tolist(), "digests": digests, "words": C.pack(b"\n".join(vocabulary.to_pylist())), "n_words": len(codes), "codes": C.pack(codes)}


def _word_hashes(vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every word."""
    both = b"".join(xxhash.xxh3_128_digest(w) for w in vocabulary.to_pylist())
    halves = np.frombuffer(both, ">u8").astype(np.uint64).reshape(-1, 2)
    return halves[:, 0].copy(), halves[:, 1].copy()


def _rolling(hashes: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash (modulo 2**64) of every run of ``size`` words."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(base, n), dtype=np.uint64)])
    return C.mix((total[size:] - total[:-size]) * _powers(pow(base, -1, 2**64), n - size + 1))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Chunk:
    """A chunk's words and windows. ``size`` of the blocks follows from ``least``: any run of least words holds one."""

    def __init__(self, row: dict, least: int):
        self.n = np.array(row["n"], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.n)])
        self.least, self.size = least, (least + 1) // 2
        self.digests = row["digests"]
        self.vocabulary = pa.array(C.unpack(row["words"]).split(b"\n") if self.at[-1] else [], pa.large_binary())
        self.codes = C.unpack(row["codes"], np.uint32)
        self.low, self.high = (h[self.codes] for h in _word_hashes(self.vocabulary))
        self.left = np.repeat(self.at[1:], self.n) - np.arange(self.at[-1])  # words from here to the document's end

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, hash) of every window of a block's length inside a document of ``least`` words or more."""
        start = np.flatnonzero((self.left >= self.size) & np.repeat(self.n >= self.least, self.n))
        return start, _rolling(self.low, self.size, _BASES[0])[start]

    def blocks(self, start: np.ndarray) -> np.ndarray:
        return (start - np.repeat(self.at[:-1], self.n)[start]) % self.size == 0

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """The documents that have ``least`` words or more, and the digests of them."""
        which = np.flatnonzero(self.n >= self.least)
        return which, np.frombuffer(b"".join(self.digests[i][:16] for i in which), np.uint64).reshape(-1, 2)


def _runs(order: np.ndarray, keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The begins of equal keys in this order, and how long each run is."""
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(order)))


def _entries(where: np.ndarray, order: np.ndarray, keys: list[np.ndarray], flags: np.ndarray):
    """Distinct keys in an order that has the buckets ascending: (the inputs' places, each one's key number, the first
    input of each key, the keys' flags joined)."""
    first, run = _runs(order, keys)
    joined = np.bitwise_or.reduceat(flags[order], first) | (run > 1).astype(np.uint8) * TWICE if len(first) else flags[:0]
    return where[order], np.repeat(np.arange(len(first)), run), order[first], joined.astype(np.uint8)


def _window_keys(chunk: _Chunk, buckets: int):
    """Windows by anchor: the bucket is the hash modulo buckets, the rest of the key 32 bits of the quotient."""
    start, h = chunk.windows()
    bucket, low = h % np.uint64(buckets), h // np.uint64(buckets) & np.uint64(0xFFFFFFFF)
    key = bucket << np.uint64(32) | low
    flags = np.where(chunk.blocks(start), BLOCK_HERE, 0).astype(np.uint8)
    places, number, first, flags = _entries(start, np.argsort(key, kind="stable"), [key], flags)
    return places, number, bucket[first].astype(np.int64), (None, low[first].astype(np.uint32)), flags


def _pair_keys(where: np.ndarray, high: np.ndarray, low: np.ndarray, buckets: int):
    bucket = high % np.uint64(buckets)
    places, number, first, flags = _entries(where, np.lexsort((low, high, bucket)), [high, low], np.zeros(len(where), np.uint8))
    return places, number, bucket[first].astype(np.int64), (high[first], low[first]), flags


def _document_keys(chunk: _Chunk, buckets: int):
    which, keys = chunk.whole()
    return _pair_keys(which, keys[:, 0], keys[:, 1], buckets)


def _repeat_keys(chunk: _Chunk, hits: np.ndarray, copies: np.ndarray, buckets: int):
    """The windows of ``least`` words that hold a hit, those of further copies of a document left out."""
    n = len(chunk.codes)
    before = np.concatenate([[0], np.cumsum(np.bincount(hits, minlength=n))])
    start = np.flatnonzero((chunk.left >= chunk.least) & ~np.repeat(copies, chunk.n))
    start = start[before[start + chunk.least - chunk.size + 1] > before[start]]
    high, low = (_rolling(h, chunk.least, b)[start] for h, b in zip((chunk.high, chunk.low), _BASES, strict=True))
    return _pair_keys(start, high, low, buckets)


def _edges(bucket: np.ndarray) -> np.ndarray:
    """Where each bucket's keys begin."""
    return np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])


def _sent(name: str, kind: int, keys) -> Iterator[dict]:
    """A row for each bucket that a chunk has keys for."""
    _, _, bucket, (high, low), flags = keys
    edges = _edges(bucket)
    for a, b in zip(edges, [*edges[1:], len(bucket)][: len(edges)], strict=True):
        yield {"kind": kind, "bucket": int(bucket[a]), "chunk": name, "high": b"" if high is None else C.pack(high[a:b]), "low": C.pack(low[a:b]), "flags": C.pack(flags[a:b])}


SENT = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.string()), ("high", pa.binary()), ("low", pa.binary()), ("flags", pa.binary())])
SENT_SQL = "kind int, bucket long, chunk string, high binary, low binary, flags binary"
ANSWER = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.string()), ("answer", pa.binary())])
ANSWER_SQL = "kind int, bucket long, chunk string, answer binary"


def _answer(group: pa.Table) -> pa.Table:
    """One bucket: which keys are there more than once (anchors: and are a block somewhere), and the chunk that has a key first."""
    group = group.sort_by("chunk")
    kind = group.column("kind")[0].as_py()
    low = [C.unpack(x, np.uint32 if kind == WINDOWS else np.uint64) for x in group.column("low").to_pylist()]
    size = [len(x) for x in low]
    keys = [np.concatenate(low)]
    if kind != WINDOWS:
        keys.append(np.concatenate([C.unpack(x, np.uint64) for x in group.column("high").to_pylist()]))
    flags = np.concatenate([C.unpack(x, np.uint8) for x in group.column("flags").to_pylist()])
    order = np.argsort(keys[0], kind="stable") if kind == WINDOWS else np.lexsort(keys)
    first, run = _runs(order, keys)
    flag = np.bitwise_or.reduceat(flags[order], first)
    again = (run > 1) | (flag & TWICE > 0)
    if kind == WINDOWS:
        again &= flag & BLOCK_HERE > 0
    told = np.repeat(again.astype(np.uint8) * REPEATED, run)
    told[first] |= FIRST
    out = np.zeros(len(order), np.uint8)
    out[order] = told
    parts = np.split(out, np.cumsum(size)[:-1])
    return pa.Table.from_arrays([group.column("kind"), group.column("bucket"), group.column("chunk"), pa.array([C.pack(x) for x in parts], pa.binary())], schema=ANSWER)


def _answered(answers: list[dict], kind: int, keys) -> np.ndarray:
    """The answer to every key of a chunk, by the key's place."""
    _, number, bucket, _, _ = keys
    out = np.zeros(len(bucket), np.uint8)
    edges = _edges(bucket)
    start = dict(zip(bucket[edges].tolist(), edges.tolist(), strict=True))
    for a in answers:
        if a["kind"] == kind:
            got = C.unpack(a["answer"], np.uint8)
            out[start[a["bucket"]] : start[a["bucket"]] + len(got)] = got
    return out[number]


def _copies(chunk: _Chunk, answers: list[dict], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents whose words another document has too, and all of those but one of each group."""
    keys = _document_keys(chunk, buckets)
    got = _answered(answers, DOCUMENTS, keys)
    same, further = np.zeros(len(chunk.n), bool), np.zeros(len(chunk.n), bool)
    same[keys[0][got & REPEATED > 0]] = True
    here = np.append(True, keys[1][1:] != keys[1][:-1])[: len(got)]  # the chunk's first of equal ones
    further[keys[0][(got & REPEATED > 0) & ~((got & FIRST > 0) & here)]] = True
    return same, further


def _extended(chunk: _Chunk, answers: list[dict], buckets: int):
    """(documents covered whole, the keys of the windows that extend hits)."""
    keys = _window_keys(chunk, buckets)
    hits = keys[0][_answered(answers, WINDOWS, keys) & REPEATED > 0]
    same, further = _copies(chunk, answers, buckets)
    return same, _repeat_keys(chunk, hits, further, buckets)


def remove_repeats(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of id_col, n_words, n_removed, removed (ranges of words: start, end exclusive) and text (the kept words)."""
    kind = dict(docs.dtypes)[id_col]
    chunk_sql = f"chunk string, ids array<{kind}>, n array<long>, digests array<binary>, words binary, n_words long, codes binary"
    fields = C.arrow_schema(chunk_sql)

    def write(batches):
        part, k = TaskContext.get().partitionId(), 0
        for ids, texts in C.gathered(batches, CHUNK_BYTES):
            row = _chunk_rows(ids, texts)
            yield pa.RecordBatch.from_pydict({"chunk": [f"{part}-{k}"], **{c: pa.array([row[c]], fields.field(c).type) for c in fields.names[1:]}}, schema=fields)
            k += 1

    chunks = C.cut(C.only(docs, id_col, text_col).mapInArrow(write, chunk_sql))
    total = chunks.agg(F.sum("n_words")).first()[0] or 0
    buckets = 1 + total // BUCKET

    def probe(batches):
        for batch in batches:
            for row in batch.to_pylist():
                chunk = _Chunk(row, least)
                for what, keys in ((WINDOWS, _window_keys), (DOCUMENTS, _document_keys)):
                    if rows := list(_sent(row["chunk"], what, keys(chunk, buckets))):
                        yield pa.RecordBatch.from_pylist(rows, schema=SENT)

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for row in left.to_pylist():
            rows += _sent(row["chunk"], REPEATS, _extended(_Chunk(row, least), right.to_pylist(), buckets)[1])
        return pa.Table.from_pylist(rows, schema=SENT)

    out_sql = f"`{id_col}` {kind}, n_words long, n_removed long, removed array<struct<start: long, end: long>>, text string"
    out_schema = C.arrow_schema(out_sql)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [_kept(left.slice(i, 1), _Chunk(row, least), right.to_pylist(), buckets, out_schema) for i, row in enumerate(left.select([c for c in left.column_names if c != "ids"]).to_pylist())]
        return pa.concat_tables(parts) if parts else out_schema.empty_table()

    words = chunks.select("chunk", "n", "digests", "words", "codes")
    first = C.cut(words.mapInArrow(probe, SENT_SQL).groupBy("kind", "bucket").applyInArrow(_answer, ANSWER_SQL))
    sent = words.groupBy("chunk").cogroup(first.groupBy("chunk")).applyInArrow(extend, SENT_SQL)
    second = C.cut(sent.groupBy("kind", "bucket").applyInArrow(_answer, ANSWER_SQL))
    return chunks.groupBy("chunk").cogroup(first.union(second).groupBy("chunk")).applyInArrow(finish, out_sql)


def _kept(row: pa.Table, chunk: _Chunk, answers: list[dict], buckets: int, schema: pa.Schema) -> pa.Table:
    """The result rows of one chunk."""
    n_all = len(chunk.codes)
    same, keys = _extended(chunk, answers, buckets)
    start = keys[0][_answered(answers, REPEATS, keys) & REPEATED > 0]
    edge = np.bincount(start, minlength=n_all + 1) - np.bincount(start + chunk.least, minlength=n_all + 1)
    gone = (np.cumsum(edge)[:n_all] > 0) | np.repeat(same, chunk.n)
    doc = np.repeat(np.arange(len(chunk.n)), chunk.n)
    removed = np.bincount(doc[gone], minlength=len(chunk.n))
    begins = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1] | (doc[1:] != doc[:-1])])[:n_all])
    ends = np.flatnonzero(gone & np.concatenate([~gone[1:] | (doc[1:] != doc[:-1]), [True]])[:n_all]) + 1
    spans = np.searchsorted(doc[begins], np.arange(len(chunk.n) + 1)) if len(begins) else np.zeros(len(chunk.n) + 1, np.int64)
    base = chunk.at[doc[begins]]
    ranges = pa.StructArray.from_arrays([pa.array(begins - base, pa.int64()), pa.array(ends - base, pa.int64())], ["start", "end"])
    kept = chunk.vocabulary.take(pa.array(chunk.codes[~gone]))
    at = np.concatenate([[0], np.cumsum(chunk.n - removed)])
    text = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at, pa.int64()), kept), pa.scalar(b" ", pa.large_binary())).cast(pa.large_string())
    ids = row.column("ids").combine_chunks().flatten()
    columns = [ids, pa.array(chunk.n, pa.int64()), pa.array(removed, pa.int64()), pa.ListArray.from_arrays(pa.array(spans, pa.int32()), ranges), text]
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
