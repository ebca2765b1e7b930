"""Helpers shared by the operators: shared tables, hashing of words, connected components, row bitmaps.

Nothing here keeps data in a machine-local folder: tables that cut a lineage are parquet in the folder that
``spark.checkpoint.dir`` names, which every executor can read again after another one is lost.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, and bytes, that Spark sends to Python at once; long documents make larger batches too heavy for a worker.
ARROW_ROWS, ARROW_BYTES = 512, "4m"
#: Bytes of text that a worker turns into words or n-grams at once; the arrays of a slice take up to 65 times as much.
SLICE_BYTES = 500_000
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Session settings that every operator relies on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a temporary one, but only on a local master."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tidemark-llm-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Write a frame once into the shared folder and read it back: ends its lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the folder of a frame that ``cut`` returned, once nothing will read it again."""
    jvm = df.sparkSession.sparkContext._jvm
    paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for path in paths:
        if "/llm-" in path:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, so that further columns of the input, whatever their names, cannot clash."""
    return df.select(*(df[n] for n in names))


def map_arrow(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str) -> DataFrame:
    """mapInArrow with a function from one batch to a dict of columns (or several)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            got = f(batch)
            for cols in [got] if isinstance(got, dict) else got:
                yield pa.RecordBatch.from_arrays([pa.array(cols[x.name], type=x.type) if not isinstance(cols[x.name], pa.Array) else cols[x.name].cast(x.type) for x in out], schema=out)
        pa.default_memory_pool().release_unused()  # an idle worker keeps none of it beside later stages

    return df.mapInArrow(run, schema)


def text_slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Cut an array of texts into runs of about SLICE_BYTES; nulls become empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    sizes = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
    start = 0
    while start < len(texts):
        base = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, base + SLICE_BYTES, side="right")))
        yield start, texts.slice(start, end - start)
        start = end


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, ...]]:
    """A partition's rows in runs of about so many bytes of text (the last column; nulls become empty), columns as arrays."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined():
        return tuple(pa.concat_arrays([b.column(i) for b in held]) for i in range(held[0].num_columns))

    for batch in batches:
        texts = pc.fill_null(batch.column(batch.num_columns - 1).cast(pa.large_string()), "")
        batch = pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=batch.schema.names)
        sizes = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64) + 16)
        start = 0
        while start < len(texts):
            before = sizes[start - 1] if start else 0
            end = min(len(texts), int(np.searchsorted(sizes, before + most - size)) + 1)
            held.append(batch.slice(start, end - start))
            size += int(sizes[end - 1] - before)
            start = end
            if size >= most:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def split_words(texts: pa.Array, space: bytes, stop: bytes = b"", lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts (large strings, no nulls), each one's text, and how many stops are before it (over all texts).

    A word is a longest run of bytes that are neither in space nor in stop; a line feed, which must be in either, ends
    every text. lower: A-Z become a-z.
    """
    joined = pc.binary_join_element_wise(texts.cast(pa.large_binary()), pa.scalar(b"\n", pa.large_binary()), pa.scalar(b"", pa.large_binary()))
    if not len(joined):
        return pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    raw = np.frombuffer(joined.buffers()[2], np.uint8)[at[0] : at[-1]]
    kind = np.zeros(256, np.uint8)
    kind[list(space)], kind[list(stop)] = 1, 2
    kind = kind[raw]
    inside = kind == 0
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    ends = np.flatnonzero(~inside & np.concatenate([[False], inside[:-1]]))
    data = raw[inside]
    if lower:
        fold = np.arange(256, dtype=np.uint8)
        fold[65:91] += 32
        data = fold[data]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    stops = np.cumsum(kind == 2)[starts] if stop else np.zeros(len(starts), np.int64)
    return words, np.searchsorted(at - at[0], starts, side="right") - 1, stops


def pack(data: bytes | np.ndarray) -> bytes:
    """Compressed bytes; of numbers, the bytes of equal weight together."""
    if isinstance(data, np.ndarray):
        data = np.ascontiguousarray(data).view(np.uint8).reshape(-1, data.itemsize).T.tobytes()
    return zstandard.compress(data, 1)


def unpack(data: bytes, kind=None) -> bytes | np.ndarray:
    """The inverse of pack; kind: the numbers' type."""
    raw = zstandard.decompress(data)
    if kind is None:
        return raw
    kind = np.dtype(kind)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(kind.itemsize, -1).T).view(kind).ravel() if raw else np.zeros(0, kind)


def arrow_schema(sql: str) -> pa.Schema:
    """The Arrow schema of a schema in SQL."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(sql))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of every text (A-Z lower-cased, split at \\x20 and \\x09-\\x0D), flat, and their offsets."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, owner = pc.list_flatten(lists), np.asarray(pc.list_parent_indices(lists), dtype=np.int64)
    real = np.asarray(pc.greater(pc.binary_length(flat), 0)).astype(bool)
    if not real.all():
        flat, owner = flat.filter(pa.array(real)), owner[real]
    coded = flat.dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    table = np.fromiter((digest(x) for x in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    hashes = table[np.asarray(coded.indices)] if len(flat) else np.zeros(0, np.uint64)
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(texts: pa.Array, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each text, flat and sorted within a text, and offsets (a shorter text: its whole sequence)."""
    words, at = word_hashes(texts)
    n = np.diff(at)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(ends[-1], np.uint64)
    total = len(words)
    if total >= k:
        odd = np.array([0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64 | 1 for i in range(k)], np.uint64)
        rolled = words[: total - k + 1] * odd[0]
        for i in range(1, k):
            rolled ^= mix(words[i : total - k + 1 + i] + odd[i])
        rolled = mix(rolled)
        long = np.flatnonzero(n >= k)
        take = np.repeat(at[:-1][long] - ends[:-1][long], size[long])
        where = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in long]) if len(long) else np.zeros(0, np.int64)
        out[where] = rolled[where + take]
    for i in np.flatnonzero((n > 0) & (n < k)):
        h = np.uint64(n[i])
        for w in words[at[i] : at[i + 1]]:
            h = mix(np.array([h ^ w], np.uint64))[0]
        out[ends[i]] = h
    owner = np.repeat(np.arange(len(n)), size)
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    first = np.ones(len(out), bool)
    first[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    out, owner = out[first], owner[first]
    return out, np.searchsorted(owner, np.arange(len(n) + 1))


def bitmap(df: DataFrame, hashed: str, bits: int = 24) -> np.ndarray:
    """A fixed-size bitmap (2**bits bits, so at most 2**bits / 8 bytes on the driver) of the hashes in a column."""
    slot = F.pmod(F.col(hashed), F.lit(1 << bits))
    rows = df.where(F.col(hashed).isNotNull()).select(slot.alias("s")).groupBy(F.expr("bitmap_bucket_number(s + 1)").alias("b")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(s + 1))").alias("m")).collect()
    out = np.zeros((1 << bits) // 8, np.uint8)
    for b, m in rows:
        out[(b - 1) * 4096 : (b - 1) * 4096 + len(m)] = np.frombuffer(bytes(m), np.uint8)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which signed 64-bit hashes may be in the bitmap."""
    slot = hashes.view(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _forest(batches):
    """Edges of one partition as stars: each node of a partial component with its smallest node."""
    up: dict[int, int] = {}

    def root(x):
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = up[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    nodes = [(x, r) for x in up if (r := root(x)) != x]
    for i in range(0, len(nodes), 50_000):
        v, m = zip(*nodes[i : i + 50_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(m, pa.int64())], names=["v", "m"])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (two long columns): rows (node, component), component = smallest node.

    Each partition is first reduced to stars; alternating large-star and small-star rounds then merge them. Every step
    is an aggregate (combined before the shuffle) and a join, and each round is written to the shared folder.
    """
    a, b = edges.columns
    e = cut(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("v"), F.col(b).alias("m")).mapInArrow(_forest, "v long, m long"))
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        both = e.select("v", "m").union(e.select("m", "v")).toDF("u", "n")
        least = both.groupBy("u").agg(F.least(F.min("n"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("n > u").select(F.col("n").alias("v"), "m").where("v != m").distinct()
        low = large.groupBy("v").agg(F.min("m").alias("low"))
        small = large.join(low, "v").select(F.explode(F.array(F.struct(F.col("v"), F.col("low").alias("m")), F.struct(F.col("m").alias("v"), F.col("low").alias("m")))).alias("e")).select("e.*").where("v != m").distinct()
        e = cut(small)
    return e.groupBy(F.col("v").alias("node")).agg(F.min("m").alias("component")).union(e.select("m", "m").distinct())
