"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so that 80 hash
evaluations a shingle fill 160 signature values; 32 bands of 5 values propose candidates, a sketch of the 160 low bytes
estimates their similarity, and every link that counts is confirmed on the full shingle sets.

Stages (all keyed work is shuffled; nothing is collected but a fixed-size bitmap and counts):

1. scan: per row the number of shingles, a 64-bit class id of the shingle set, 32 band keys and the sketch. Equal sets
   are one class from here on, so exact copies cost nothing further.
2. buckets of a band that hold more than one class; each class is held against the smallest class of its buckets.
3. buckets whose classes those links leave in several components are compared in full, as tiles of about 2 * TILE
   rows, by sketch. A tile gives a spanning forest of the components it suggests to link, never its pairs; the forests'
   components are clusters, inside which every pair that the sketches let pass, between different components, is
   confirmed in blocks that hold the texts.
4. components of all confirmed links.

Confirmation moves a document's text once to each bundle or block that needs it, not once a pair. A miss needs all 32 bands to
differ: 7e-9 at a similarity of 0.85, 3e-6 at 0.8; the sketch's cut lies
SKETCH_DEVIATIONS standard deviations below the threshold, which a pair at the threshold misses about once in 40 million.

Defined cases: a null or empty text, or one without words, has no shingles and is linked with nothing; fewer than five
words are one shingle; repeated rows are one class; a null doc_id stays in the result, never names a component that has
other ids, and equals only a null component_id; further columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

PERMUTATIONS, BANDS, ROWS = 80, 32, 5
SKETCH_DEVIATIONS = 6
TILE, BUNDLE, BLOCK_BYTES = 1024, 500, 4_000_000
_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)


def signatures(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """2 * PERMUTATIONS values a non-empty set: minima, then maxima, interleaved by permutation."""
    out = np.zeros((len(at) - 1, 2 * PERMUTATIONS), np.uint32)
    starts = at[:-1]
    for p in range(PERMUTATIONS):
        x = (((sets ^ _ADD[p]) * _MUL[p]) >> np.uint64(32)).astype(np.uint32)
        out[:, 2 * p] = np.minimum.reduceat(x, starts)
        out[:, 2 * p + 1] = np.maximum.reduceat(x, starts)
    return out


def class_ids(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    return C.mix(np.add.reduceat(C.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), at[:-1])).view(np.int64)


def _scan(batch: pa.RecordBatch):
    ids, keys = batch.column(0), batch.column(2)
    for start, texts in C.text_slices(batch.column(1)):
        sets, at = C.shingles(texts)
        n = np.diff(at)
        full = np.flatnonzero(n)
        cls, bands, sketch = np.zeros(len(n), np.int64), [None] * len(n), [None] * len(n)
        if len(full):
            offsets = np.append(at[full], at[-1])
            sig = signatures(sets, offsets)
            cls[full] = class_ids(sets, offsets)
            # a band takes values of ROWS different permutations: columns b, b + BANDS, ...
            order = np.arange(2 * PERMUTATIONS).reshape(ROWS, BANDS).T
            key = np.zeros((len(full), BANDS), np.uint64)
            for r in range(ROWS):
                key = C.mix(key * np.uint64(31) + sig[:, order[:, r]].astype(np.uint64) + np.uint64(r + 1))
            key = C.mix(key + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
            low = (sig & np.uint32(255)).astype(np.uint8)
            for j, i in enumerate(full):
                bands[i], sketch[i] = key[j], low[j].tobytes()
        yield {"doc_id": ids.slice(start, len(n)), "text_key": keys.slice(start, len(n)), "n_shingles": n, "cls": pa.array(cls, mask=n == 0), "bands": bands, "sketch": sketch}


def _filter_texts(bits):
    def run(batches):
        for b in batches:
            keep = C.in_bitmap(bits, np.asarray(b.column(0), dtype=np.int64))
            if keep.any():
                yield b.filter(pa.array(keep))

    return run


def _confirm(percent: int):
    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        names, body = texts["cls"].to_pylist(), texts["text"].combine_chunks()
        sets = {}
        if len(names):
            for start, part in C.text_slices(body if isinstance(body, pa.Array) else pa.concat_arrays(body.chunks)):
                flat, at = C.shingles(part)
                for i in range(len(part)):
                    sets[names[start + i]] = flat[at[i] : at[i + 1]]
        a, b = [], []
        for x, y in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True):
            s, t = sets.get(x), sets.get(y)
            if s is None or t is None or 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
                continue
            both = len(np.intersect1d(s, t, assume_unique=True))
            if 100 * both >= percent * (len(s) + len(t) - both):
                a.append(x)
                b.append(y)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, loc) of classes whose full sets reach the threshold. texts: cls, text, a row a class.

    loc names what pairs have in common (a bucket, a pivot); pairs of one loc share a bundle of about BUNDLE pairs, and
    a loc with more is split over several.
    """
    pairs = C.cut(pairs)
    total = pairs.count()
    if not total:
        return pairs.select("a", "b")
    loads = pairs.groupBy("loc").agg(F.count("*").alias("load"))
    parts = F.ceil(F.col("load") / BUNDLE)
    placed = pairs.join(loads, "loc").select("a", "b", F.pmod(F.xxhash64("loc", F.pmod(F.xxhash64("a"), parts)), F.lit(total // BUNDLE + 1)).alias("bundle"))
    placed = C.cut(placed)
    ends = placed.select(F.col("bundle").alias("at"), F.explode(F.array("a", "b")).alias("cls")).distinct()
    moved = ends.join(texts, "cls").select("at", "cls", "text")
    return placed.groupBy("bundle").cogroup(moved.groupBy("at")).applyInArrow(_confirm(percent), "a long, b long")


def _join_up(labels: np.ndarray, i: int, j: int) -> None:
    labels[labels == labels[j]] = labels[i]


def _partners(i: int, labels, n, side, sk, percent: int, need: int) -> np.ndarray:
    """Rows of the tile, in another component than row i, that may be linked with it."""
    rest = np.flatnonzero(side == 1) if side.any() else np.arange(i + 1, len(labels))
    rest = rest[labels[rest] != labels[i]]
    rest = rest[100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])]
    return rest[(sk[rest] == sk[i]).sum(1) >= need] if len(rest) else rest


def _near(floor: float, percent: int):
    """For each tile, a spanning forest of the components that its sketches suggest to link.

    Rows come sorted by (key, i, j), so a tile is a run of rows; a tile gives fewer edges than it has components.
    """
    need = int(np.ceil(floor * 2 * PERMUTATIONS))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def edges(table):
        k = [table[x].to_numpy() for x in ("key", "i", "j")]
        comp, n, side = (table[x].to_numpy() for x in ("comp", "n", "side"))
        sk = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(comp), -1)
        new = np.flatnonzero(np.any([np.diff(x) != 0 for x in k], axis=0)) + 1
        out: list = []
        for s, e in zip([0, *new], [*new, len(comp)], strict=True):
            labels = np.unique(comp[s:e], return_inverse=True)[1]
            for i in range(e - s):
                if side[s + i]:
                    continue
                for j in _partners(i, labels, n[s:e], side[s:e], sk[s:e], percent, need):
                    if labels[i] != labels[j]:
                        out.append((comp[s + i], comp[s + j]))
                        _join_up(labels, i, j)
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in (0, 1)], schema=schema)

    def run(batches):
        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            t = pa.Table.from_batches(held)
            last = [t[x][-1].as_py() for x in ("key", "i", "j")]
            done = int(np.argmax(np.all([t[x].to_numpy() == v for x, v in zip(("key", "i", "j"), last, strict=True)], axis=0)))
            if done:
                yield edges(t.slice(0, done))
            held = t.slice(done).to_batches()
        if held:
            yield edges(pa.Table.from_batches(held))

    return run


def _confirm_block(floor: float, percent: int):
    """Confirmed links between different components of one block (or pair of blocks) of suggested clusters."""
    need = int(np.ceil(floor * 2 * PERMUTATIONS))

    def run(table: pa.Table) -> pa.Table:
        out: list = []
        table = table.sort_by("cluster").combine_chunks()
        cls, cluster = table["cls"].to_numpy(), table["cluster"].to_numpy()
        sets: list = []
        for _, part in C.text_slices(pa.concat_arrays(table["text"].chunks)):
            flat, at = C.shingles(part)
            sets += [flat[at[i] : at[i + 1]] for i in range(len(part))]
        sk = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint8).reshape(len(cls), -1)
        comp, n, side = (table[x].to_numpy() for x in ("comp", "n", "side"))
        new = np.flatnonzero(np.diff(cluster)) + 1
        for s, e in zip([0, *new], [*new, len(cls)], strict=True):
            labels = np.unique(comp[s:e], return_inverse=True)[1]
            for i in range(e - s):
                if side[s + i]:
                    continue
                for j in _partners(i, labels, n[s:e], side[s:e], sk[s:e], percent, need):
                    if labels[i] == labels[j]:
                        continue
                    x, y = sets[s + i], sets[s + j]
                    both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        out.append((cls[s + i], cls[s + j]))
                        _join_up(labels, i, j)
        return pa.table({c: pa.array([x[k] for x in out], pa.int64()) for k, c in enumerate("ab")})

    return run


def confirm_blocks(members: DataFrame, texts: DataFrame, floor: float, percent: int) -> DataFrame:
    """Links between components of one cluster. members: cls, comp, n, sketch, cluster; texts: cls, text.

    A cluster of more than BLOCK_BYTES of text is cut into blocks, and each pair of blocks is a task of its own; smaller
    clusters share tasks of about that size.
    """
    rows = C.cut(members.join(texts, "cls").withColumn("bytes", F.octet_length("text").cast("long")))
    load = rows.groupBy("cluster").agg(F.ceil(F.sum("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    small = max(1, int((rows.agg(F.sum("bytes")).first()[0] or 0) // BLOCK_BYTES))
    mine = rows.drop("bytes").join(load, "cluster").withColumn("t", F.pmod(F.xxhash64("cls", F.lit(11)), F.greatest("blocks", F.lit(1))).cast("int"))
    split = mine.select("*", F.explode(F.sequence(F.lit(0), F.greatest("blocks", F.lit(1)) - 1)).alias("o"))
    split = split.select(
        F.when(F.col("blocks") > 1, F.xxhash64("cluster", F.least("t", "o"), F.greatest("t", "o"))).otherwise(F.pmod(F.xxhash64("cluster"), F.lit(small))).alias("task"),
        "cls", "comp", "n", "sketch", "cluster", (F.col("t") > F.col("o")).cast("int").alias("side"), "text",
    )
    return split.groupBy("task").applyInArrow(_confirm_block(floor, percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text_key (a hash of the text), n_shingles, component_id, kept for every row of docs; links: Jaccard similarity >= percent / 100."""
    spark = docs.sparkSession
    C.prepare(spark)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    keyed = rows.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))
    scanned = C.cut(C.map_arrow(keyed.select("doc_id", "text", "text_key"), _scan, "doc_id long, text_key long, n_shingles long, cls long, bands array<long>, sketch binary"))
    sets = scanned.where("cls is not null")
    classes = sets.groupBy("cls").agg(F.min("text_key").alias("text_key"), F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch"))

    keys = sets.select("cls", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("cls").alias("pivot"), F.max("cls").alias("top")).where("pivot <> top").select("key", "pivot")
    members = C.cut(keys.join(shared, "key").select("key", "pivot", "cls").distinct())
    wanted = members.select("cls").distinct()
    known = C.cut(classes.join(wanted, "cls", "left_semi"))
    sketches = known.select("cls", "n", "sketch")
    bits = C.bitmap(known, "text_key")
    texts = rows.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text").mapInArrow(_filter_texts(bits), "text_key long, text string")
    texts = C.cut(texts.join(known.select("cls", "text_key"), "text_key").groupBy("cls").agg(F.first("text").alias("text")))

    sd = float(np.sqrt(percent / 100 * (1 - percent / 100) / (2 * PERMUTATIONS)))
    floor = percent / 100 - SKETCH_DEVIATIONS * sd
    stars = members.where("cls <> pivot").select("cls", "pivot").distinct()
    stars = stars.join(sketches, "cls").join(sketches.select(F.col("cls").alias("pivot"), F.col("n").alias("n2"), F.col("sketch").alias("sketch2")), "pivot")
    stars = stars.where(F.lit(100) * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
    stars = C.map_arrow(stars.select("cls", "pivot", "sketch", "sketch2"), _alike(floor), "a long, b long, loc long")
    first = C.cut(confirm(stars, texts, percent))

    comp = C.components(first)
    placed = members.select("key", "cls").join(comp.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls")).drop("component")
    open_ = placed.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("size > 2 and c0 <> c1").select("key", F.ceil(F.col("size") / TILE).cast("int").alias("tiles"))
    mine = placed.join(open_, "key").join(sketches, "cls").withColumn("t", F.pmod(F.xxhash64("cls", F.lit(7)), F.col("tiles")).cast("int"))
    tiled = mine.select("key", "comp", "n", "sketch", "t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("o"))
    tiled = tiled.select("key", F.least("t", "o").alias("i"), F.greatest("t", "o").alias("j"), "comp", "n", (F.col("t") > F.col("o")).cast("int").alias("side"), "sketch")
    suggested = tiled.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_near(floor, percent), "a long, b long")
    clusters = C.components(C.cut(suggested)).select(F.col("node").alias("comp"), F.col("component").alias("cluster"))
    open_members = mine.select("cls", "comp").distinct().join(clusters, "comp").join(sketches, "cls")
    # cut before components: chained in one task, the two Python steps take a worker each, and workers stay
    links = first.union(C.cut(confirm_blocks(open_members, texts, floor, percent)))

    final = C.components(links).withColumnRenamed("node", "cls")
    firsts = sets.groupBy("cls").agg(F.min("doc_id").alias("first_id"))
    groups = firsts.join(final, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    heads = groups.groupBy("component").agg(F.min("first_id").alias("head"))
    named = groups.join(heads, "component").select("cls", "head")
    out = scanned.select("doc_id", "text_key", "n_shingles", "cls").join(named, "cls", "left")
    out = out.select("doc_id", "text_key", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("head")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with all its columns; repeated rows of one id and text are one."""
    found = near_duplicates(docs, percent, id_col, text_col).where("kept").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    rows = docs.withColumn("_text_key", F.xxhash64(F.coalesce(docs[text_col], F.lit(""))))
    rows = rows.join(found, rows["_text_key"].eqNullSafe(found["_key"]) & rows[id_col].cast("long").eqNullSafe(found["_id"]), "left_semi")
    return rows.dropDuplicates([id_col, "_text_key"]).drop("_text_key")


def _alike(floor: float):
    def run(batch: pa.RecordBatch) -> dict:
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, 2 * PERMUTATIONS) for i in (2, 3))
        keep = pa.array((x == y).mean(1) >= floor)
        a, b = batch.column(0).filter(keep), batch.column(1).filter(keep)
        return {"a": a, "b": b, "loc": b}

    return run
