"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are turned to principal axes, so that leading coordinates hold most of what tells two apart. Vectors lie in
cells of the first axes whose width is the largest distance that the threshold allows, so that a link joins the same or
neighbouring cells; only axes of more than three
cells are used, and as many as leave about a tile's neighbours to compare with, by the axes' spread. A cell's vectors are
cut into tiles. Two tiles are compared in runs of dimensions: what is
accumulated plus the product of the suffix norms bounds the cosine, and a pair that can no longer reach the threshold is
left. Survivors are decided in double precision on the original vectors.

Equal vectors are one entry with a multiplicity, so copies cost nothing. A tile pair gives counts of links
a vector, and a spanning forest of the links, never the pairs.

Defined cases: vectors null, empty, zero, or with a null or non-finite component link with nothing and stay as
components of their own; repeated rows of one id count as further vectors; a null id never names a component that has
others; vectors of different lengths have no cosine and never link, each length has axes of its own; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common as C

TILE, ROWS, RUN = 4096, 1024, 8
#: Rounding that the bound in single precision may have; decided pairs are computed anew in double precision.
SLACK = 1e-4


def _unpack(batch_column, n: int, kind=np.float64) -> np.ndarray:
    return np.frombuffer(b"".join(batch_column.to_pylist()), kind).reshape(n, -1)


def _moments(lengths: list[int]):
    """Per task and length: the matrix of sums of products of (1, unit vector)."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column(0).to_numpy(zero_copy_only=False)
            for d in lengths:
                own = b.column(1).filter(pa.array(dims == d))
                if len(own):
                    x = _unpack(own, len(own))
                    w = np.concatenate([np.ones((len(x), 1)), x / np.sqrt((x**2).sum(1))[:, None]], 1)
                    total[d] = w.T @ w + total.get(d, 0)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([m.tobytes() for m in total.values()], pa.binary())], names=["dims", "m"])

    return run


def _added(key, rows):
    total = sum(np.frombuffer(m) for m in rows["m"].to_pylist())
    return pa.table({"dims": pa.array([key[0].as_py()], pa.int32()), "m": pa.array([total.tobytes()], pa.binary())})


def axes(entries: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, int]]:
    """By length: principal axes (columns, leading first) of all unit vectors, deviations along them, and how many there are.

    Only lengths of more vectors than a tile holds have axes; the others are compared as they are, in one tile. The
    matrices, of dims squared numbers a task, are added up on the executors; one a length comes back.
    """
    lengths = [r["dims"] for r in entries.groupBy("dims").count().where(F.col("count") > TILE).collect()]
    if not lengths:
        return {}
    parts = entries.select("dims", "v").mapInArrow(_moments(lengths), "dims int, m binary").groupBy("dims").applyInArrow(_added, "dims int, m binary")
    out = {}
    for part in parts.collect():
        d = part["dims"] + 1
        total = np.frombuffer(bytes(part["m"])).reshape(d, d)
        mean = total[0, 1:] / total[0, 0]
        spread, turn = np.linalg.eigh(total[1:, 1:] / total[0, 0] - np.outer(mean, mean))
        out[part["dims"]] = turn[:, ::-1].copy(), np.sqrt(np.maximum(0, spread[::-1])), int(total[0, 0])
    return out


def _used(spread: np.ndarray, n: int, width: float) -> int:
    """How many axes make cells: those of more than three cells, as many as leave about a tile's neighbours."""
    cells_by_axis = np.maximum(1.0, 4 * spread / width)
    # an axis of three cells or fewer has only neighbours: it would cut tiles small and leave no pair out
    telling = int(np.argmin(np.append(cells_by_axis > 3, False)))
    return min(telling, 8, 1 + int(np.searchsorted(np.cumprod(cells_by_axis / 3), n / TILE)))


def compare(a: np.ndarray, b: np.ndarray, exact_a: np.ndarray, exact_b: np.ndarray, least: float, same: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) whose cosine reaches least. a, b: coordinates on principal axes.

    same: a and b are of one tile, and row 0 of a is row same of b; then only pairs with the first before the second.
    """
    d = a.shape[1]
    tail = lambda x: np.sqrt(np.maximum(0, np.cumsum((x.astype(np.float64) ** 2)[:, ::-1], 1)[:, ::-1])).astype(np.float32)
    ta, tb = tail(a), tail(b)
    lead = min(d, 2 * RUN)
    dots = a[:, :lead] @ b[:, :lead].T
    bound = dots + (np.outer(ta[:, lead], tb[:, lead]) if lead < d else 0)
    i, j = np.nonzero(bound >= least - SLACK)
    if same >= 0:
        i, j = i[i + same < j], j[i + same < j]
    acc = dots[i, j]
    for s in range(lead, d, RUN):
        e = min(d, s + RUN)
        acc = acc + (a[i, s:e] * b[j, s:e]).sum(1)
        ok = acc + (ta[i, e] * tb[j, e] if e < d else 0) >= least - SLACK
        i, j, acc = i[ok], j[ok], acc[ok]
    cos = np.concatenate([(exact_a[i[s : s + 100_000]] * exact_b[j[s : s + 100_000]]).sum(1) for s in range(0, len(i), 100_000)] or [np.zeros(0)])
    norms = np.sqrt((exact_a**2).sum(1)), np.sqrt((exact_b**2).sum(1))
    ok = cos / (norms[0][i] * norms[1][j]) >= least
    return i[ok], j[ok]


def _tile_pair(turns: dict[int, np.ndarray], least: float):
    """Links of two tiles, whose vectors are of one length."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        node, links, to = [], [], []
        for r in left.to_pylist():
            ids_a = np.frombuffer(r["ids"], np.int64)
            x = np.frombuffer(r["vs"]).reshape(len(ids_a), -1)
            for s in right.to_pylist():
                if s["pair2"] != r["pair"]:
                    continue
                same = s["tile2"] == r["tile"]
                ids_b = np.frombuffer(s["ids2"], np.int64)
                y = np.frombuffer(s["vs2"]).reshape(len(ids_b), -1)
                many_a, many_b = np.frombuffer(r["many"], np.int64), np.frombuffer(s["many2"], np.int64)
                p, q = (z / np.sqrt((z**2).sum(1))[:, None] for z in (x, y))
                turn = turns.get(x.shape[1])
                if turn is not None:
                    p, q = p @ turn, q @ turn
                p, q = p.astype(np.float32), q.astype(np.float32)
                got = [(i0, *compare(p[i0 : i0 + ROWS], q, x[i0 : i0 + ROWS], y, least, i0 if same else -1)) for i0 in range(0, len(x), ROWS)]
                i, j = np.concatenate([i0 + i for i0, i, _ in got]), np.concatenate([j for _, _, j in got])
                ca, cb = np.bincount(i, weights=many_b[j], minlength=len(x)), np.bincount(j, weights=many_a[i], minlength=len(y))
                up = {}

                def root(k):
                    while up.get(k, k) != k:
                        up[k] = up.get(up[k], up[k])
                        k = up[k]
                    return k

                forest: dict[int, list[int]] = {}
                for a, b in zip(ids_a[i].tolist(), ids_b[j].tolist(), strict=True):
                    ra, rb = root(a), root(b)
                    if ra != rb:
                        up[max(ra, rb)] = min(ra, rb)
                        forest.setdefault(a, []).append(b)
                for ids, c in ((ids_a, ca), (ids_b, cb)):
                    for k in np.flatnonzero(c):
                        node.append(int(ids[k]))
                        links.append(int(c[k]))
                        to.append(None)
                for a, near in forest.items():
                    for b in near:
                        node.append(a)
                        links.append(0)
                        to.append(b)
        return pa.table({"node": pa.array(node, pa.int64()), "links": pa.array(links, pa.int64()), "linked": pa.array(to, pa.int64())})

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors; links: cosine >= least."""
    from tidemark.llm.hnsw_search import valid

    spark = vectors.sparkSession
    C.prepare(spark)
    everything = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("embedding"))
    numbered = C.cut(everything.withColumn("row", F.monotonically_increasing_id()))
    good = valid(numbered, "row", "embedding").withColumnRenamed("id", "row")
    good = C.cut(good.withColumn("node", F.xxhash64("v")))
    entries = C.cut(good.groupBy("node").agg(F.count("*").alias("many"), F.min("v").alias("v")).withColumn("dims", (F.length("v") / 8).cast("int")))
    found = axes(entries)
    alone = numbered.select("row", "vec_id")
    width = float(np.sqrt(2 * (1 - least))) + 1e-6
    turns = {d: turn for d, (turn, _, _) in found.items()}
    cutting = {d: k for d, (_, spread, n) in found.items() if (k := _used(spread, n, width))}
    used = max(cutting.values(), default=0)

    def celled(batch: pa.RecordBatch) -> dict:
        dims = batch.column(3).to_numpy(zero_copy_only=False)
        cell = np.zeros((len(dims), 1 + used), int)  # of the length, then along its axes
        cell[:, 0] = dims
        for d, k in cutting.items():
            own = np.flatnonzero(dims == d)
            if len(own):
                x = _unpack(batch.column(2).take(pa.array(own)), len(own))
                cell[own, 1 : 1 + k] = np.floor((x / np.sqrt((x**2).sum(1))[:, None]) @ turns[d][:, :k] / width).astype(int)
        return {"node": batch.column(0), "many": batch.column(1), "v": batch.column(2), "cell": cell.tolist()}

    cells = C.map_arrow(entries.select("node", "many", "v", "dims"), celled, "node long, many long, v binary, cell array<int>")
    cells = C.cut(cells)
    loads = cells.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = cells.join(loads, "cell").withColumn("t", F.pmod(F.xxhash64("node", F.lit(3)), F.col("tiles")).cast("int"))

    def packed(key, batch):
        return pa.table({"cell": pa.array([key[0].as_py()], pa.list_(pa.int32())), "t": pa.array([key[1].as_py()], pa.int32()), "ids": pa.array([batch["node"].to_numpy().tobytes()], pa.binary()), "many": pa.array([batch["many"].to_numpy().tobytes()], pa.binary()), "vs": pa.array([b"".join(batch["v"].to_pylist())], pa.binary())})

    tiles = C.cut(tiled.groupBy("cell", "t").applyInArrow(packed, "cell array<int>, t int, ids binary, many binary, vs binary").withColumn("tile", F.xxhash64("cell", "t")))
    steps = np.stack(np.meshgrid([0], *[[-1, 0, 1]] * used, indexing="ij"), -1).reshape(-1, 1 + used)
    moves = F.array(*(F.array(*(F.lit(int(v)) for v in s)) for s in steps))
    names = tiles.select("cell", "tile")
    around = names.select("tile", F.explode(F.transform(moves, lambda s: F.zip_with(F.col("cell"), s, lambda a, b: a + b))).alias("cell"))
    pairs = around.join(names.withColumnRenamed("tile", "other"), "cell").where("tile <= other").select("tile", "other", F.xxhash64("tile", "other").alias("pair"))
    pairs = C.cut(pairs)
    body = tiles.select("tile", "ids", "many", "vs")
    left = pairs.select("tile", "pair").join(body, "tile").select(F.col("pair").alias("at"), "pair", "tile", "ids", "many", "vs")
    right = pairs.select(F.col("other").alias("tile"), "pair").join(body, "tile").select(*(F.col(c).alias(f"{c}2") for c in ("pair", "tile", "ids", "many", "vs")))
    found = C.cut(left.groupBy("at").cogroup(right.groupBy("pair2")).applyInArrow(_tile_pair(turns, least), "node long, links long, linked long"))

    links = found.where("linked is null").groupBy("node").agg(F.sum("links").alias("links"))
    comps = C.components(found.where("linked is not null").select("node", "linked"))
    rows = good.select("row", "node").join(entries.select("node", "many"), "node").join(links, "node", "left").join(comps, "node", "left")
    rows = rows.select("row", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    out = alone.join(rows, "row", "left")
    heads = out.where("component is not null").groupBy("component").agg(F.min("vec_id").alias("head"))
    out = out.join(heads, "component", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("head")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
