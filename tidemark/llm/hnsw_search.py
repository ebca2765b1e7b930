"""Nearest neighbours by inner product: a hierarchical navigable small-world graph per shard, as flat arrays.

Equal vectors are one entry of the index, with their smallest ids (as many as an answer can hold), so copies do not
crowd a graph. Distinct vectors go to shards of about SHARD by hash; each shard's graph is built in one task and stored as
a row: ids, vectors, levels, and one flat neighbour array a level. Inner product becomes Euclidean distance by one further
coordinate, sqrt(longest^2 - |x|^2). Queries go to every shard in blocks of QUERY_BLOCK; a task holds one shard and one
block, and gives each query its best of the shard, scored in double precision on the original vectors. The merge keeps
the best of all shards.

Recall against brute force is measured in tests. Defined cases: vectors null, empty of numbers, zero, or with a null or
non-finite component neither ask nor are found; fewer candidates than k give all; ties go to the smaller id; repeated rows
of one id are found once; vectors of another length than the query's have no inner product with it and are not found (a
shard holds vectors of one length); further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm import common as C

SHARD, QUERY_BLOCK = 8192, 4096
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 64, 128


class Graph:
    """vectors: (n, d) float32 in the space of Euclidean distance."""

    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.x = vectors
        self.sq = (vectors.astype(np.float64) ** 2).sum(1).astype(np.float32)
        n = len(vectors)
        self.level = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int), 8)
        self.links = [np.full((n, 2 * LINKS), -1, np.int32)]
        self.upper: list[dict[int, list[int]]] = [{} for _ in range(9)]
        self.count = np.zeros(n, np.int32)
        self.entry, self.top = 0, int(self.level[0]) if n else 0
        for i in range(n):
            self._insert(i)

    def _far(self, q: np.ndarray, ids) -> np.ndarray:
        return self.sq[ids] - 2 * (self.x[ids] @ q)

    def _near(self, i: int, level: int):
        return self.links[0][i, : self.count[i]] if level == 0 else self.upper[level].get(i, [])

    def search(self, q: np.ndarray, entries: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The width nearest that a best-first walk finds, nearest first."""
        seen = np.zeros(len(self.x), bool)
        seen[[i for _, i in entries]] = True
        todo = list(entries)
        heapq.heapify(todo)
        best = [(-d, i) for d, i in entries]
        heapq.heapify(best)
        while todo:
            d, i = heapq.heappop(todo)
            if d > -best[0][0] and len(best) >= width:
                break
            near = np.asarray(self._near(i, level), np.int64)
            near = near[~seen[near]]
            if not len(near):
                continue
            seen[near] = True
            far = self._far(q, near)
            if len(best) >= width:
                ok = far < -best[0][0]
                near, far = near[ok], far[ok]
            for e, j in zip(far.tolist(), near.tolist(), strict=True):
                if len(best) < width or e < -best[0][0]:
                    heapq.heappush(todo, (e, j))
                    heapq.heappush(best, (-e, j))
                    if len(best) > width:
                        heapq.heappop(best)
        return sorted((-d, i) for d, i in best)

    def _descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        at = [(float(self._far(q, np.array([self.entry]))[0]), self.entry)]
        for level in range(self.top, to, -1):
            at = self.search(q, at, 1, level)
        return at

    def _choose(self, found: list[tuple[float, int]], most: int, own: float) -> list[int]:
        """Spread neighbours: one that is nearer to a chosen one than to the node waits; gaps are filled in order.

        found holds distances less the node's own square, own.
        """
        ids = np.array([j for _, j in found])
        if len(ids) <= most:
            return ids.tolist()
        sub = self.x[ids]
        sq = self.sq[ids]
        apart = sq[:, None] + sq[None] - 2 * (sub @ sub.T)
        mine = np.array([d for d, _ in found]) + own
        chosen: list[int] = []
        blocked = np.zeros(len(ids), bool)
        for k in range(len(ids)):
            if not blocked[k]:
                chosen.append(k)
                if len(chosen) == most:
                    break
                blocked |= apart[k] < mine
        for k in range(len(ids)):
            if len(chosen) == most:
                break
            if k not in chosen:
                chosen.append(k)
        return ids[chosen].tolist()

    def _connect(self, i: int, near: list[int], level: int) -> None:
        most = 2 * LINKS if level == 0 else LINKS
        if level == 0:
            self.links[0][i, : len(near)] = near
            self.count[i] = len(near)
        else:
            self.upper[level][i] = list(near)
        for j in near:
            if level == 0 and self.count[j] < most:
                self.links[0][j, self.count[j]] = i
                self.count[j] += 1
                continue
            theirs = [*self._near(j, level), i]
            if len(theirs) > most:
                d = self._far(self.x[j], np.array(theirs))
                theirs = self._choose(sorted(zip(d.tolist(), map(int, theirs), strict=True)), most, float(self.sq[j]))
            if level == 0:
                self.links[0][j, : len(theirs)] = theirs
                self.count[j] = len(theirs)
            else:
                self.upper[level][j] = [int(t) for t in theirs]

    def _insert(self, i: int) -> None:
        mine = int(self.level[i])
        if i == 0:
            for level in range(1, mine + 1):
                self.upper[level][0] = []
            return
        q = self.x[i]
        at = self._descend(q, min(mine, self.top))
        for level in range(min(mine, self.top), -1, -1):
            at = self.search(q, at, BUILD_WIDTH, level)
            self._connect(i, self._choose(at, LINKS, float(self.sq[i])), level)
        for level in range(self.top + 1, mine + 1):
            self.upper[level][i] = []
        if mine > self.top:
            self.entry, self.top = i, mine

    def flat(self) -> dict:
        """The graph as flat arrays: level 0 as (counts, neighbours), upper levels as (level, node, neighbour) triples."""
        up = [(lv, i, j) for lv, nodes in enumerate(self.upper) for i, near in nodes.items() for j in near]
        return {"counts": self.count.tobytes(), "neighbours": self.links[0].tobytes(), "upper": np.array(up, np.int32).tobytes(), "entry": self.entry, "top": self.top}

    @classmethod
    def load(cls, vectors: np.ndarray, flat: dict) -> Graph:
        g = cls.__new__(cls)
        g.x, g.sq = vectors, (vectors.astype(np.float64) ** 2).sum(1).astype(np.float32)
        g.count = np.frombuffer(flat["counts"], np.int32)
        g.links = [np.frombuffer(flat["neighbours"], np.int32).reshape(len(vectors), 2 * LINKS)]
        g.upper = [{} for _ in range(9)]
        for lv, i, j in np.frombuffer(flat["upper"], np.int32).reshape(-1, 3).tolist():
            g.upper[lv].setdefault(i, []).append(j)
        g.entry, g.top = flat["entry"], flat["top"]
        return g


def _lifted(x: np.ndarray) -> np.ndarray:
    sq = (x**2).sum(1)
    return np.concatenate([x, np.sqrt(np.maximum(0, sq.max() - sq))[:, None]], 1).astype(np.float32)


def _vectors(column: pa.ChunkedArray, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(n, -1)


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v (components as doubles, in bytes) of the rows whose vector takes part."""
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vector_col].cast("array<double>").alias("v")).where("id is not null and v is not null and size(v) > 0")
    rows = rows.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))

    def packed(batch: pa.RecordBatch) -> dict:
        lists = batch.column(1)
        flat, at = np.asarray(lists.flatten(), np.float64), np.asarray(lists.offsets)
        at = at - at[0]
        return {"id": batch.column(0), "v": [flat[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]}

    return C.map_arrow(rows, packed, "id long, v binary")


def _dims():
    return (F.length("v") / 8).cast("int")


def _place(shard: str):
    return F.col("dims").cast("long") * 2**31 + F.col(shard)


def _build(table: pa.Table) -> pa.Table:
    table = table.sort_by("first")
    x = _vectors(table["v"], table.num_rows)
    g = Graph(_lifted(x))
    return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int32()), "ids": pa.array([table["ids"].to_pylist()], pa.list_(pa.list_(pa.int64()))), "vectors": pa.array([x.tobytes()], pa.binary()), "dims": pa.array([x.shape[1]], pa.int32()), **{k: pa.array([v], pa.int32() if isinstance(v, int) else pa.binary()) for k, v in g.flat().items()}})


def _search(k: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out: list = []
        if index.num_rows and queries.num_rows:
            row = index.to_pylist()[0]
            x = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dims"])
            g = Graph.load(_lifted(x), row)
            q = _vectors(queries["v"], queries.num_rows)
            for me, v in zip(queries["id"].to_pylist(), q, strict=True):
                lifted = np.append(v, 0).astype(np.float32)
                found = np.array([i for _, i in g.search(lifted, g._descend(lifted, 0), max(SEARCH_WIDTH, 2 * k), 0)])
                exact = (x[found] * v).sum(1)
                hits, floor = 0, np.inf
                for i in np.argsort(-exact, kind="stable"):
                    if hits >= k and exact[i] < floor:
                        break
                    for other in row["ids"][found[i]]:
                        if other != me:
                            out.append((me, other, float(exact[i])))
                            hits += 1
                    floor = exact[i]
        return pa.table({"query_id": pa.array([r[0] for r in out], pa.int64()), "vec_id": pa.array([r[1] for r in out], pa.int64()), "score": pa.array([r[2] for r in out], pa.float64())})

    return run


def index(vectors: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row a shard: ids (of each distinct vector, the k + 1 smallest: an answer holds no more), vectors, graph."""
    rows = valid(vectors, id_col, vector_col).distinct()
    few = rows.withColumn("place", F.row_number().over(W.partitionBy("v").orderBy("id"))).where(F.col("place") <= k + 1)
    entries = C.cut(few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")))
    entries = entries.withColumn("dims", _dims())
    shards = entries.groupBy("dims").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))  # a row for each length
    placed = entries.join(shards, "dims").withColumn("shard", F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")).withColumn("first", F.col("ids")[0])
    # one key, not (dims, shard): the join's partitioning by dims would do for both and put all shards in one task
    built = placed.withColumn("place", _place("shard")).groupBy("place").applyInArrow(_build, "shard int, ids array<array<long>>, vectors binary, dims int, counts binary, neighbours binary, upper binary, entry int, top int")
    return C.cut(built)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query row among all other ids."""
    C.prepare(vectors.sparkSession)
    graphs = index(vectors, k, id_col, vector_col)
    asked = C.cut(valid(queries, id_col, vector_col).distinct())
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    last = graphs.groupBy("dims").agg(F.max("shard").alias("last"))
    sent = asked.withColumn("dims", _dims()).join(last, "dims").select("dims", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("at"), "block", "id", "v").withColumn("place", _place("at"))
    held = graphs.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = held.withColumn("place", _place("shard")).groupBy("place", "b").cogroup(sent.groupBy("place", "block")).applyInArrow(_search(k), "query_id long, vec_id long, score double")
    best = found.distinct().withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
