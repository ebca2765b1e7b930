"""A stored additive table (K5, A9): totals by key that batches add to, each batch counted once.

A batch's totals are its own folder, so a batch that is sent again replaces itself instead of adding twice; a read sums
all of them by key. Compaction folds batches into a new base and publishes, by one small pointer file, the base and the
ids that it holds: a batch of those ids that comes again is refused, and readers leave out its folder. Nothing that a reader
of the pointer before may hold is removed until the next compaction.

    <root>/batches/batch=<id>/     one batch's totals, published by a rename
    <root>/bases/base=<version>/   folded totals
    <root>/_pointer/<version>.json base and ranges of folded ids
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import wide_sum
from tidemark.schemas import WIDE
from tidemark.sinks import fs


@dataclass(frozen=True)
class AdditiveTable:
    """``keys`` are the key columns' fields, ``value`` the summed column (stored as DECIMAL(38,2))."""

    root: str
    keys: tuple[T.StructField, ...]
    value: str

    @property
    def schema(self) -> T.StructType:
        return T.StructType([*self.keys, T.StructField(self.value, WIDE)])

    @property
    def names(self) -> list[str]:
        return [k.name for k in self.keys]


def _folder(table: AdditiveTable, batch_id: int) -> str:
    return f"{table.root}/batches/batch={batch_id}"


def _pointers(spark: SparkSession, table: AdditiveTable) -> list[str]:
    return fs.glob(spark, f"{table.root}/_pointer/[0-9]*.json")


def _state(spark: SparkSession, table: AdditiveTable) -> dict:
    """The newest pointer: the base's folder and the closed ranges of ids in it."""
    while found := _pointers(spark, table):
        text = fs.read_text(spark, found[-1])
        if text is not None:  # else a compaction has just removed it for a newer one
            return json.loads(text)
    return {"base": None, "folded": [], "replaced": []}


def _is_folded(state: dict, batch_id: int) -> bool:
    return any(lo <= batch_id <= hi for lo, hi in state["folded"])


def _ranges(state: dict, ids: list[int]) -> list[list[int]]:
    """The folded ranges with these ids added; neighbours join, so ids without gaps are one range."""
    out: list[list[int]] = []
    for lo, hi in sorted([*map(tuple, state["folded"]), *((i, i) for i in ids)]):
        if out and lo <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _totals(table: AdditiveTable, rows: DataFrame) -> DataFrame:
    return rows.groupBy(*table.names).agg(wide_sum(table.value).alias(table.value)).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema))


def add(table: AdditiveTable, rows: DataFrame, batch_id: int) -> bool:
    """Add a batch's rows. Sent again it replaces itself; False (and nothing done) if it is in the base already.

    The shuffle carries totals by key. A stop before the rename leaves the table as it was.
    """
    spark = rows.sparkSession
    if batch_id < 0:
        raise ValueError(f"{batch_id} is no batch id")
    if _is_folded(_state(spark, table), batch_id):
        return False
    aside = f"{table.root}/_aside/{uuid.uuid4().hex}"
    _totals(table, rows).write.parquet(aside)
    target = _folder(table, batch_id)
    fs.mkdirs(spark, f"{table.root}/batches")
    fs.delete(spark, target)
    if not fs.rename(spark, aside, target):
        raise OSError(f"{target} could not be published")
    return True


def sink(table: AdditiveTable):
    """For ``foreachBatch``: every micro-batch counts once, however often Spark runs it."""
    return lambda rows, batch_id: add(table, rows, batch_id) and None


def _waiting(spark: SparkSession, table: AdditiveTable, state: dict) -> dict[int, str]:
    """Folders of the batches that the base does not hold."""
    found = {int(p.rsplit("=", 1)[1]): p for p in fs.glob(spark, f"{table.root}/batches/batch=*")}
    return {i: p for i, p in found.items() if not _is_folded(state, i)}


def _parts(spark: SparkSession, table: AdditiveTable, state: dict, batches: dict[int, str]) -> DataFrame:
    paths = [*([state["base"]] if state["base"] else []), *batches.values()]
    return spark.read.schema(table.schema).parquet(*paths) if paths else spark.createDataFrame([], table.schema)


def read(spark: SparkSession, table: AdditiveTable) -> DataFrame:
    """The totals by key over everything added."""
    state = _state(spark, table)
    return _totals(table, _parts(spark, table, state, _waiting(spark, table, state)))


def compact(spark: SparkSession, table: AdditiveTable) -> int:
    """Fold all batches into a new base; how many there were. One compaction at a time.

    A stop before the pointer is published changes nothing for readers; the base it left goes with the next one.
    """
    state = _state(spark, table)
    batches = _waiting(spark, table, state)
    if not batches:
        return 0
    found = _pointers(spark, table)
    last = int(found[-1].rsplit("/", 1)[1].removesuffix(".json")) if found else 0
    version = f"{max(time.time_ns(), last + 1):020d}"
    base = f"{table.root}/bases/base={version}"
    _totals(table, _parts(spark, table, state, batches)).write.parquet(base)
    replaced = [*batches.values(), *([state["base"]] if state["base"] else [])]
    aside = f"{table.root}/_pointer/aside-{uuid.uuid4().hex}"
    fs.write_text(spark, aside, json.dumps({"base": base, "folded": _ranges(state, list(batches)), "replaced": replaced}))
    if not fs.rename(spark, aside, f"{table.root}/_pointer/{version}.json"):
        raise OSError("the pointer of the additive table could not be published")
    kept = {base.rsplit("/", 1)[1], (state["base"] or "").rsplit("/", 1)[-1]}
    stray = [p for p in fs.glob(spark, f"{table.root}/bases/base=*") if p.rsplit("/", 1)[1] not in kept]
    for path in [*state["replaced"], *stray, *found[:-1], *fs.glob(spark, f"{table.root}/_aside/*")]:
        fs.delete(spark, path)
    return len(batches)
