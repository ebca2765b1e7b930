"""Replays that recover by themselves (M5, M6).

A replay replaces what files contributed before: rows on dates that the new content may no longer have. It first
writes the new leaves into a staging folder, touching nothing; then an intent record names all it will do (files, dates
old and new, the old leaves without a successor), published by one rename. From there on it is carried out from the
record and the staging folder alone: the staged leaves move into place, the old ones go, the dates are rebuilt, serving
is published, and only then the record is removed. Every step can be done again, so a stop after any of them is mended
by whatever runs next, a tick without files included (:func:`recover`); a stop before the record leaves the lake as it was.

The record and the moves are bounded by the leaves of the replayed files (files x days).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import plain_path
from tidemark.operators import silver as silver_op
from tidemark.sinks import fs
from tidemark.sinks.lake import Lake, overwrite_partitions, read_table, table_path
from tidemark.streaming.batch import InjectedFailure, counted, file_cells_of, file_names, rebuild_gold, refresh_serving, stamp

#: Tables that a replay replaces by leaf, with the depth of a leaf.
LEAVES = {"silver": "p_date=*/source_file=*", "file_cells": "p_date=*/source_file=*", "quarantine": "source_file=*", "bronze": "source_file=*"}
#: Points where a stop can be injected: after each write.
POINTS = ("staged", "intent", "first_leaf", "leaves", "stale", "silver", "unpublished", "gold", "serving", "cleared")


def _leaf_dirs(table: DataFrame, files: list[str]) -> list[tuple[str, str]]:
    """(file, leaf folder) of the given source files. Bounded by files x days."""
    leaf = F.regexp_replace(plain_path("_metadata.file_path"), "/[^/]+$", "").alias("leaf")
    return [tuple(r) for r in table.where(F.col("source_file").isin(files)).select("source_file", leaf).distinct().collect()]


def _tail(path: str, table: str) -> str:
    """The partition folders at the end of a leaf's path."""
    return "/".join(path.rstrip("/").split("/")[-(LEAVES[table].count("/") + 1) :])


def _intents(spark: SparkSession, lake: Lake) -> list[str]:
    return fs.glob(spark, f"{lake.replays}/*.intent")


def replay(spark: SparkSession, rows: DataFrame, raw: DataFrame | None, files: list[str], lake: Lake, zones: DataFrame, batch_id: int = -1, fail_at: str | None = None) -> dict:
    """Replace what these files contributed by these typed rows (``schemas.TYPED``)."""
    if fail_at is not None and fail_at not in POINTS:
        raise ValueError(f"{fail_at!r} is none of {POINTS}")
    key = uuid.uuid4().hex
    stage = f"{lake.replays}/{key}"
    typed = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pairs = counted(typed)
        stamp(file_names(spark, files), lake, "bronze", batch_id)
        valid = silver_op.typed_silver(typed)
        overwrite_partitions(valid, lake, "silver", f"{stage}/silver")
        overwrite_partitions(file_cells_of(valid), lake, "file_cells", f"{stage}/file_cells")
        overwrite_partitions(silver_op.typed_rejects(typed), lake, "quarantine", f"{stage}/quarantine")
        if raw is not None:
            overwrite_partitions(raw, lake, "bronze", f"{stage}/bronze")
    finally:
        typed.unpersist()
    _stop(fail_at, "staged")
    new = {t: {_tail(p, t) for p in fs.glob(spark, f"{stage}/{t}/{LEAVES[t]}")} for t in LEAVES}
    stale, dates = [], {r["d"].isoformat() for r in pairs if r["ok"]}
    for table in LEAVES:
        if table == "bronze" and raw is None:
            continue
        for _, leaf in _leaf_dirs(read_table(spark, lake, table), files):
            tail = _tail(leaf, table)
            if tail.startswith("p_date="):
                dates.add(tail[len("p_date=") :].split("/")[0])
            if tail not in new[table]:
                stale.append(f"{table_path(lake, table)}/{tail}")
    record = {"files": files, "dates": sorted(dates), "stale": stale, "batch_id": batch_id}
    fs.write_text(spark, f"{stage}/intent", json.dumps(record))
    if not fs.rename(spark, f"{stage}/intent", f"{lake.replays}/{key}.intent"):
        raise OSError(f"the intent of replay {key} could not be published")
    _stop(fail_at, "intent")
    carry_out(spark, lake, zones, f"{lake.replays}/{key}.intent", fail_at)
    n = {ok: sum(r["count"] for r in pairs if r["ok"] == ok) for ok in (True, False)}
    return {"batch_id": batch_id, "files": files, "dates": record["dates"], "rows": n[True] + n[False], "rejected": n[False], "timings": {}}


def _stop(fail_at: str | None, point: str) -> None:
    if fail_at == point:
        raise InjectedFailure(f"injected failure after {point}")


def carry_out(spark: SparkSession, lake: Lake, zones: DataFrame, intent: str, fail_at: str | None = None) -> None:
    """Do, or do again, all that an intent record says, and remove it."""
    record = json.loads(fs.read_text(spark, intent))
    stage = intent.removesuffix(".intent")
    names = file_names(spark, record["files"])
    for table, depth in LEAVES.items():
        for leaf in fs.glob(spark, f"{stage}/{table}/{depth}"):
            target = f"{table_path(lake, table)}/{_tail(leaf, table)}"
            fs.delete(spark, target)  # a leaf still staged has not moved yet: what is there is the old one
            fs.mkdirs(spark, target.rsplit("/", 1)[0])
            if not fs.rename(spark, leaf, target):
                raise OSError(f"{leaf} could not be moved to {target}")
            _stop(fail_at, "first_leaf")
    _stop(fail_at, "leaves")
    for leaf in record["stale"]:
        fs.delete(spark, leaf)
    _stop(fail_at, "stale")
    stamp(names, lake, "silver", record["batch_id"])
    _stop(fail_at, "silver")
    rebuild_gold(spark, lake, zones, [_dt.date.fromisoformat(d) for d in record["dates"]], lambda: _stop(fail_at, "unpublished"))
    stamp(names, lake, "gold", record["batch_id"])
    _stop(fail_at, "gold")
    refresh_serving(spark, lake)
    _stop(fail_at, "serving")
    stamp(names, lake, "done", record["batch_id"])
    fs.delete(spark, intent)
    _stop(fail_at, "cleared")
    fs.delete(spark, stage)


def recover(spark: SparkSession, lake: Lake, zones: DataFrame) -> int:
    """Carry out the replays that stopped after their record, clear what others staged; how many were carried out.

    One listing where there are none. Called before every tick, batch and replay.
    """
    found = _intents(spark, lake)
    for intent in found:
        carry_out(spark, lake, zones, intent)
    for left in fs.glob(spark, f"{lake.replays}/*"):
        fs.delete(spark, left)
    return len(found)
