"""The per-batch write protocol of the stream.

Order: ledger 'bronze' -> silver (+ quarantine) -> file cells -> gold cells ->
gold hour_denorm -> serving; the ledger gets 'silver', 'gold' and 'done' as each
of them is written. Every data write
overwrites well-defined partitions and nothing is ever added to a stored
total, so running a batch twice, or resuming it after a crash at any point,
leaves the same tables as running it once:

* silver and file cells are partitioned ``(p_date, source_file)``: a file
  replaces only its own rows, and two files for the same day live side by side;
* gold cells / hour_denorm are partitioned by ``p_date`` and rebuilt for the
  dates the batch touched by folding those dates' file cells (a few rows per
  file and hour), never incremented and never re-reading trip rows;
* serving (24 rows) is recomputed from gold cells.

A replay changes rows that were there before, so it works by an intent record instead
(:mod:`tidemark.streaming.replay`).

Trip rows are read once (persisted for the batch) and written once (silver);
all other work is on aggregates bounded by days x 24 x zone ids.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import PICKUP, ntz, pickup_date
from tidemark.operators import gold, serving
from tidemark.operators import silver as silver_op
from tidemark.sinks import fs, publish
from tidemark.sinks.lake import (
    Lake,
    append,
    gold_paths,
    overwrite_partitions,
    publish_serving,
    read_dates,
    read_table,
    table_path,
)


class InjectedFailure(RuntimeError):
    """Raised by the ``fail_at`` test hook."""


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


@contextmanager
def _timed(timings: dict, stage: str):
    t0 = time.perf_counter()
    try:
        yield
    finally:
        timings[stage] = round(timings.get(stage, 0.0) + time.perf_counter() - t0, 3)


def stamp(files: DataFrame, lake: Lake, status: str, batch_id: int) -> None:
    """Append one event per file. ``files`` is a one-column DataFrame of names;
    the rest are literals, so everything stays in the JVM (no Python rows)."""
    events = files.select(
        F.col("source_file").alias("file_path"),
        F.lit(status).alias("status"),
        ntz(_now()).alias("ts"),
        F.lit(int(batch_id)).alias("batch_id"),
    )
    append(events.withColumn("p_day", F.to_date("ts")), lake, "ledger")


def file_names(spark: SparkSession, files: list[str]) -> DataFrame:
    """File names as the one-column frame that ``stamp`` takes."""
    return spark.createDataFrame([(f,) for f in files], "source_file string").coalesce(1)


def _pending_files(spark: SparkSession, lake: Lake) -> list[str]:
    return fs.glob(spark, f"{lake.root}/_pending/*.dates")


def pending_dates(spark: SparkSession, lake: Lake) -> set[_dt.date]:
    """Dates that a run noted and did not finish."""
    texts = (fs.read_text(spark, p) or "" for p in _pending_files(spark, lake))
    return {_dt.date.fromisoformat(d) for t in texts for d in t.split()}


def note_pending(spark: SparkSession, lake: Lake, dates) -> tuple[str, list[str]]:
    """Note dates durably before their rows change: (the new note, older ones that it covers)."""
    older = _pending_files(spark, lake)
    path = f"{lake.root}/_pending/{uuid.uuid4().hex}.dates"
    fs.write_text(spark, path, "\n".join(d.isoformat() for d in sorted(dates)))
    return path, older


def rebuild_gold(
    spark: SparkSession,
    lake: Lake,
    zones: DataFrame,
    dates: list[_dt.date],
    unpublished: Callable[[], None] = lambda: None,
) -> None:
    """Recompute gold cells, day_hours and hour_denorm for ``dates`` from their
    file cells.

    Only those dates' folders are listed and read. ``repartition('p_date')``
    on the (small) result gives one file per date and table; day_hours groups
    on ``p_date`` and so reuses that partitioning without another shuffle. The
    results are written beside the old ones and published together, so a reader
    never meets a date half done; ``unpublished`` is called just before (tests).
    """
    if not dates:
        return
    partials = read_dates(spark, lake, "file_cells", dates)
    cells = gold.fold_cells(partials).withColumn("p_date", F.col("date")).repartition("p_date")
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        version = publish.new_version()

        def write(rows: DataFrame, name: str) -> None:
            overwrite_partitions(rows, lake, name, f"{table_path(lake, name)}/v={version}")

        write(cells, "cells")
        write(gold.day_hour_by_partition(cells), "day_hours")
        # with a broadcast zone join this repartition is already satisfied and dropped
        denorm = gold.hour_denorm(cells, zones).repartition("p_date").persist(StorageLevel.MEMORY_AND_DISK)
        # a cell whose sum the contract's type cannot hold is set aside, exact, and stops nothing
        write(denorm.where(gold.fits()), "hour_denorm")
        write(denorm.where(~gold.fits()), "overflow")
        # each table loses the dates its own result lacks (no cells, or none with a zone)
        held = {r[0] for r in cells.select("p_date").distinct().collect()}
        kinds = denorm.groupBy("p_date").agg(F.max(gold.fits()).alias("named"), F.max(~gold.fits()).alias("beyond")).collect()
        kept = {"cells": held, "day_hours": held, "hour_denorm": {r["p_date"] for r in kinds if r["named"]}, "overflow": {r["p_date"] for r in kinds if r["beyond"]}}
        denorm.unpersist()
        unpublished()
        publish.publish(spark, lake.published, gold_paths(lake), version, dates, kept)
    finally:
        cells.unpersist()


def refresh_serving(spark: SparkSession, lake: Lake) -> None:
    """Recompute the 24 serving rows from day_hours (24 rows per date)."""
    publish_serving(spark, lake, serving.serving_table(spark, read_table(spark, lake, "day_hours")))


def counted(typed: DataFrame) -> list:
    """One small action: rows by (file, day, whether good). Bounded by files x days."""
    return typed.groupBy("source_file", pickup_date(PICKUP).alias("d"), F.col("reason").isNull().alias("ok")).count().collect()


def file_cells_of(silver: DataFrame) -> DataFrame:
    """Cells per file: aggregated first (map-side partial), then one task per (date, file) leaf;
    the shuffle carries cells, never trip rows, and each leaf gets one file."""
    return gold.cells(silver, extra_keys=("p_date", "source_file")).repartition("p_date", "source_file")


def process_batch(
    rows: DataFrame,
    batch_id: int,
    lake: Lake,
    zones: DataFrame,
    files: list[str],
    raw: DataFrame | None = None,
    fail_at: str | None = None,
) -> dict:
    """Write one batch of typed rows (``schemas.TYPED``) of new files through all layers.

    ``files`` names the batch's files, so that one without rows is handled too. ``raw``
    is a copy of every column to keep, partitioned by source file (K1). ``fail_at``
    ('silver' or 'gold') raises after that stage, to test crash recovery.

    Dates are noted in the lake before anything of theirs is removed and stay
    noted until serving is written; every batch also rebuilds the dates noted by
    one that did not end, so a crash at any point is mended by the next run.
    """
    spark = rows.sparkSession
    tm: dict[str, float] = {}
    if raw is not None:
        with _timed(tm, "bronze"):
            overwrite_partitions(raw, lake, "bronze")
    typed = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with _timed(tm, "scan"):
            pairs = counted(typed)
        files = sorted(files)
        unfinished = pending_dates(spark, lake)
        if not files and not unfinished:
            return {"batch_id": batch_id, "files": [], "dates": [], "rows": 0, "rejected": 0, "timings": tm}
        n_rows = sum(r["count"] for r in pairs)
        n_rejected = sum(r["count"] for r in pairs if not r["ok"])
        names = file_names(spark, files)
        with _timed(tm, "ledger"):
            stamp(names, lake, "bronze", batch_id)

        dates = {r["d"] for r in pairs if r["ok"]} | unfinished
        note = note_pending(spark, lake, dates)
        valid = silver_op.typed_silver(typed)
        with _timed(tm, "silver"):
            overwrite_partitions(valid, lake, "silver")
        with _timed(tm, "quarantine"):
            if n_rejected:
                overwrite_partitions(silver_op.typed_rejects(typed), lake, "quarantine")
        with _timed(tm, "file_cells"):
            overwrite_partitions(file_cells_of(valid), lake, "file_cells")
        with _timed(tm, "ledger"):
            stamp(names, lake, "silver", batch_id)
        if fail_at == "silver":
            raise InjectedFailure("injected failure after the silver write")

        dates = sorted(dates)
        with _timed(tm, "gold"):
            rebuild_gold(spark, lake, zones, dates)
        with _timed(tm, "ledger"):
            stamp(names, lake, "gold", batch_id)
        if fail_at == "gold":
            raise InjectedFailure("injected failure after the gold write")

        with _timed(tm, "serving"):
            refresh_serving(spark, lake)
        for path in [*note[1], note[0]]:
            fs.delete(spark, path)
        with _timed(tm, "ledger"):
            stamp(names, lake, "done", batch_id)
        return {
            "batch_id": batch_id,
            "files": files,
            "dates": [d.isoformat() for d in dates],
            "rows": n_rows,
            "rejected": n_rejected,
            "timings": tm,
        }
    finally:
        typed.unpersist()
