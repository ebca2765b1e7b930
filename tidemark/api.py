"""Consumer API: migrate, run_etl, replay, reset, and the two
read calls ``total_revenue(d, h)`` and ``avg_revenue(h)``.

Every scalar call has a DataFrame form (``*_df``) that stays lazy and
distributed; the scalar form collects a single row.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import audit, gold, ledger, serving
from tidemark.sinks import catalog, publish
from tidemark.sinks import lake as lake_mod
from tidemark.sinks.lake import Lake, read_dates, read_table
from tidemark.sources.zones import as_zones, read_zones_csv
from tidemark.streaming.batch import pending_dates
from tidemark.streaming import retry
from tidemark.streaming.ingest import TickReport, replay_files, run_ingest, start_ingest
from tidemark.streaming.retry import RetryReport


def _zones(spark: SparkSession, zones) -> DataFrame:
    """Zone dimension from a CSV path or a DataFrame with LocationID and Zone."""
    if isinstance(zones, str):
        return as_zones(read_zones_csv(spark, zones))
    if "zone" in zones.columns and "Zone" not in zones.columns:
        return zones.select(F.col("LocationID").cast("int").alias("LocationID"), "zone")
    return as_zones(zones)


def migrate(spark: SparkSession, root: str) -> list[str]:
    """Create absent tables (idempotent; never clears live data)."""
    return lake_mod.migrate(spark, Lake(root))


def run_etl(
    spark: SparkSession,
    landing: str,
    root: str,
    zones,
    max_files_per_trigger: int | None = 50,
    archive: bool = False,
    bronze: bool = False,
) -> TickReport:
    """One tick: ingest every new file in ``landing`` into the lake at ``root``."""
    return run_ingest(
        spark,
        landing,
        Lake(root),
        _zones(spark, zones),
        max_files_per_trigger=max_files_per_trigger,
        archive=archive,
        bronze=bronze,
    )


def start_etl(spark: SparkSession, landing: str, root: str, zones, interval: str = "60 seconds", **kw):
    """Long-running ingest with a fixed cadence; returns the StreamingQuery."""
    return start_ingest(spark, landing, Lake(root), _zones(spark, zones), interval=interval, **kw)


def replay(spark: SparkSession, root: str, paths: list[str], zones) -> dict:
    """Re-ingest files whose content changed under a name already taken."""
    return replay_files(spark, paths, Lake(root), _zones(spark, zones))


def retry_stuck(spark: SparkSession, root: str, landing: str, zones, **kw) -> RetryReport:
    """Try files that got stuck or were set aside once more, between ticks (see :mod:`tidemark.streaming.retry`)."""
    return retry.retry_stuck(spark, landing, Lake(root), _zones(spark, zones), **kw)


def reset(spark: SparkSession, root: str) -> None:
    """Truncate every table (schemas kept) and forget which files were taken."""
    lake_mod.reset(spark, Lake(root))
    _SERVING_CACHE.pop(root, None)


def compact_ledger(spark: SparkSession, root: str, before) -> int:
    """One file per ledger day for days before ``before`` (housekeeping)."""
    return lake_mod.compact_ledger(spark, Lake(root), before)


def hour_denorm_df(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, Lake(root), "hour_denorm")


def total_revenue_df(spark: SparkSession, root: str, d, h: int, zone: str | None = None) -> DataFrame:
    """One-row DataFrame ``(date, hour, total_revenue)``. Only the date's folder
    is looked up and read, however many dates the table holds; cells set aside as
    too large for the table's type count too."""
    day, lake = serving.as_date(d), Lake(root)
    pointer = publish.current(spark, lake.published)
    cells = read_dates(spark, lake, "hour_denorm", [day], pointer=pointer)
    if pointer and day.isoformat() in pointer["dates"]["overflow"]:
        cells = cells.unionByName(read_dates(spark, lake, "overflow", [day], pointer=pointer))
    return serving.cell_total(cells, day, h, zone=zone)


def total_revenue(spark: SparkSession, root: str, d, h: int, zone: str | None = None) -> float:
    """Revenue of hour ``h`` on day ``d`` over all zones (or one zone); 0.0 if none."""
    return float(total_revenue_df(spark, root, d, h, zone).first()["total_revenue"])


def serving_df(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, Lake(root), "serving")


def avg_revenue_df(spark: SparkSession, root: str) -> DataFrame:
    return serving_df(spark, root).select("hour", "avg_revenue")


def hourly_revenue_df(spark: SparkSession, root: str) -> DataFrame:
    """Cumulative revenue per hour of day (the serving table's ``revenue``)."""
    return serving_df(spark, root).select("hour", "revenue")


#: Per lake root: the version read last and its 24 rows. A look for a newer version
#: is one listing, so a lookup takes milliseconds instead of a Spark job per call.
_SERVING_CACHE: dict[str, tuple[str | None, dict[int, dict]]] = {}
_LOCK = threading.Lock()


def _serving_rows(spark: SparkSession, root: str) -> dict[int, dict]:
    version = lake_mod.serving_version(spark, Lake(root))
    version_read, rows = _SERVING_CACHE.get(root, (None, {}))
    if rows and version_read == version:
        return rows
    with _LOCK:
        rows = {r["hour"]: r.asDict() for r in serving_df(spark, root).collect()}
        _SERVING_CACHE[root] = (version, rows)
    return rows


def avg_revenue(spark: SparkSession, root: str, h: int) -> float:
    """Average hourly revenue for hour-of-day ``h`` over all days seen.

    Raises ``ValueError`` for an hour outside 0..23 and ``LookupError`` when the
    serving table has no row for the hour (not migrated).
    """
    serving.check_hour(h)
    rows = _serving_rows(spark, root)
    if h not in rows:
        raise LookupError(f"no serving row for hour {h}; run migrate first")
    return float(rows[h]["avg_revenue"])


def cumulative_revenue(spark: SparkSession, root: str, h: int) -> float:
    """Cumulative revenue of hour-of-day ``h`` (what the serving store held)."""
    serving.check_hour(h)
    rows = _serving_rows(spark, root)
    if h not in rows:
        raise LookupError(f"no serving row for hour {h}; run migrate first")
    return float(rows[h]["revenue"])


def overflow_df(spark: SparkSession, root: str) -> DataFrame:
    """Cells of (zone, date, hour) whose revenue DECIMAL(18,2) cannot hold, exact."""
    return read_table(spark, Lake(root), "overflow")


def unmatched_zones_df(spark: SparkSession, root: str, zones) -> DataFrame:
    """Zone ids present in trips but absent from the zone table, with revenue."""
    return gold.unmatched(read_table(spark, Lake(root), "cells"), _zones(spark, zones))


def reconcile_df(spark: SparkSession, root: str, zones) -> DataFrame:
    """all = matched + unmatched over the stored gold cells."""
    return gold.reconcile(read_table(spark, Lake(root), "cells"), _zones(spark, zones))


def audit_df(spark: SparkSession, root: str, zones, dates=None) -> DataFrame:
    """Per step and date: does each stored table, silver to serving, hold what the one before it gives?

    ``pending`` marks dates that a run noted and has not finished: there a step may be behind.
    """
    lake = Lake(root)
    noted = sorted(pending_dates(spark, lake))
    return audit.chain(spark, lake, _zones(spark, zones), dates).withColumn("pending", F.coalesce(F.col("date").isin(noted), F.lit(bool(noted))))


def external_table(spark: SparkSession, root: str, table: str) -> None:
    """Create the silver folder's table in the session's catalog, or bring its partitions up to date."""
    catalog.silver_table(spark, Lake(root), table)


def quarantine_df(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, Lake(root), "quarantine")


def ledger_status_df(spark: SparkSession, root: str) -> DataFrame:
    return ledger.latest_status(read_table(spark, Lake(root), "ledger"), failed=ledger.FAILED)


def ledger_stage_times_df(spark: SparkSession, root: str) -> DataFrame:
    """Per file: status, attempts and the last time of each stage."""
    return ledger.stage_times(read_table(spark, Lake(root), "ledger"), failed=ledger.FAILED)


def backlog_df(spark: SparkSession, root: str) -> DataFrame:
    return ledger.backlog(read_table(spark, Lake(root), "ledger"), failed=ledger.FAILED)


def stuck_files_df(spark: SparkSession, root: str, now, older_than_minutes: int = 1) -> DataFrame:
    return ledger.stuck(read_table(spark, Lake(root), "ledger"), now, older_than_minutes, failed=ledger.FAILED)
