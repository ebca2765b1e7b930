"""Batch queries over the stand-in tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables. Parameters such as the cell looked up or the split date between
"stored" and "incoming" totals are the features under test, not row caps.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import explore, gold, ledger, serving
from tidemark.operators import silver as silver_op
from tidemark.sources import standin
from tidemark.sources.zones import as_zones

# Fixed scenario parameters (the stand-in events cover 2024-01-01 .. 2024-01-30).
SPLIT_DATE = _dt.date(2024, 1, 16)  # stored totals before, incoming batch from this day
LEDGER_UNTIL = _dt.date(2024, 1, 21)  # files before this day are already in the ledger
CELL_DATE = _dt.date(2024, 1, 10)
CELL_HOUR = 5
MISSING_DATE = _dt.date(2023, 12, 31)  # a day with no trips
LOOKUP_HOUR = 5
MONTH = "1996-03"
LEDGER_NOW = _dt.datetime(2024, 1, 31)
STUCK_MINUTES = 60
FIRST_FILES = 10
PREVIEW_DAYS = 20


def silver_rows(spark: SparkSession, sf: str) -> DataFrame:
    return silver_op.silver(standin.trips(spark, sf), carry=("event_id",))


def zones(spark: SparkSession, sf: str) -> DataFrame:
    return as_zones(standin.zones(spark, sf))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    return gold.cells(silver_op.silver(standin.trips(spark, sf)))


def silver_clean(spark, sf):
    return silver_rows(spark, sf)


def quarantine_rows(spark, sf):
    q = silver_op.quarantine(standin.trips_with_gaps(spark, sf), carry=("event_id",))
    return q.select("event_id", "reason")


def rows_per_day(spark, sf):
    return explore.rows_per_day(standin.trips(spark, sf))


def revenue_by_day_hour(spark, sf):
    return gold.day_hour(cells(spark, sf))


def hourly_revenue(spark, sf):
    return gold.hourly(cells(spark, sf))


def _stored_and_batch(spark, sf):
    c = cells(spark, sf)
    stored = gold.hourly(c.where(F.col("date") < F.lit(SPLIT_DATE)))
    batch = gold.hourly(c.where(F.col("date") >= F.lit(SPLIT_DATE)))
    return stored, batch


def hourly_revenue_merge(spark, sf):
    stored, batch = _stored_and_batch(spark, sf)
    return gold.merge_totals(stored, batch)


def additive_merge(spark, sf):
    stored, batch = _stored_and_batch(spark, sf)
    return gold.additive_merge(stored, batch, ["hour"], "revenue")


def hour_denorm(spark, sf):
    return gold.hour_denorm(cells(spark, sf), zones(spark, sf))


def hour_denorm_export(spark, sf):
    hd = hour_denorm(spark, sf)
    return hd.select(
        "zone",
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "hour",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


def unmatched_zone_revenue(spark, sf):
    return gold.unmatched(cells(spark, sf), zones(spark, sf))


def total_revenue(spark, sf):
    return serving.cell_total(hour_denorm(spark, sf), CELL_DATE, CELL_HOUR)


def total_revenue_missing(spark, sf):
    return serving.cell_total(hour_denorm(spark, sf), MISSING_DATE, CELL_HOUR)


def total_revenue_zone(spark, sf):
    return serving.cell_total(hour_denorm(spark, sf), CELL_DATE, CELL_HOUR, by_zone=True)


def serving_hourly_dense(spark, sf):
    return serving.dense_hours(spark, gold.hourly(cells(spark, sf)))


def serving_lookup(spark, sf):
    return serving.lookup_hour(serving.serving_table(spark, gold.day_hour(cells(spark, sf))), LOOKUP_HOUR)


def avg_revenue(spark, sf):
    return gold.avg_by_hour(gold.day_hour(cells(spark, sf)))


def avg_revenue_running(spark, sf):
    c = cells(spark, sf)
    before = gold.hour_state(gold.day_hour(c.where(F.col("date") < F.lit(SPLIT_DATE))))
    after = gold.hour_state(gold.day_hour(c.where(F.col("date") >= F.lit(SPLIT_DATE))))
    return gold.state_avg(gold.merge_state(before, after))


def _landing_and_ledger(spark, sf):
    s = silver_op.silver(standin.trips(spark, sf))
    landing = explore.landing_names(s)
    in_ledger = explore.landing_names(s.where(F.col("date") < F.lit(LEDGER_UNTIL)))
    return landing, in_ledger


def new_files(spark, sf):
    landing, in_ledger = _landing_and_ledger(spark, sf)
    return ledger.new_files(landing, in_ledger)


def known_files(spark, sf):
    landing, in_ledger = _landing_and_ledger(spark, sf)
    return ledger.known_files(landing, in_ledger)


def ledger_latest_status(spark, sf):
    return ledger.latest_status(standin.ledger_events(spark, sf), standin.LEDGER_STAGES)


def ledger_stage_times(spark, sf):
    return ledger.stage_times(standin.ledger_events(spark, sf), standin.LEDGER_STAGES)


def ledger_backlog(spark, sf):
    return ledger.backlog(standin.ledger_events(spark, sf), standin.LEDGER_STAGES)


def stuck_files(spark, sf):
    return ledger.stuck(standin.ledger_events(spark, sf), LEDGER_NOW, STUCK_MINUTES, standin.LEDGER_STAGES)


def month_filter(spark, sf):
    return explore.month_filter(standin.monthly(spark, sf), MONTH)


def first_n_files(spark, sf):
    landing, _ = _landing_and_ledger(spark, sf)
    return explore.first_n(landing, FIRST_FILES, "file_path")


def top_rows(spark, sf):
    return explore.first_n(explore.rows_per_day(standin.trips(spark, sf)), PREVIEW_DAYS, "date")


def grain_cardinality(spark, sf):
    return explore.grain_cardinality(silver_op.silver(standin.trips(spark, sf)))


def reconcile(spark, sf):
    return gold.reconcile(cells(spark, sf), zones(spark, sf))


def file_name_parse(spark, sf):
    landing, _ = _landing_and_ledger(spark, sf)
    return explore.parse_file_names(landing)


QUERIES = {
    "silver_clean": silver_clean,
    "quarantine_rows": quarantine_rows,
    "rows_per_day": rows_per_day,
    "revenue_by_day_hour": revenue_by_day_hour,
    "hourly_revenue": hourly_revenue,
    "hourly_revenue_merge": hourly_revenue_merge,
    "additive_merge": additive_merge,
    "hour_denorm": hour_denorm,
    "hour_denorm_export": hour_denorm_export,
    "unmatched_zone_revenue": unmatched_zone_revenue,
    "total_revenue": total_revenue,
    "total_revenue_missing": total_revenue_missing,
    "total_revenue_zone": total_revenue_zone,
    "serving_hourly_dense": serving_hourly_dense,
    "serving_lookup": serving_lookup,
    "avg_revenue": avg_revenue,
    "avg_revenue_running": avg_revenue_running,
    "new_files": new_files,
    "known_files": known_files,
    "ledger_latest_status": ledger_latest_status,
    "ledger_stage_times": ledger_stage_times,
    "ledger_backlog": ledger_backlog,
    "stuck_files": stuck_files,
    "month_filter": month_filter,
    "first_n_files": first_n_files,
    "top_rows": top_rows,
    "grain_cardinality": grain_cardinality,
    "reconcile": reconcile,
    "file_name_parse": file_name_parse,
}
