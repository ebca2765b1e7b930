"""Read-side operators: cell totals, dense hour table, hour lookup."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import wide_sum

HOURS = 24


def check_hour(h: int) -> int:
    """Hour-of-day argument check."""
    if not isinstance(h, int) or isinstance(h, bool) or h < 0 or h > HOURS - 1:
        raise ValueError(f"{h!r} is no hour of the day (an int from 0 to {HOURS - 1})")
    return h


def as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def cell_total(hour_denorm_df: DataFrame, d, h: int, zone: str | None = None, by_zone: bool = False) -> DataFrame:
    """Revenue of one (date, hour) cell, 0.0 when nothing is there.

    The filter is on the partition column ``p_date`` when the table has it, so
    the scan reads one date folder (PartitionFilters), not the whole table.
    """
    day = as_date(d)
    check_hour(h)
    date_col = "p_date" if "p_date" in hour_denorm_df.columns else "date"
    cell = hour_denorm_df.where((F.col(date_col) == F.lit(day)) & (F.col("hour") == F.lit(h)))
    if zone is not None:
        cell = cell.where(F.col("zone") == F.lit(zone))
    if by_zone:
        return cell.groupBy("zone").agg(wide_sum("total_amount").cast("double").alias("total_revenue"))
    return cell.agg(wide_sum("total_amount").cast("double").alias("total_revenue")).select(
        F.lit(day).alias("date"), F.lit(h).cast("int").alias("hour"), "total_revenue"
    )


def dense_hours(spark: SparkSession, hourly_df: DataFrame, value: str = "revenue") -> DataFrame:
    """Hours 0..23, each with its value or 0.0 (K6, J5). ``hourly_df`` has <= 24 rows."""
    hours = spark.range(HOURS).select(F.col("id").cast("int").alias("hour"))
    h = F.broadcast(hourly_df.select(F.col("hour").alias("h_hour"), F.col(value).alias("v")))
    j = hours.join(h, hours["hour"] == h["h_hour"], "left")
    return j.select("hour", F.coalesce(F.col("v").cast("double"), F.lit(0.0)).alias(value))


def serving_table(spark: SparkSession, day_hour_df: DataFrame) -> DataFrame:
    """The 24-row serving table: cumulative revenue, average hourly revenue,
    number of days seen, per hour of day. Built from the (date, hour) totals
    (``gold.day_hour``, stored as the ``day_hours`` table): one row per
    observed (date, hour), so the row count per hour is the days it was seen."""
    per_hour = day_hour_df.groupBy("hour").agg(
        F.sum("revenue").alias("rev_sum"),
        F.count(F.lit(1)).alias("n_days"),
    )
    hours = spark.range(HOURS).select(F.col("id").cast("int").alias("hour"))
    j = hours.join(F.broadcast(per_hour.withColumnRenamed("hour", "h")), F.col("hour") == F.col("h"), "left")
    return j.select(
        "hour",
        F.coalesce(F.col("rev_sum").cast("double"), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.col("rev_sum").cast("double") / F.col("n_days"), F.lit(0.0)).alias("avg_revenue"),
        F.coalesce(F.col("n_days"), F.lit(0)).cast("long").alias("n_days"),
    )


def lookup_hour(serving_df: DataFrame, h: int) -> DataFrame:
    """Point read of one hour from the serving table."""
    check_hour(h)
    return serving_df.where(F.col("hour") == F.lit(h))
