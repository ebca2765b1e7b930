"""Exploration operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import PICKUP, file_date, file_month, money_sum, ntz, pickup_date


def rows_per_day(raw: DataFrame, pickup: str = PICKUP) -> DataFrame:
    """Trips per calendar day, days in order (A3, O1, P10)."""
    return (
        raw.where(F.col(pickup).isNotNull())
        .groupBy(pickup_date(pickup).alias("date"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("date")
    )


def grain_cardinality(silver: DataFrame) -> DataFrame:
    """Rows vs distinct days / hours / zones / (day, hour, zone) cells.

    The rows are first folded to one per cell (a map-side partial aggregate),
    and the distinct counts run on that compact table.
    """
    c = silver.groupBy("date", "hour", "PULocationID").agg(F.count(F.lit(1)).alias("n"))
    return c.agg(
        F.sum("n").alias("n_rows"),
        F.countDistinct("date").alias("n_days"),
        F.countDistinct("hour").alias("n_hours"),
        F.countDistinct("PULocationID").alias("n_zones"),
        F.count(F.lit(1)).alias("n_cells"),
    )


def month_range(month: str) -> tuple[_dt.datetime, _dt.datetime]:
    """``yyyy-MM`` -> [first instant, first instant of the next month)."""
    y, m = (int(x) for x in month.split("-"))
    start = _dt.datetime(y, m, 1)
    end = _dt.datetime(y + (m == 12), m % 12 + 1, 1)
    return start, end


def month_filter(raw: DataFrame, month: str, pickup: str = PICKUP) -> DataFrame:
    """Rows of one calendar month, per day count and revenue.

    The month test is a range on the raw timestamp, which Parquet can push
    down (row-group min/max), rather than a string format of every row.
    """
    start, end = month_range(month)
    ts = F.col(pickup)
    rows = raw.where(ts.isNotNull() & (ts >= ntz(start)) & (ts < ntz(end)))
    return rows.groupBy(pickup_date(pickup).alias("date")).agg(
        F.count(F.lit(1)).alias("n"),
        money_sum(F.col("total_amount").try_cast("decimal(18,2)")).alias("total_amount"),
    )


def landing_names(silver: DataFrame) -> DataFrame:
    """Daily file names ``yyyy-MM-dd.parquet`` for the dates present."""
    return silver.select(F.concat(F.col("date").cast("string"), F.lit(".parquet")).alias("file_path")).distinct()


def first_n(df: DataFrame, n: int, order: str) -> DataFrame:
    """First ``n`` rows by ``order`` (O2-O4): TakeOrderedAndProject, a per-task
    top-n merged on one task, never a full sort."""
    return df.orderBy(order).limit(n)


def parse_file_names(names: DataFrame, col: str = "file_path") -> DataFrame:
    """File name -> (date, month)."""
    c = F.col(col)
    return names.select(c, file_date(c).alias("date"), file_month(c).alias("month"))
