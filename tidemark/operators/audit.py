"""Checks along the stored tables (V3): each table against what the one before it gives, date by date.

Every table of the lake is a function of the one before it, so a step holds if the rows that the operator makes of the
stored input are the rows that are stored behind it. They are compared by digests of a date: how many rows, their sum, and
the sum of a 64-bit hash a row, which does not depend on order and tells rows apart that trade places or amounts. Only
digests are shuffled beyond what the operator itself needs: one row for each date and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import wide_sum
from tidemark.operators import gold, serving
from tidemark.schemas import WIDE
from tidemark.sinks import publish
from tidemark.sinks.lake import Lake, read_dates, read_table

#: Names of the steps, in order; the last one has no dates.
STEPS = ("silver_to_file_cells", "file_cells_to_cells", "cells_to_day_hours", "cells_to_hour_denorm", "day_hours_to_serving")


def digests(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """p_date, n, total, sum of row hashes. A null is hashed as a null, not left out."""
    parts = [p for k in keys for p in (F.col(k).isNull(), F.col(k))]
    hashed = F.xxhash64(*parts, F.col(value).cast(WIDE))
    return rows.groupBy("p_date").agg(
        F.count(F.lit(1)).alias("n"),
        wide_sum(value).alias("total"),
        F.sum(hashed.cast("decimal(38,0)")).alias("hashes"),
    )


def compare(step: str, expected: DataFrame, actual: DataFrame, keys: list[str], value: str) -> DataFrame:
    """step, date, n and total of either side, and whether all agrees. A date that one side lacks is not ok."""
    sides = [digests(rows, keys, value).select("p_date", *(F.col(c).alias(f"{c}_{side}") if own == side else F.lit(None).alias(f"{c}_{own}") for own in ("expected", "actual") for c in ("n", "total", "hashes"))) for side, rows in (("expected", expected), ("actual", actual))]
    both = sides[0].unionByName(sides[1]).groupBy("p_date").agg(*(F.max(f"{c}_{own}").alias(f"{c}_{own}") for own in ("expected", "actual") for c in ("n", "total", "hashes")))
    same = [F.col(f"{c}_expected").eqNullSafe(F.col(f"{c}_actual")) for c in ("n", "total", "hashes")]
    return both.select(
        F.lit(step).alias("step"),
        F.col("p_date").alias("date"),
        "n_expected",
        "n_actual",
        "total_expected",
        "total_actual",
        (same[0] & same[1] & same[2]).alias("ok"),
    )


def chain(spark: SparkSession, lake: Lake, zones: DataFrame, dates=None) -> DataFrame:
    """One row for each step and date: does the stored table hold what the one before it gives?

    ``dates`` restricts it to some dates, whose folders alone are read (serving, which folds all dates, is left out then).
    All gold tables are read as one publication left them.
    """
    pointer = publish.current(spark, lake.published)

    def stored(name: str) -> DataFrame:
        if dates is not None:
            return read_dates(spark, lake, name, dates, pointer=pointer)
        return read_table(spark, lake, name, pointer)

    silver, file_cells, cells, day_hours = (stored(n) for n in ("silver", "file_cells", "cells", "day_hours"))
    columns = ["zone", "date", "hour", "total_amount", "p_date"]
    denorm = stored("hour_denorm").withColumn("total_amount", F.col("total_amount").cast(WIDE)).select(columns).unionByName(stored("overflow").select(columns))
    cell = ["date", "hour", "PULocationID", "n_trips"]
    out = [
        compare(STEPS[0], gold.cells(silver, ("p_date", "source_file")), file_cells, [*cell, "source_file"], "total_amount"),
        compare(STEPS[1], gold.fold_cells(file_cells).withColumn("p_date", F.col("date")), cells, cell, "total_amount"),
        compare(STEPS[2], gold.day_hour_by_partition(cells), day_hours, ["date", "hour"], "revenue"),
        compare(STEPS[3], gold.hour_denorm(cells, zones), denorm, ["zone", "date", "hour"], "total_amount"),
    ]
    if dates is None:
        whole = F.lit(None).cast("date")
        folded = serving.serving_table(spark, day_hours).withColumn("p_date", whole)
        out.append(compare(STEPS[4], folded, read_table(spark, lake, "serving").withColumn("p_date", whole), ["hour", "avg_revenue", "n_days"], "revenue"))
    first, *rest = out
    for more in rest:
        first = first.unionByName(more)
    return first
