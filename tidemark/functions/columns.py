"""Scalar column expressions shared by the operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import MONEY, WIDE

PICKUP = "tpep_pickup_datetime"

# Quarantine reasons.
NULL_PICKUP = "null_pickup"
BAD_PICKUP = "bad_pickup"
BAD_AMOUNT = "bad_amount"
BAD_LOCATION = "bad_location"


def pickup_date(col: str = PICKUP) -> Column:
    """Calendar day of the pickup (timestamp_ntz, so no zone shift)."""
    return F.to_date(F.col(col))


def pickup_hour(col: str = PICKUP) -> Column:
    """Hour of day 0..23 as INT."""
    return F.hour(F.col(col)).cast("int")


def zone_id(col: str = "PULocationID") -> Column:
    """Location id as INT; values that do not fit become NULL instead of failing."""
    return F.col(col).try_cast("int")


def money(col: str = "total_amount") -> Column:
    """Per-row rounding to DECIMAL(18,2); overflow becomes NULL (ANSI-safe)."""
    return F.col(col).try_cast(MONEY)


def wide_sum(col: str | Column) -> Column:
    """SUM of a money column, 0 for an empty or all-NULL group, in DECIMAL(38,2).

    Decimal sums are exact, so summing partial sums gives the same value as one
    sum over all rows; that is what makes the two-level aggregation safe. Stored
    sums are this wide, so no cell of valid amounts can stop a batch.
    """
    expr = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.sum(expr), F.lit(0)).cast(WIDE)


def money_sum(col: str | Column) -> Column:
    """The same in DECIMAL(18,2), the contract's type; NULL for a sum that it cannot hold."""
    return wide_sum(col).try_cast(MONEY)


def wall_clock(col: str = PICKUP) -> Column:
    """A pickup of any type as timestamp_ntz; NULL when it cannot be one."""
    return F.col(col).try_cast("timestamp_ntz")


def valid_trip(pickup: str = PICKUP, location: str = "PULocationID", amount: str = "total_amount") -> Column:
    """Row can enter silver: a pickup time, and no value lost by a cast.

    ``pickup IS NOT NULL`` is kept as its own conjunct so Catalyst pushes it to
    the parquet scan.
    """
    return (
        F.col(pickup).isNotNull()
        & (F.col(amount).isNull() | money(amount).isNotNull())
        & (F.col(location).isNull() | zone_id(location).isNotNull())
    )


def reject_reason(pickup: str = PICKUP, location: str = "PULocationID", amount: str = "total_amount") -> Column:
    """Why a row is kept out of silver; NULL when it is valid."""
    return (
        F.when(F.col(pickup).isNull(), F.lit(NULL_PICKUP))
        .when(wall_clock(pickup).isNull(), F.lit(BAD_PICKUP))
        .when(F.col(amount).isNotNull() & money(amount).isNull(), F.lit(BAD_AMOUNT))
        .when(F.col(location).isNotNull() & zone_id(location).isNull(), F.lit(BAD_LOCATION))
    )


def ntz(value) -> Column:
    """A wall-clock timestamp literal (timestamp_ntz) from a naive datetime or
    an ISO string. Built from text, so neither the Python process's zone nor
    the session zone shifts it."""
    text = value.isoformat(sep=" ") if hasattr(value, "isoformat") else str(value)
    return F.lit(text).cast("timestamp_ntz")


def plain_path(name: str) -> Column:
    """A path or file name of ``_metadata``, which is percent-encoded, as the file system has it."""
    return F.url_decode(F.replace(F.col(name), F.lit("+"), F.lit("%2B")))


def file_date(name: Column) -> Column:
    """Day encoded in a landing file name such as ``2019-01-01.parquet``."""
    return F.try_to_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")


def file_month(name: Column) -> Column:
    """``yyyy-MM`` month key of a landing file name."""
    return F.regexp_extract(name, r"(\d{4}-\d{2})-\d{2}", 1)
