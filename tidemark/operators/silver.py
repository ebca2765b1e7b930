"""Bronze -> silver: typing, cleaning and the quarantine split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (
    PICKUP,
    money,
    pickup_date,
    pickup_hour,
    reject_reason,
    valid_trip,
    wall_clock,
    zone_id,
)


def silver(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed trips with a pickup time: ``date, hour, PULocationID, total_amount``.

    Lenient casts (``try_cast``) make a bad value NULL instead of failing the
    batch; rows that lost a value that way go to :func:`quarantine` instead.
    Amounts are rounded per row to DECIMAL(18,2) before any sum. ``carry``
    passes extra columns through (e.g. ``source_file``).
    """
    return raw.where(valid_trip()).select(
        *[F.col(c) for c in carry],
        pickup_date().alias("date"),
        pickup_hour().alias("hour"),
        zone_id().alias("PULocationID"),
        money().alias("total_amount"),
    )


def typed(raw: DataFrame) -> DataFrame:
    """Raw rows whose columns may have any type, as :data:`tidemark.schemas.TYPED`.

    The casts are those of :func:`silver` (``try_cast``); ``reason`` says what a row lost by
    them, NULL for a good one, so files of different types make one batch.
    """
    return raw.select(
        "source_file",
        wall_clock().alias(PICKUP),
        zone_id().alias("zone_id"),
        money().alias("amount"),
        reject_reason().alias("reason"),
        F.col("PULocationID").try_cast("long").alias("PULocationID"),
        F.col("total_amount").try_cast("double").alias("total_amount"),
    )


def typed_silver(rows: DataFrame) -> DataFrame:
    """The good ones of typed rows, as silver rows with their partitions."""
    good = rows.where(F.col("reason").isNull()).select(
        "source_file",
        pickup_date().alias("date"),
        pickup_hour().alias("hour"),
        F.col("zone_id").alias("PULocationID"),
        F.col("amount").alias("total_amount"),
    )
    return with_partition(good)


def typed_rejects(rows: DataFrame) -> DataFrame:
    """The rejected ones of typed rows, with the reason and their raw values."""
    return rows.where(F.col("reason").isNotNull()).select("source_file", "reason", PICKUP, "PULocationID", "total_amount")


def with_partition(df: DataFrame) -> DataFrame:
    """Copy ``date`` to the partition column ``p_date`` so ``date`` stays in the files (P5)."""
    return df.withColumn("p_date", F.col("date"))


def quarantine(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows kept out of silver, with the reason and their raw values."""
    return raw.where(~valid_trip()).select(
        *[F.col(c) for c in carry],
        reject_reason().alias("reason"),
        F.col(PICKUP),
        F.col("PULocationID").cast("long").alias("PULocationID"),
        F.col("total_amount").cast("double").alias("total_amount"),
    )
