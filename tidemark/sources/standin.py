"""Stand-in mappings from the shared test tables to the pipeline's inputs.

The test data holds no taxi trips. The mapping (fixed, see FIXTURES.md):

* trips  <- ``events``: ts -> pickup, user_id % 30 -> PULocationID, value -> total_amount
* zones  <- ``nation``: n_nationkey -> LocationID, n_name -> Zone
* month  <- ``orders``: o_orderdate, o_totalprice
* ledger <- ``events``: user_id -> file, event_type -> status, ts -> time

The mappings are column renames and casts only; every row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values for the stand-in mapping.
ZONE_IDS = 30  # user_id % 30 gives 30 zone ids; nation holds 25 of them
# event types standing for the stages of a file, in order
LEDGER_STAGES = ("signup", "view", "click", "error", "purchase")
MISSING_PICKUP_EVERY = 97  # pickups blanked on event_id % 97 = 0 to feed the quarantine


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-trip shaped rows from ``events`` (event_id kept as the row identity)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        (F.col("user_id") % ZONE_IDS).cast("long").alias("PULocationID"),
        F.col("value").cast("double").alias("total_amount"),
    )


def trips_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same rows, but some pickups blanked, as broken rows in real files are."""
    t = trips(spark, sf_dir)
    blank = (F.col("event_id") % MISSING_PICKUP_EVERY) == 0
    return t.withColumn(
        "tpep_pickup_datetime",
        F.when(blank, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("tpep_pickup_datetime")),
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in the CSV's column layout, from ``nation``."""
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("int").alias("LocationID"),
        F.col("n_regionkey").cast("string").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.lit(None).cast("string").alias("service_zone"),
    )


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a multi-month raw file, from ``orders``."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("o_totalprice").alias("total_amount"),
    )


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File status events from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.col("user_id").cast("string"), F.lit(".parquet")).alias("file_path"),
        F.col("event_type").alias("status"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
    )
