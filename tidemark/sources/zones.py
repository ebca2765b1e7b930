"""Zone dimension: CSV with a header row, read with a fixed schema (S3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ZONES


def read_zones_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the zone lookup CSV without schema inference (no extra pass)."""
    return spark.read.schema(ZONES).option("header", "true").option("mode", "PERMISSIVE").csv(path)


def write_zones_csv(zones: DataFrame, path: str) -> None:
    """Write a zone table as one header CSV (the dimension is small by contract)."""
    (
        zones.select(*[F.col(f.name).cast(f.dataType) for f in ZONES.fields])
        .coalesce(1)
        .write.mode("overwrite")
        .option("header", "true")
        .csv(path)
    )


def as_zones(df: DataFrame) -> DataFrame:
    """Normalise a zone DataFrame to (LocationID INT, zone STRING)."""
    return df.select(F.col("LocationID").cast("int").alias("LocationID"), F.col("Zone").alias("zone"))
