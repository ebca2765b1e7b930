"""Queries over the stored tables: the chain of checks, additive tables and the catalog's table.

Set up like :mod:`tidemark.plans.scenarios`, over the whole stand-in trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import audit
from tidemark.plans import oracle
from tidemark.plans.recovery import _land_moved, _redrop
from tidemark.plans.scenarios import LATE_FROM_HOUR, ScenarioError, _setup, _tick
from tidemark.schemas import MONEY
from tidemark.session import scratch_dir
from tidemark.sinks import additive, catalog, fs, publish
from tidemark.sinks.lake import Lake, gold_paths
from tidemark.sinks.split import split_days
from tidemark.sources import standin
from tidemark.streaming.ingest import replay_files

BATCHES = 7  # of the additive scenario
#: Which table is altered on which date (by rank) of audit_tampered, and the steps that must notice.
ALTERED = ("silver", "file_cells", "cells", "day_hours", "hour_denorm")


def _late_and_replayed(spark: SparkSession, sf: str, label: str):
    """A lake after morning files, late afternoon files of the same days, and a replay of the latter."""
    root, landing, lake, zones = _setup(spark, sf, label)
    trips = standin.trips(spark, sf)
    late = F.hour("tpep_pickup_datetime") >= LATE_FROM_HOUR
    split_days(spark, trips.where(~late), landing)
    _tick(spark, landing, lake, zones)
    paths = split_days(spark, trips.where(late), landing, name_suffix=".late")
    _tick(spark, landing, lake, zones)
    replay_files(spark, paths, lake, zones)
    return root, landing, lake, zones


def audit_chain(spark, sf):
    """Every step of every date after late files and a replay: rows, totals, and that they agree."""
    _, _, lake, zones = _late_and_replayed(spark, sf, "audit-chain")
    return audit.chain(spark, lake, zones).select("step", "date", F.col("n_actual").alias("n"), F.col("total_actual").cast(MONEY).alias("total"), "ok")


def _alter(spark: SparkSession, lake: Lake, name: str, date, stage: str) -> None:
    """Move a stored date's rows to the next hour, by hand: as many rows, the same sum."""
    if name in publish.GOLD:
        leaves = publish.paths(publish.current(spark, lake.published), gold_paths(lake)[name], name, [date])
    else:
        leaves = fs.glob(spark, f"{getattr(lake, name)}/p_date={date}/source_file=*")
    for i, leaf in enumerate(leaves):
        rows = spark.read.parquet(leaf)
        rows.withColumn("hour", F.pmod(F.col("hour") + 1, F.lit(24)).cast("int")).write.parquet(f"{stage}/{i}")
        fs.delete(spark, leaf)
        if not fs.rename(spark, f"{stage}/{i}", leaf):
            raise OSError(f"{leaf} could not be altered")


def audit_tampered(spark, sf):
    """The steps that do not hold after one table was altered by hand on each of five dates, by as many rows and the same sum."""
    root, _, lake, zones = _late_and_replayed(spark, sf, "audit-tampered")
    dates = [r["date"] for r in audit.chain(spark, lake, zones).where("date is not null").select("date").distinct().orderBy("date").limit(len(ALTERED)).collect()]
    for name, date in zip(ALTERED, dates, strict=True):
        _alter(spark, lake, name, date, f"{root}/altered/{name}")
    return audit.chain(spark, lake, zones).where("not ok").select("step", "date")


def additive_twice(spark, sf):
    """Hourly totals as a stored additive table: batches come twice, before and after a compaction, a batch first comes
    with other content, one stops half way, and one only after its neighbours are folded."""
    table = additive.AdditiveTable(f"{scratch_dir(spark, 'additive')}/hourly", (T.StructField("hour", T.IntegerType()),), "revenue")
    trips = standin.trips(spark, sf).select(F.col("event_id"), F.hour("tpep_pickup_datetime").alias("hour"), F.col("total_amount").cast(MONEY).alias("revenue")).where("hour is not null")

    def send(i: int, times: int = 1) -> bool:
        rows = trips.where(F.pmod("event_id", F.lit(BATCHES)) == i).withColumn("revenue", F.col("revenue") * times)
        return additive.add(table, rows.select("hour", "revenue"), i)

    for i in (0, 1, 2, 4):
        send(i)
    send(1)
    send(2, times=3)
    send(2)
    if additive.compact(spark, table) != 4:
        raise ScenarioError("four batches were to be folded")
    if send(1) or send(4, times=2):
        raise ScenarioError("a folded batch was taken again")
    for i in (3, 5, 6, 5):
        if not send(i):
            raise ScenarioError(f"batch {i} was refused")
    before = additive.read(spark, table).orderBy("hour").collect()
    if additive.compact(spark, table) != 3 or additive.compact(spark, table) or additive.read(spark, table).orderBy("hour").collect() != before:
        raise ScenarioError("compaction changed the totals")
    return additive.read(spark, table).select("hour", F.col("revenue").cast(MONEY).alias("revenue"))


def external_table(spark, sf):
    """The silver table in the catalog, made after wrong files and brought up to date after a late file and a replay that
    moves every row to another day."""
    root, landing, lake, zones = _setup(spark, sf, "external-table")
    table = "trips_" + "".join(c if c.isalnum() else "_" for c in root.rsplit("/", 1)[-1])
    trips = standin.trips(spark, sf)
    late = F.hour("tpep_pickup_datetime") >= LATE_FROM_HOUR
    _land_moved(spark, trips.where(~late), root, landing)
    _tick(spark, landing, lake, zones)
    catalog.silver_table(spark, lake, table)
    first = spark.table(table).select(F.max("date").alias("last")).first()["last"]
    split_days(spark, trips.where(late), landing, name_suffix=".late")
    _tick(spark, landing, lake, zones)
    replay_files(spark, _redrop(spark, trips.where(~late), root, landing), lake, zones)
    catalog.silver_table(spark, lake, table)
    if spark.sql(f"SHOW PARTITIONS {table}").where(F.col("partition").contains(f"p_date={first}/")).count():
        raise ScenarioError("a partition that is gone is still in the catalog")
    return spark.sql(f"SELECT date, hour, PULocationID, total_amount FROM {table}")


QUERIES = {"audit_chain": audit_chain, "audit_tampered": audit_tampered, "additive_twice": additive_twice, "external_table": external_table}

_CHAIN = """
SELECT step, date, COUNT(DISTINCT (hour, PULocationID)) AS n, CAST(SUM(total_amount) AS DECIMAL(18,2)) AS total, TRUE AS ok
FROM silver, (VALUES ('silver_to_file_cells'), ('file_cells_to_cells')) s(step) GROUP BY step, date
UNION ALL
SELECT 'cells_to_day_hours', date, COUNT(DISTINCT hour), CAST(SUM(total_amount) AS DECIMAL(18,2)), TRUE FROM silver GROUP BY date
UNION ALL
SELECT 'cells_to_hour_denorm', date, COUNT(DISTINCT (zone, hour)), CAST(SUM(total_amount) AS DECIMAL(18,2)), TRUE FROM denorm GROUP BY date
UNION ALL
SELECT 'day_hours_to_serving', NULL, 24, CAST(SUM(total_amount) AS DECIMAL(18,2)), TRUE FROM silver"""

SQL = {
    "audit_chain": oracle._with(oracle.SILVER, oracle.ZONES, oracle.DENORM) + _CHAIN,
    "audit_tampered": oracle._with(oracle.SILVER) + """
SELECT step, CASE WHEN step = 'day_hours_to_serving' THEN NULL ELSE date END AS date
FROM (SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM silver)) d
JOIN (VALUES (1, 'silver_to_file_cells'), (2, 'silver_to_file_cells'), (2, 'file_cells_to_cells'), (3, 'file_cells_to_cells'),
  (3, 'cells_to_day_hours'), (3, 'cells_to_hour_denorm'), (4, 'cells_to_day_hours'), (4, 'day_hours_to_serving'), (5, 'cells_to_hour_denorm')) v(k, step) USING (k)""",
    "additive_twice": oracle.HOURLY_SQL,
    "external_table": oracle.SILVER_COLUMNS_SQL,
}
