"""Queries that run replays, stops and awkward files through the ingest job, then read the lake back.

Set up like :mod:`tidemark.plans.scenarios`: the whole stand-in trips become landing files under the shared
``spark.checkpoint.dir`` and the streaming job ingests them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import explore
from tidemark.plans import oracle
from tidemark.plans.scenarios import FILES_PER_BATCH, ScenarioError, _gold, _setup, _tick
from tidemark.schemas import MONEY, RAW_TRIPS, WIDE
from tidemark.session import scratch_dir
from tidemark.sinks import fs
from tidemark.sinks.lake import read_table
from tidemark.sinks.split import split_days
from tidemark.sources import standin
from tidemark.sources.trips import read_trips
from tidemark.streaming import replay as replay_log
from tidemark.streaming.batch import InjectedFailure
from tidemark.streaming.ingest import replay_files

# Fixed values of the scenarios.
HUGE, HUGE_EVERY = 9e15, 97  # two such amounts in a cell are more than DECIMAL(18,2) holds
KINDS = 5  # schemas of the daily files, by day of the month


def _redrop(spark: SparkSession, trips: DataFrame, root: str, landing: str) -> list[str]:
    """Replace landing files by files of the same names with these trips; their paths."""
    out = []
    for path in split_days(spark, trips, f"{root}/redrop"):
        name = path.rsplit("/", 1)[1]
        fs.delete(spark, f"{landing}/{name}", recursive=False)
        fs.rename(spark, path, f"{landing}/{name}")
        out.append(f"{landing}/{name}")
    return out


def _other_days(trips: DataFrame) -> DataFrame:
    """The file of each day holds trips of the day after, at double amounts."""
    return trips.select(
        *[c for c in trips.columns if c not in ("tpep_pickup_datetime", "total_amount")],
        F.col("tpep_pickup_datetime"),
        (F.col("tpep_pickup_datetime") + F.expr("INTERVAL 1 DAY")).alias("moved"),
        (F.col("total_amount") * 2).alias("total_amount"),
    )


def _land_moved(spark: SparkSession, trips: DataFrame, root: str, landing: str) -> None:
    """Files named by the true day whose rows are a day late."""
    for path in split_days(spark, _other_days(trips), f"{root}/moved"):
        name = path.rsplit("/", 1)[1]
        rows = spark.read.parquet(path).withColumn("tpep_pickup_datetime", F.col("moved")).drop("moved")
        _write_one(spark, rows, f"{root}/one/{name}", f"{landing}/{name}")


def _write_one(spark: SparkSession, rows: DataFrame, stage: str, target: str) -> None:
    """One file of these rows (a day's, or none)."""
    rows.coalesce(1).write.parquet(stage)
    fs.mkdirs(spark, target.rsplit("/", 1)[0])
    if not fs.rename(spark, fs.glob(spark, f"{stage}/part-*.parquet")[0], target):
        raise OSError(f"{target} could not be written")


def replay_changed_content(spark, sf):
    """Every file first holds other amounts on other days; one replay of all brings the true ones."""
    root, landing, lake, zones = _setup(spark, sf, "replay-changed")
    trips = standin.trips(spark, sf)
    _land_moved(spark, trips, root, landing)
    _tick(spark, landing, lake, zones)
    replay_files(spark, _redrop(spark, trips, root, landing), lake, zones)
    return _gold(spark, lake)


def replay_after_crash(spark, sf):
    """As before, but the files are replayed in groups, one for each point where a replay can stop; a plain tick
    after each stop finishes what had its intent record. A stop before the record changes nothing."""
    root, landing, lake, zones = _setup(spark, sf, "replay-crash")
    trips = standin.trips(spark, sf)
    _land_moved(spark, trips, root, landing)
    _tick(spark, landing, lake, zones)
    paths = _redrop(spark, trips, root, landing)
    before = {r["date"] for r in _gold(spark, lake).select("date").distinct().collect()}
    for i, point in enumerate(replay_log.POINTS):
        mine = paths[i :: len(replay_log.POINTS)]
        try:
            replay_files(spark, mine, lake, zones, fail_at=point)
            raise ScenarioError(f"the stop after {point} did not surface")
        except InjectedFailure:
            pass
        _tick(spark, landing, lake, zones)
        if fs.glob(spark, f"{lake.replays}/*"):
            raise ScenarioError(f"the tick after a stop after {point} left something behind")
        if point == "staged":
            if {r["date"] for r in _gold(spark, lake).select("date").distinct().collect()} != before:
                raise ScenarioError("a replay without an intent record changed the lake")
            replay_files(spark, mine, lake, zones)
    return _gold(spark, lake)


def read_during_rebuild(spark, sf):
    """What readers get while every date is being rebuilt (the replay has stopped with all new gold dates written, none
    published): the old values, whole; and after the next tick the new ones."""
    root, landing, lake, zones = _setup(spark, sf, "read-during")
    trips = standin.trips(spark, sf)
    split_days(spark, trips.withColumn("total_amount", F.col("total_amount") * 2), landing)
    _tick(spark, landing, lake, zones)
    try:
        replay_files(spark, _redrop(spark, trips, root, landing), lake, zones, fail_at="unpublished")
        raise ScenarioError("the stop did not surface")
    except InjectedFailure:
        pass
    during = _gold(spark, lake).withColumn("stage", F.lit("during"))
    _tick(spark, landing, lake, zones)
    return during.unionByName(_gold(spark, lake).withColumn("stage", F.lit("after")))


def replay_to_unknown_zone(spark, sf):
    """Every trip first has a known zone; the replay moves some to ids without one."""
    root, landing, lake, zones = _setup(spark, sf, "replay-zone")
    trips = standin.trips(spark, sf)
    split_days(spark, trips.withColumn("PULocationID", F.col("PULocationID") % 25), landing)
    _tick(spark, landing, lake, zones)
    replay_files(spark, _redrop(spark, trips, root, landing), lake, zones)
    return _gold(spark, lake)


def replay_empty_file(spark, sf):
    """A second copy of every day's trips is ingested; the copies are then replaced by empty files and replayed."""
    root, landing, lake, zones = _setup(spark, sf, "replay-empty")
    trips = standin.trips(spark, sf)
    split_days(spark, trips, landing)
    copies = split_days(spark, trips, landing, name_suffix=".copy")
    _tick(spark, landing, lake, zones)
    none = spark.createDataFrame([], RAW_TRIPS)
    for path in copies:
        fs.delete(spark, path, recursive=False)
        _write_one(spark, none, f"{root}/one/{path.rsplit('/', 1)[1]}", path)
    replay_files(spark, copies, lake, zones)
    return _gold(spark, lake)


def amount_overflow(spark, sf):
    """Two valid amounts of 9e15 join some cells: those are set aside, exact, and everything else goes through."""
    root, landing, lake, zones = _setup(spark, sf, "overflow")
    trips = standin.trips(spark, sf)
    huge = trips.where(F.col("event_id") % HUGE_EVERY == 0).withColumn("total_amount", F.lit(HUGE))
    split_days(spark, trips.unionByName(huge).unionByName(huge), landing)
    _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH)
    columns = ("zone", "date", "hour", F.col("total_amount").cast(WIDE).alias("total_amount"))
    named = read_table(spark, lake, "hour_denorm").select(*columns, F.lit(False).alias("beyond"))
    return named.unionByName(read_table(spark, lake, "overflow").select(*columns, F.lit(True).alias("beyond")))


def _of_kind(rows: DataFrame, kind: int) -> DataFrame:
    """A day's rows with the column types of one kind of file."""
    amount, zone = F.col("total_amount"), F.col("PULocationID")
    if kind == 1:
        return rows.withColumn("total_amount", amount.cast(MONEY).cast("string"))
    if kind == 2:
        return rows.withColumns({"PULocationID": zone.cast("int"), "total_amount": amount.cast("decimal(12,2)")})
    if kind == 3:
        return rows.withColumn("total_amount", amount.cast("bigint"))
    return rows.drop("total_amount") if kind == 4 else rows


def mixed_schemas(spark, sf):
    """Daily files of five schemas (usual, text amounts, INT ids with decimal amounts, BIGINT amounts, no amounts) in
    the same batches."""
    root, landing, lake, zones = _setup(spark, sf, "mixed-schemas")
    for path in split_days(spark, standin.trips(spark, sf), f"{root}/days"):
        name = path.rsplit("/", 1)[1]
        _write_one(spark, _of_kind(spark.read.parquet(path), int(name[8:10]) % KINDS), f"{root}/one/{name}", f"{landing}/{name}")
    rep = _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH)
    if rep.errors:
        raise ScenarioError(f"set aside: {rep.errors}")
    return _gold(spark, lake)


def bronze_copy(spark, sf):
    """The raw copy keeps every column that the files have (K1)."""
    root, landing, lake, zones = _setup(spark, sf, "bronze")
    events = standin.table(spark, sf, "events").select("event_id", F.col("user_id").alias("VendorID"), F.col("event_type").alias("store_and_fwd_flag"), (F.col("value") / 2).alias("fare_amount"))
    split_days(spark, standin.trips(spark, sf).join(events, "event_id"), landing)
    _tick(spark, landing, lake, zones, bronze=True, max_files_per_trigger=FILES_PER_BATCH)
    return read_table(spark, lake, "bronze")


def month_glob(spark, sf):
    """Rows per day of the files that a month's name pattern takes (S8); other files lie beside them."""
    root = scratch_dir(spark, "month-glob")
    trips = standin.trips(spark, sf)
    split_days(spark, trips, f"{root}/raw")
    split_days(spark, trips, f"{root}/raw", name_suffix=".old")
    return explore.rows_per_day(read_trips(spark, f"{root}/raw", glob_filter="2024-??-??.parquet"))


QUERIES = {
    "replay_changed_content": replay_changed_content,
    "replay_after_crash": replay_after_crash,
    "replay_to_unknown_zone": replay_to_unknown_zone,
    "read_during_rebuild": read_during_rebuild,
    "replay_empty_file": replay_empty_file,
    "amount_overflow": amount_overflow,
    "mixed_schemas": mixed_schemas,
    "bronze_copy": bronze_copy,
    "month_glob": month_glob,
}

_COLUMNS = {
    "VendorID": "user_id",
    "tpep_pickup_datetime": "ts",
    "PULocationID": "CAST(user_id % 30 AS BIGINT)",
    "store_and_fwd_flag": "event_type",
    "fare_amount": "value / 2",
    "total_amount": "value",
}

SQL = {
    **{name: oracle.HOUR_DENORM_SQL for name in ("replay_changed_content", "replay_after_crash", "replay_to_unknown_zone", "replay_empty_file")},
    "read_during_rebuild": oracle._with(oracle.SILVER, oracle.ZONES, oracle.DENORM) + """
SELECT zone, date, hour, CAST(SUM(total_amount) * k AS DECIMAL(18,2)) AS total_amount, stage
FROM denorm, (VALUES (2, 'during'), (1, 'after')) s(k, stage) GROUP BY zone, date, hour, k, stage""",
    "amount_overflow": oracle._with(oracle.SILVER, oracle.ZONES) + f"""
SELECT zone, date, hour, total_amount, total_amount > 9999999999999999.99 AS beyond FROM (
  SELECT zone, date, hour, CAST(SUM(CAST(amount AS DECIMAL(38,2))) AS DECIMAL(38,2)) AS total_amount FROM (
    SELECT date, hour, PULocationID, total_amount AS amount FROM silver
    UNION ALL
    SELECT date, hour, PULocationID, CAST({int(HUGE)} AS DECIMAL(18,2)) FROM silver, range(2) WHERE event_id % {HUGE_EVERY} = 0
  ) JOIN zones ON PULocationID = LocationID GROUP BY zone, date, hour)""",
    "mixed_schemas": oracle._with(oracle.SILVER, oracle.ZONES) + f"""
SELECT zone, date, hour, CAST(SUM(CASE day(date) % {KINDS} WHEN 3 THEN trunc(total_amount) WHEN 4 THEN 0 ELSE total_amount END) AS DECIMAL(18,2)) AS total_amount
FROM silver JOIN zones ON PULocationID = LocationID GROUP BY zone, date, hour""",
    "bronze_copy": "SELECT " + ", ".join(f"{_COLUMNS.get(f.name, 'NULL')} AS {f.name}" for f in RAW_TRIPS) + ", CONCAT(CAST(CAST(ts AS DATE) AS VARCHAR), '.parquet') AS source_file FROM events WHERE ts IS NOT NULL",
    "month_glob": oracle.ROWS_PER_DAY_SQL,
}
