"""Queries that run the ingest job over landing files derived from the stand-in
tables, then read the lake back (SURVEY §2.12, second table).

Each call works in a fresh folder under the shared ``spark.checkpoint.dir``
(never a machine-local temp folder): the stand-in trips are split into one
file per day (``split_days``), the zone CSV is written from ``nation``, and the
streaming job ingests them. The returned DataFrame reads the resulting table;
most of them must equal the one-shot ``hour_denorm`` oracle, which is the
whole point: ticks, crashes, replays and late files converge to one batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import oracle
from tidemark.schemas import RAW_TRIPS
from tidemark.session import scratch_dir
from tidemark.sinks import fs
from tidemark.sinks.lake import TABLES, Lake, migrate, read_table, reset
from tidemark.sinks.split import split_days
from tidemark.sources import standin
from tidemark.sources.trips import read_trips
from tidemark.sources.zones import as_zones, read_zones_csv, write_zones_csv
from tidemark.streaming.batch import InjectedFailure
from tidemark.streaming.ingest import replay_files, run_ingest
from tidemark.operators import explore

# Fixed scenario parameters.
FILES_PER_BATCH = 10  # 30 daily files -> 3 micro-batches
LATE_FROM_HOUR = 12  # afternoon trips of every day arrive in a later file
TICK_TIMEOUT_S = 1800


class ScenarioError(AssertionError):
    """A scenario's own expectation (not the data) did not hold."""


def _setup(spark: SparkSession, sf: str, label: str):
    root = scratch_dir(spark, label)
    zones_csv = f"{root}/zones_csv"
    write_zones_csv(standin.zones(spark, sf), zones_csv)
    zones = as_zones(read_zones_csv(spark, zones_csv))
    return root, f"{root}/landing", Lake(f"{root}/lake"), zones


def _gold(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake, "hour_denorm").drop("p_date")


def _tick(spark, landing, lake, zones, **kw):
    return run_ingest(spark, landing, lake, zones, timeout_s=TICK_TIMEOUT_S, **kw)


def stream_ingest(spark, sf):
    """30 daily files, three micro-batches in one tick."""
    root, landing, lake, zones = _setup(spark, sf, "stream-ingest")
    split_days(spark, standin.trips(spark, sf), landing)
    rep = _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH)
    if rep.n_batches < 2:
        raise ScenarioError(f"expected several micro-batches, got {rep.n_batches}")
    return _gold(spark, lake)


def stream_noop(spark, sf):
    """A second tick with no new file creates no batch and changes nothing."""
    root, landing, lake, zones = _setup(spark, sf, "stream-noop")
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones)
    again = _tick(spark, landing, lake, zones)
    if again.n_batches:
        raise ScenarioError(f"no-op tick ran {again.n_batches} batches")
    return _gold(spark, lake)


def stream_replay_skip(spark, sf):
    """Files landing again under known names (other content, newer mtime) are ignored."""
    root, landing, lake, zones = _setup(spark, sf, "stream-replay-skip")
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones)
    changed = standin.trips(spark, sf).withColumn("total_amount", F.col("total_amount") * 2)
    redrop = f"{root}/redrop"
    for path in split_days(spark, changed, redrop):
        name = path.rsplit("/", 1)[1]
        fs.delete(spark, f"{landing}/{name}", recursive=False)
        fs.rename(spark, path, f"{landing}/{name}")
    again = _tick(spark, landing, lake, zones)
    if again.n_batches:
        raise ScenarioError("known file names were read again")
    return _gold(spark, lake)


def replay_idempotent(spark, sf):
    """Explicit replay of every file (same content) leaves gold unchanged."""
    root, landing, lake, zones = _setup(spark, sf, "replay")
    files = split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones)
    replay_files(spark, files, lake, zones)
    return _gold(spark, lake)


def crash_recovery(spark, sf):
    """The first batch fails after its gold write; the next tick resumes it."""
    root, landing, lake, zones = _setup(spark, sf, "crash")
    split_days(spark, standin.trips(spark, sf), landing)
    try:
        _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH, fail_at="gold")
    except Exception as e:  # the streaming query surfaces the batch error
        if "injected failure" not in str(e) and not isinstance(e, InjectedFailure):
            raise
    else:
        raise ScenarioError("the injected failure did not surface")
    _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH)
    return _gold(spark, lake)


def bad_file_isolated(spark, sf):
    """Two landing files are not Parquet: they go to the errors folder, all others through."""
    from tidemark.operators import ledger

    root, landing, lake, zones = _setup(spark, sf, "bad-file")
    split_days(spark, standin.trips(spark, sf), landing)
    broken = ["0000-first.parquet", "9999-last.parquet"]
    for name in broken:
        fs.write_text(spark, f"{landing}/{name}", "this is no parquet file")
    rep = _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH)
    events = ledger.latest_status(read_table(spark, lake, "ledger"), failed=ledger.FAILED)
    failed = sorted(r["file_path"] for r in events.where(F.col("status") == ledger.FAILED).collect())
    if not sorted(rep.errors) == failed == broken:
        raise ScenarioError(f"set aside: {rep.errors}, in the ledger: {failed}")
    return _gold(spark, lake)


def late_file_same_day(spark, sf):
    """Mornings land first; every afternoon arrives later as a second file of its day."""
    root, landing, lake, zones = _setup(spark, sf, "late")
    trips = standin.trips(spark, sf)
    split_days(spark, trips.where(F.hour("tpep_pickup_datetime") < LATE_FROM_HOUR), landing)
    _tick(spark, landing, lake, zones)
    split_days(
        spark, trips.where(F.hour("tpep_pickup_datetime") >= LATE_FROM_HOUR), landing, name_suffix=".late"
    )
    rep = _tick(spark, landing, lake, zones)
    if not rep.n_batches:
        raise ScenarioError("late files were not picked up")
    return _gold(spark, lake)


def stream_archive(spark, sf):
    """After a tick of several batches, every consumed file is in the archive and
    landing is empty. Returns the archived file names."""
    root, landing, lake, zones = _setup(spark, sf, "archive")
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH, archive=True)
    if fs.list_files(spark, landing):
        raise ScenarioError("consumed files are still in landing")
    archived = (
        spark.read.schema(RAW_TRIPS)
        .option("recursiveFileLookup", "true")
        .parquet(lake.archive)
        .select(F.col("_metadata.file_name").alias("file_name"))
        .distinct()
    )
    return archived


def split_days_query(spark, sf):
    """Split into daily files, read the folder back, count rows per day."""
    root = scratch_dir(spark, "split")
    split_days(spark, standin.trips(spark, sf), f"{root}/days")
    return explore.rows_per_day(read_trips(spark, f"{root}/days"))


def external_view(spark, sf):
    """SQL over the silver folder through a temporary view (no catalog table)."""
    root, landing, lake, zones = _setup(spark, sf, "external-view")
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones)
    view = f"silver_{fs_safe(root)}"
    read_table(spark, lake, "silver").createOrReplaceTempView(view)
    return spark.sql(f"SELECT date, hour, PULocationID, total_amount FROM {view}")


def fs_safe(path: str) -> str:
    return "".join(c if c.isalnum() else "_" for c in path.rsplit("/", 1)[-1])


def csv_zones(spark, sf):
    """Zone CSV round trip with a fixed schema."""
    root = scratch_dir(spark, "zones-csv")
    write_zones_csv(standin.zones(spark, sf), f"{root}/zones")
    return read_zones_csv(spark, f"{root}/zones").select("LocationID", "Zone")


def migrate_idempotent(spark, sf):
    """migrate() on a live lake changes nothing: serving keeps its values."""
    root, landing, lake, zones = _setup(spark, sf, "migrate")
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones)
    created = migrate(spark, lake)
    if created:
        raise ScenarioError(f"migrate re-created {created}")
    return read_table(spark, lake, "serving")


def serving_cold_start(spark, sf):
    """Serving is 24 zero rows on a fresh lake ('cold'), real values after the
    first tick, and stays so when migrate runs again ('live')."""
    root, landing, lake, zones = _setup(spark, sf, "cold-start")
    migrate(spark, lake)
    snapshot = f"{root}/cold_snapshot"
    read_table(spark, lake, "serving").write.mode("overwrite").parquet(snapshot)
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones)
    migrate(spark, lake)
    cold = spark.read.parquet(snapshot).withColumn("stage", F.lit("cold"))
    live = read_table(spark, lake, "serving").withColumn("stage", F.lit("live"))
    return cold.unionByName(live)


def _row_counts(spark: SparkSession, lake: Lake, column: str) -> DataFrame:
    """Rows of every table (of serving: hours with revenue)."""
    counts = None
    for name in TABLES:
        t = read_table(spark, lake, name)
        if name == "serving":
            t = t.where(F.col("revenue") != 0)
        c = t.agg(F.count(F.lit(1)).alias(column)).select(F.lit(name).alias("table_name"), column)
        counts = c if counts is None else counts.unionByName(c)
    return counts


def reset_tables(spark, sf):
    """reset() after a tick: rows of every table before it and after, schemas kept."""
    root, landing, lake, zones = _setup(spark, sf, "reset")
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones)
    _row_counts(spark, lake, "n_before").write.parquet(f"{root}/counts_before")
    reset(spark, lake)
    before = spark.read.parquet(f"{root}/counts_before")
    return before.join(_row_counts(spark, lake, "n_after"), "table_name")


def crash_status(spark, sf):
    """A tick whose only batch fails after its gold write: its files read 'gold', not 'done'."""
    from tidemark.operators.ledger import stage_times

    root, landing, lake, zones = _setup(spark, sf, "crash-status")
    split_days(spark, standin.trips(spark, sf), landing)
    try:
        _tick(spark, landing, lake, zones, fail_at="gold")
    except Exception as e:  # the streaming query surfaces the batch error
        if "injected failure" not in str(e):
            raise
    return stage_times(read_table(spark, lake, "ledger")).select(
        "file_path", "status", "attempts",
        F.col("status_gold_ts").isNotNull().alias("has_gold"), F.col("status_done_ts").isNotNull().alias("has_done"),
    )


def ledger_after_ingest(spark, sf):
    """Every ingested file ends in state 'done'."""
    from tidemark.operators.ledger import latest_status

    root, landing, lake, zones = _setup(spark, sf, "ledger")
    split_days(spark, standin.trips(spark, sf), landing)
    _tick(spark, landing, lake, zones, max_files_per_trigger=FILES_PER_BATCH)
    return latest_status(read_table(spark, lake, "ledger")).select("file_path", "status")


QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_noop": stream_noop,
    "stream_replay_skip": stream_replay_skip,
    "replay_idempotent": replay_idempotent,
    "crash_recovery": crash_recovery,
    "bad_file_isolated": bad_file_isolated,
    "late_file_same_day": late_file_same_day,
    "stream_archive": stream_archive,
    "split_days": split_days_query,
    "external_view": external_view,
    "csv_zones": csv_zones,
    "migrate_idempotent": migrate_idempotent,
    "serving_cold_start": serving_cold_start,
    "reset_tables": reset_tables,
    "ledger_after_ingest": ledger_after_ingest,
    "crash_status": crash_status,
}

SERVING_SQL = oracle._with(oracle.SILVER) + """,
per_hour AS (
  SELECT hour, SUM(total_amount) AS rev_sum, COUNT(DISTINCT date) AS n_days
  FROM silver GROUP BY hour
)
SELECT CAST(h.range AS INTEGER) AS hour,
       CAST(COALESCE(p.rev_sum, 0) AS DOUBLE) AS revenue,
       COALESCE(CAST(p.rev_sum AS DOUBLE) / p.n_days, 0.0) AS avg_revenue,
       COALESCE(p.n_days, 0) AS n_days
FROM range(24) h LEFT JOIN per_hour p ON h.range = p.hour"""

SQL = {
    "stream_ingest": oracle.HOUR_DENORM_SQL,
    "stream_noop": oracle.HOUR_DENORM_SQL,
    "stream_replay_skip": oracle.HOUR_DENORM_SQL,
    "replay_idempotent": oracle.HOUR_DENORM_SQL,
    "crash_recovery": oracle.HOUR_DENORM_SQL,
    "bad_file_isolated": oracle.HOUR_DENORM_SQL,
    "late_file_same_day": oracle.HOUR_DENORM_SQL,
    "split_days": oracle.ROWS_PER_DAY_SQL,
    "external_view": oracle.SILVER_COLUMNS_SQL,
    "csv_zones": "SELECT n_nationkey AS LocationID, n_name AS Zone FROM nation",
    "migrate_idempotent": SERVING_SQL,
    "serving_cold_start": """
SELECT CAST(range AS INTEGER) AS hour, CAST(0 AS DOUBLE) AS revenue, CAST(0 AS DOUBLE) AS avg_revenue,
       CAST(0 AS BIGINT) AS n_days, 'cold' AS stage
FROM range(24)
UNION ALL
SELECT *, 'live' AS stage FROM (""" + SERVING_SQL + ")",
    "reset_tables": oracle._with(oracle.SILVER, oracle.ZONES, oracle.DENORM) + """
SELECT table_name, CAST(n_before AS BIGINT) AS n_before, CAST(0 AS BIGINT) AS n_after FROM (
  SELECT 'bronze' AS table_name, 0 AS n_before
  UNION ALL SELECT 'silver', COUNT(*) FROM silver
  UNION ALL SELECT 'quarantine', 0
  UNION ALL SELECT 'overflow', 0
  UNION ALL SELECT 'file_cells', COUNT(*) FROM (SELECT DISTINCT date, hour, PULocationID FROM silver)
  UNION ALL SELECT 'cells', COUNT(*) FROM (SELECT DISTINCT date, hour, PULocationID FROM silver)
  UNION ALL SELECT 'hour_denorm', COUNT(*) FROM (SELECT DISTINCT zone, date, hour FROM denorm)
  UNION ALL SELECT 'day_hours', COUNT(*) FROM (SELECT DISTINCT date, hour FROM silver)
  UNION ALL SELECT 'serving', COUNT(*) FROM (SELECT hour FROM silver GROUP BY hour HAVING SUM(total_amount) <> 0)
  UNION ALL SELECT 'ledger', 4 * COUNT(DISTINCT date) FROM silver)""",
    "stream_archive": oracle._with(oracle.SILVER) + """
SELECT DISTINCT CONCAT(CAST(date AS VARCHAR), '.parquet') AS file_name FROM silver""",
    "crash_status": oracle._with(oracle.SILVER) + """
SELECT DISTINCT CONCAT(CAST(date AS VARCHAR), '.parquet') AS file_path, 'gold' AS status,
       CAST(1 AS BIGINT) AS attempts, TRUE AS has_gold, FALSE AS has_done FROM silver""",
    "ledger_after_ingest": oracle._with(oracle.SILVER) + """
SELECT DISTINCT CONCAT(CAST(date AS VARCHAR), '.parquet') AS file_path, 'done' AS status FROM silver""",
}
