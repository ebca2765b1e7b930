"""Queries over operations that run beside the ticks: days split into parts, retries of stuck files.

Set up like :mod:`tidemark.plans.scenarios`, over the whole stand-in trips.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.plans import oracle
from tidemark.plans.scenarios import ScenarioError, _setup, _tick
from tidemark.session import scratch_dir
from tidemark.sinks import fs
from tidemark.sinks.lake import read_table
from tidemark.sinks.split import read_day_parts, split_day_parts, split_days
from tidemark.sources import standin
from tidemark.streaming.retry import retry_stuck

# Fixed values of the scenarios.
ROWS_PER_PART = 200
HOT_DAY, HOT_EVERY = "2024-01-15", 3  # every third trip is moved to this day
BROKEN_EVERY, BROKEN_AT, NEVER_AT = 7, 3, 5  # files broken by their day of the month; those of NEVER_AT stay so
ATTEMPTS = 3


def split_day_parts_query(spark, sf):
    """Rows and parts of each day, a third of all rows on one day, after a stop between the days' renames and their markers."""
    out = f"{scratch_dir(spark, 'day-parts')}/days"
    hot = F.pmod("event_id", F.lit(HOT_EVERY)) == 0
    trips = standin.trips(spark, sf)
    trips = trips.withColumn("tpep_pickup_datetime", F.when(hot, F.lit(dt.datetime.fromisoformat(HOT_DAY)).cast("timestamp_ntz")).otherwise(F.col("tpep_pickup_datetime")))
    try:
        split_day_parts(spark, trips, out, ROWS_PER_PART, fail_at="unmarked")
    except OSError:
        if read_day_parts(spark, out) is not None:
            raise ScenarioError("days without a marker are read") from None
    first = split_day_parts(spark, trips, out, ROWS_PER_PART)
    if split_day_parts(spark, trips, out, ROWS_PER_PART) or not first:
        raise ScenarioError("complete days are written once")
    rows = read_day_parts(spark, out)
    return rows.groupBy(F.col("d").cast("date").alias("date")).agg(F.count("*").alias("n_rows"), F.countDistinct("part").alias("n_parts"))


def retry_until_error(spark, sf):
    """Status, attempts and silver rows of each file: broken files are set aside by a tick and tried again; those mended
    after the first attempt are through with the second, the others are given up with the third."""
    root, landing, lake, zones = _setup(spark, sf, "retry")
    whole = split_days(spark, standin.trips(spark, sf), landing)
    aside = {}
    for path in whole:
        name = path.rsplit("/", 1)[1]
        if int(name[8:10]) % BROKEN_EVERY in (BROKEN_AT, NEVER_AT):
            aside[name] = f"{root}/whole/{name}"
            fs.mkdirs(spark, f"{root}/whole")
            fs.rename(spark, path, aside[name])
            fs.write_text(spark, path, "no trips")
    _tick(spark, landing, lake, zones)
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(days=1)

    def again():
        return retry_stuck(spark, landing, lake, zones, now=later, max_attempts=ATTEMPTS)

    if again().waiting != sorted(aside):
        raise ScenarioError("files that cannot be read wait for their next attempt")
    for name, kept in aside.items():
        if int(name[8:10]) % BROKEN_EVERY == BROKEN_AT:
            fs.rename(spark, kept, f"{landing}/{name}")
    second, third, fourth = again(), again(), again()
    if set(second.done) | set(third.errors) != set(aside) or fourth.done or fourth.waiting or fourth.errors:
        raise ScenarioError("mended files are through with the next attempt, the others given up with the last")
    state = ledger.stage_times(read_table(spark, lake, "ledger"), failed=ledger.FAILED)
    state = state.select("file_path", "status", F.col("attempts").cast("int").alias("attempts"))
    held = read_table(spark, lake, "silver").groupBy(F.col("source_file").alias("file_path")).agg(F.count("*").alias("n"))
    return state.join(held, "file_path", "left").select("file_path", "status", "attempts", F.coalesce("n", F.lit(0)).cast("long").alias("n_rows"))


QUERIES = {"split_day_parts": split_day_parts_query, "retry_until_error": retry_until_error}

SQL = {
    "split_day_parts": f"""
SELECT date, COUNT(*) AS n_rows, CAST(CEIL(COUNT(*) / {ROWS_PER_PART}.0) AS BIGINT) AS n_parts
FROM (SELECT CASE WHEN event_id % {HOT_EVERY} = 0 THEN DATE '{HOT_DAY}' ELSE CAST(ts AS DATE) END AS date FROM events WHERE ts IS NOT NULL OR event_id % {HOT_EVERY} = 0) t
GROUP BY date""",
    "retry_until_error": oracle._with(oracle.SILVER) + f"""
, days AS (SELECT CAST(ts AS DATE) AS d FROM events WHERE ts IS NOT NULL GROUP BY 1)
SELECT strftime(d, '%Y-%m-%d') || '.parquet' AS file_path,
  CASE WHEN day(d) % {BROKEN_EVERY} = {NEVER_AT} THEN 'error' ELSE 'done' END AS status,
  CASE day(d) % {BROKEN_EVERY} WHEN {NEVER_AT} THEN {ATTEMPTS} WHEN {BROKEN_AT} THEN 2 ELSE 1 END AS attempts,
  CASE WHEN day(d) % {BROKEN_EVERY} = {NEVER_AT} THEN 0 ELSE (SELECT COUNT(*) FROM silver WHERE date = d) END AS n_rows
FROM days""",
}
