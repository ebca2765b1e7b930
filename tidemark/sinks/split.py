"""Split a multi-day trip file into one landing file per calendar day.

Rows are dealt by day, so a day comes out of one task as one file in a hidden
staging folder and is published by one rename: a day is there as a whole or not
at all. Days whose file exists are skipped, so a rerun after a stop at any point
adds just what is missing. A month is a range on the raw timestamp, which Parquet
can push down.

``split_day_parts`` is the form for days of any size: a day is a folder of parts of
about ``rows_per_part`` rows, written by tasks of one part or, where parts are small,
of about ROWS_PER_TASK rows, and counts as there once its completion marker is.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import PICKUP, ntz, pickup_date
from tidemark.operators.explore import month_range
from tidemark.sinks import fs

RENAME_THREADS = 16
ROWS_PER_PART = 4_000_000
#: Parts of fewer rows share a task, as every task sends some kB of metrics to the driver, however little it writes.
ROWS_PER_TASK = 250_000
#: Tasks that list a day's parts; Spark's own number is one a part.
LISTING_TASKS = 16
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: A table of one row a day is broadcast up to so many days (about 1 MB), and joined as Spark chooses beyond.
BROADCAST_DAYS = 50_000
#: Marker in a day's folder, written last; it holds the number of parts.
COMPLETE = "_COMPLETE"

_DAY_DIR = re.compile(r"/d=(\d{4}-\d{2}-\d{2})/[^/]+$")


def existing_days(spark: SparkSession, out_dir: str, name_suffix: str = "") -> set[str]:
    """Days published under the names that ``name_suffix`` gives."""
    named = re.compile(rf"/(\d{{4}}-\d{{2}}-\d{{2}}){re.escape(name_suffix)}\.parquet$")
    return {m.group(1) for p in fs.list_files(spark, out_dir) if (m := named.search(p))}


def _dated(raw: DataFrame, pickup: str, month: str | None) -> DataFrame:
    """The rows that have a pickup time (in that month), with their day as ``d``."""
    rows = raw.where(F.col(pickup).isNotNull())
    if month:
        start, end = month_range(month)
        rows = rows.where((F.col(pickup) >= ntz(start)) & (F.col(pickup) < ntz(end)))
    return rows.withColumn("d", pickup_date(pickup))


def _move(spark: SparkSession, moves: list[tuple[str, str]]) -> None:
    """One rename a day; issued concurrently, since on an object store each is a server-side copy."""
    with ThreadPoolExecutor(max_workers=max(1, min(RENAME_THREADS, len(moves)))) as pool:
        done = list(pool.map(lambda m: fs.rename(spark, *m), moves))
    if not all(done):
        failed = [src for (src, _), ok in zip(moves, done) if not ok]
        raise OSError(f"could not move {len(failed)} staged file(s), e.g. {failed[0]}")


def split_days(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    pickup: str = PICKUP,
    month: str | None = None,
    name_suffix: str = "",
) -> list[str]:
    """Write ``raw`` as daily files into ``out_dir``; return the new file paths.

    ``month`` (``yyyy-MM``) keeps only that month's rows, as a monthly source
    file may carry a few stray days of its neighbours. Rows without a pickup
    time are not written.
    """
    rows = _dated(raw, pickup, month)
    skip = sorted(existing_days(spark, out_dir, name_suffix))
    if skip:
        rows = rows.where(~F.col("d").cast("string").isin(skip))
    stage = f"{out_dir.rstrip('/')}/_staging-{uuid.uuid4().hex[:12]}"
    rows.repartition("d").write.mode("overwrite").partitionBy("d").parquet(stage)
    written = {m.group(1): path for path in fs.glob(spark, f"{stage}/d=*/*.parquet") if (m := _DAY_DIR.search(path))}
    moves = [(src, f"{out_dir.rstrip('/')}/{day}{name_suffix}.parquet") for day, src in sorted(written.items())]
    _move(spark, moves)
    fs.delete(spark, stage, recursive=True)
    return [dst for _, dst in moves]


def complete_days(spark: SparkSession, out_dir: str) -> dict[str, int]:
    """Number of parts of each day whose parts are all published."""
    found = fs.glob(spark, f"{out_dir.rstrip('/')}/d=*/{COMPLETE}")
    return {p.rsplit("/", 2)[1].removeprefix("d="): int(fs.read_text(spark, p) or 0) for p in found}


def split_day_parts(
    spark: SparkSession,
    raw: DataFrame,
    out_dir: str,
    rows_per_part: int = ROWS_PER_PART,
    pickup: str = PICKUP,
    month: str | None = None,
    fail_at: str | None = None,
) -> list[str]:
    """Write ``raw`` as ``<out_dir>/d=<day>/part=<k>/`` with about ``rows_per_part`` rows a part; return the new days' folders.

    A count of rows a day (one row a day, also the driver's) says how many parts a day gets; its rows are dealt to them by
    a hash of their place in ``raw``, so neither a hot day nor rows that are all equal end in one task. ``raw`` has to give
    its rows in the same order when a task is run again, as a scan of files does. A day is published by one rename and then
    its marker; a day without one, left by a stop, is written anew. What tasks send to the driver grows with days, with
    rows / ROWS_PER_TASK (by some kB) and with parts (by their names). ``fail_at='unmarked'`` stops there (tests).
    """
    base = out_dir.rstrip("/")
    rows = _dated(raw.withColumn("_place", F.xxhash64(F.monotonically_increasing_id())), pickup, month)
    skip = sorted(complete_days(spark, out_dir))
    if skip:
        rows = rows.where(~F.col("d").cast("string").isin(skip))
    counted = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / F.lit(rows_per_part)).cast("int").alias("parts")).collect()
    if not counted:
        return []
    sizes = spark.createDataFrame([(r["d"], r["parts"]) for r in counted], "d date, parts int")
    tasks = max(-(-sum(r["n"] for r in counted) // ROWS_PER_TASK), spark.sparkContext.defaultParallelism)
    dealt = rows.join(F.broadcast(sizes) if len(counted) <= BROADCAST_DAYS else sizes, "d")
    dealt = dealt.withColumn("part", F.pmod("_place", F.col("parts")).cast("int")).drop("_place", "parts")
    stage = f"{base}/_staging-{uuid.uuid4().hex[:12]}"
    # an explicit number of partitions: adaptive execution does not put the parts of a day back into one task
    dealt.repartition(min(tasks, sum(r["parts"] for r in counted)), "d", "part").write.mode("overwrite").partitionBy("d", "part").parquet(stage)
    days = {r["d"].isoformat(): r["parts"] for r in counted}
    for day in days:
        fs.delete(spark, f"{base}/d={day}")  # unmarked, or not there
    _move(spark, [(f"{stage}/d={day}", f"{base}/d={day}") for day in sorted(days)])
    if fail_at == "unmarked":
        raise OSError("injected stop before the markers")
    for day, parts in days.items():
        fs.write_text(spark, f"{base}/d={day}/{COMPLETE}", str(parts))
    fs.delete(spark, stage, recursive=True)
    return [f"{base}/d={day}" for day in sorted(days)]


def read_day_parts(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """Rows of the complete days, with ``d`` and ``part``; None where there is none."""
    base = out_dir.rstrip("/")
    days = sorted(complete_days(spark, out_dir))
    if not days:
        return None
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), LISTING_TASKS)))
    try:
        return spark.read.option("basePath", base).parquet(*[f"{base}/d={day}" for day in days])
    finally:
        spark.conf.set(LISTING, before)
