"""Landing folder -> lake, as a Structured Streaming job (M1-M9, K1, K9).

``run_ingest`` is one "tick": an ``availableNow`` trigger processes every file
that arrived since the last tick (in batches of at most
``max_files_per_trigger``) and stops. The checkpoint under the lake root holds
which file names were taken; a tick with nothing new creates no batch at all.

Exactly-once by name: the file source commits the files of batch N to its log
before the batch runs, and a batch that fails is re-run on the next tick with
the same id and the same files. ``process_batch`` only overwrites partitions,
so that re-run converges to the same tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import ledger
from tidemark.sinks import fs
from tidemark.sinks.lake import Lake, migrate, read_table
from tidemark.sources.trips import UNREADABLE, landing_stream, present, read_landed
from tidemark.streaming.batch import file_names, process_batch, stamp
from tidemark.streaming.replay import recover, replay


@dataclass
class TickReport:
    batches: list[dict] = field(default_factory=list)
    #: Names of the files set aside as unreadable.
    errors: list[str] = field(default_factory=list)
    #: Batches run, those of files without rows included.
    n_run: int = 0

    @property
    def n_batches(self) -> int:
        return len(self.batches)

    @property
    def files(self) -> list[str]:
        return [f for b in self.batches for f in b["files"]]


def run_ingest(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    zones: DataFrame,
    max_files_per_trigger: int | None = 50,
    archive: bool = False,
    fail_at: str | None = None,
    timeout_s: float | None = None,
    bronze: bool = False,
) -> TickReport:
    """Process all files that are new in ``landing`` and stop (one tick).

    ``fail_at`` makes the first batch of this tick raise after that stage
    (crash test); the error propagates, and the next tick resumes that batch.
    """
    report = TickReport()
    options = {"max_files_per_trigger": max_files_per_trigger, "archive": archive, "fail_at": fail_at, "bronze": bronze}
    while True:
        query = start_ingest(spark, landing, lake, zones, **options, report=report, available_now=True)
        try:
            finished = query.awaitTermination(timeout_s) if timeout_s else query.awaitTermination()
            if timeout_s and not finished:
                raise TimeoutError(f"ingest tick did not finish in {timeout_s}s")
            break
        except StreamingQueryException as e:
            injected = "InjectedFailure" in str(e)
            aside = [] if injected else set_aside_unreadable(spark, landing, lake, bronze)
            if not aside:
                raise
            report.errors += aside
        finally:
            if query.isActive:
                query.stop()
    if archive:
        archive_done(spark, landing, lake, set(report.files))
    return report


def unreadable(spark: SparkSession, paths: list[str], raw: bool = False) -> list[str]:
    """Of these files, those that cannot be read: halves that read in full are cleared
    together, so b such files among n cost about b log n reads."""
    if not paths:
        return []
    rows, copies, bad = read_landed(spark, paths, raw)
    try:
        for frame in (rows, copies):
            if frame is not None:
                frame.write.format("noop").mode("overwrite").save()
        return bad
    except (PySparkException, Py4JJavaError) as e:
        if not any(mark in str(e) for mark in UNREADABLE):
            raise
    half = len(paths) // 2
    return unreadable(spark, paths[:half], raw) + unreadable(spark, paths[half:], raw) if half else paths


def set_aside(spark: SparkSession, lake: Lake, paths: list[str]) -> list[str]:
    """Move files that cannot be read to the lake's errors folder, with an event in the ledger. Returns their names.

    Once mended, such a file comes in by ``replay_files``: its name is taken.
    """
    names = [p.rsplit("/", 1)[1] for p in paths]
    if names:
        stamp(file_names(spark, names), lake, ledger.FAILED, -1)
        fs.mkdirs(spark, lake.errors)
    for path, name in zip(paths, names, strict=True):
        if not fs.rename(spark, path, f"{lake.errors}/{name}"):
            raise OSError(f"{path} could not be moved to the errors folder")
    return names


def set_aside_unreadable(spark: SparkSession, landing: str, lake: Lake, bronze: bool = False) -> list[str]:
    """Set aside the landing files whose footer is sound but whose data is not, so that the other
    files of their batch go through.

    Runs only after a batch has failed to read a file, over the files that no batch has finished.
    """
    landed = spark.createDataFrame([(p.rsplit("/", 1)[1], p) for p in fs.list_files(spark, landing)], "file_path string, path string")
    done = ledger.latest_status(read_table(spark, lake, "ledger")).where(F.col("status") == ledger.STAGES[-1])
    waiting = landed.join(done, "file_path", "left_anti").select("path").collect()
    return set_aside(spark, lake, unreadable(spark, sorted(r["path"] for r in waiting), bronze))


def archive_done(spark: SparkSession, landing: str, lake: Lake, names: set[str]) -> None:
    """Move the tick's files that are still in landing to the archive.

    The source moves a batch's files when the next batch starts, so these are the
    last batch's, whose commit ended the tick: one rename each, as many as a batch holds.
    """
    left = [p for p in fs.list_files(spark, landing) if p.rsplit("/", 1)[1] in names]
    if left:
        fs.mkdirs(spark, lake.archive)
    for path in left:
        name = path.rsplit("/", 1)[1]
        if not fs.rename(spark, path, f"{lake.archive}/{name}"):
            raise OSError(f"{path} could not be moved to the archive")


def start_ingest(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    zones: DataFrame,
    max_files_per_trigger: int | None = 50,
    archive: bool = False,
    fail_at: str | None = None,
    bronze: bool = False,
    report: TickReport | None = None,
    available_now: bool = False,
    interval: str = "60 seconds",
) -> StreamingQuery:
    """Start the ingest query: every ``interval`` (the reference's 60 s cadence)
    or, with ``available_now``, once over what is there. Returns the query.

    A long-running query replaces an external scheduler: one driver, one
    checkpoint, one writer, and no JVM start per tick.
    """
    migrate(spark, lake)
    recover(spark, lake, zones)
    failed = {"done": False}

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        inject = None
        if fail_at and not failed["done"]:
            failed["done"] = True
            inject = fail_at
        recover(spark, lake, zones)
        paths = present(spark, sorted(r["path"] for r in batch_df.collect()))  # as many as a batch holds
        rows, raw, bad = read_landed(spark, paths, bronze)
        errors = set_aside(spark, lake, bad)
        files = [n for p in paths if (n := p.rsplit("/", 1)[1]) not in errors]
        out = process_batch(rows, batch_id, lake, zones, files, raw, fail_at=inject)
        if report is not None:
            report.n_run += 1
            report.errors += errors
            if out["files"]:
                report.batches.append(out)

    stream = landing_stream(
        spark,
        landing,
        max_files_per_trigger=max_files_per_trigger,
        archive_dir=lake.archive if archive else None,
    )
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", lake.checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def replay_files(spark: SparkSession, paths: list[str], lake: Lake, zones: DataFrame, batch_id: int = -1, fail_at: str | None = None) -> dict:
    """Explicit replay: re-read these files (changed content under known names)
    and replace everything they contributed (M5, D13 override), the raw copy
    included where one is kept. A file that is empty now contributes nothing;
    one that cannot be read leaves all as it was and is named in the error.
    ``fail_at`` is one of ``replay.POINTS``."""
    migrate(spark, lake)
    recover(spark, lake, zones)
    names = sorted({p.rstrip("/").rsplit("/", 1)[-1] for p in paths})
    kept_raw = bool(fs.glob(spark, f"{lake.bronze}/source_file=*"))
    rows, raw, bad = read_landed(spark, paths, kept_raw)
    if bad:
        raise ValueError(f"cannot be read: {', '.join(sorted(bad))}")
    return replay(spark, rows, raw, names, lake, zones, batch_id, fail_at)
