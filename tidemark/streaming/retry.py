"""Files that got stuck are tried again, a bounded number of times.

A file is stuck when its last ledger event is old and not ``done``: a batch that another writer left, a file set aside
because it could not be read, or one that vanished. Attempts are counted by the ledger (a ``bronze`` event each), so they
survive any stop. A try reads the file and, if that works, carries it through all stages as a replay, whose writes replace
whatever an earlier try left; a file whose last attempt failed ends in the errors folder with an ``error`` event.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.sinks import fs
from tidemark.sinks.lake import Lake, migrate, read_table
from tidemark.streaming.batch import file_names, stamp
from tidemark.streaming.ingest import replay_files, set_aside, unreadable
from tidemark.streaming.replay import recover

FILES_PER_CALL = 200


@dataclass
class RetryReport:
    #: Names of files that are through now, that wait for their next attempt, and that had their last one.
    done: list[str] = field(default_factory=list)
    waiting: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)


def due_files(events: DataFrame, now, older_than_minutes: int, max_attempts: int) -> DataFrame:
    """Stuck files that are not given up: file_path, status, last_ts, attempts."""
    given_up = (F.col("status") == ledger.FAILED) & (F.col("attempts") >= max_attempts)
    return ledger.stuck(events, now, older_than_minutes, failed=ledger.FAILED).where(~given_up)


def retry_stuck(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    zones: DataFrame,
    now: dt.datetime | None = None,
    older_than_minutes: int = 30,
    max_attempts: int = 3,
    max_files: int = FILES_PER_CALL,
) -> RetryReport:
    """Try the stuck files once more, those that wait longest first, at most ``max_files`` a call (the rest wait for the next).

    Call it between ticks: like a replay it is a writer. A file that cannot be found counts as one that cannot be read.
    """
    migrate(spark, lake)
    recover(spark, lake, zones)
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    due = due_files(read_table(spark, lake, "ledger"), now, older_than_minutes, max_attempts)
    due = due.orderBy("last_ts", "file_path").limit(max_files).collect()
    report = RetryReport()
    places = {r["file_path"]: _place(spark, landing, lake, r["file_path"]) for r in due}
    over = [r["file_path"] for r in due if r["attempts"] >= max_attempts]
    tried = [r["file_path"] for r in due if r["attempts"] < max_attempts]
    broken = set(unreadable(spark, sorted(p for n in tried if (p := places[n]))))
    failed = [n for n in tried if places[n] is None or places[n] in broken]
    good = [n for n in tried if n not in failed]
    if failed:
        stamp(file_names(spark, failed), lake, ledger.STAGES[0], -1)
        last = {r["file_path"] for r in due if r["attempts"] + 1 >= max_attempts}
        over += [n for n in failed if n in last]
        report.waiting = [n for n in failed if n not in last]
    if good:
        replay_files(spark, [places[n] for n in good], lake, zones)
        report.done = good
        for name in good:
            if places[name].startswith(_folder(spark, lake.errors)):
                fs.mkdirs(spark, lake.archive)
                fs.rename(spark, places[name], f"{lake.archive}/{name}")
    if over:
        _give_up(spark, lake, over, places)
        report.errors = over
    return report


def _folder(spark: SparkSession, path: str) -> str:
    """The path as listings show it."""
    return next(iter(fs.glob(spark, path)), path) + "/"


def _place(spark: SparkSession, landing: str, lake: Lake, name: str) -> str | None:
    """Where a file of this name lies; a mended one in the landing folder comes before the one set aside."""
    for folder in (landing.rstrip("/"), lake.errors, lake.archive):
        if fs.exists(spark, f"{folder}/{name}"):
            return _folder(spark, folder) + name
    return None


def _give_up(spark: SparkSession, lake: Lake, names: list[str], places: dict[str, str | None]) -> None:
    aside = _folder(spark, lake.errors)
    moved = [n for n in names if places[n] and not places[n].startswith(aside)]
    set_aside(spark, lake, [places[n] for n in moved])
    rest = [n for n in names if n not in moved]
    if rest:
        stamp(file_names(spark, rest), lake, ledger.FAILED, -1)
