"""File ledger operators.

The ledger is an append-only event table ``(file_path, status, ts, batch_id)``.
The current state of a file is its latest event, so an insert-or-update never
has to rewrite anything, and a batch retried after a crash that appends the
same events twice still gives the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ntz

#: Stages of a file, in order; an event is one of them.
STAGES = ("bronze", "silver", "gold", "done")
#: Event of a file that could not be read and was set aside.
FAILED = "error"


def stage_times(events: DataFrame, stages: tuple[str, ...] = STAGES, failed: str | None = None) -> DataFrame:
    """Per file: status, last_ts, attempts and ``status_<stage>_ts``, the last time of each stage (K7, M9).

    The status is the stage of the last event; of several at one time, the later
    stage. ``attempts`` counts the events of the first stage, so a file that was
    entered twice (a retried or replayed batch) shows it. All buffers have a
    fixed width, so events are hashed, not sorted. An event of no stage counts
    for last_ts alone, and a file whose last event is such has no status; the event
    ``failed`` is a status too, below the stages of its time, but has no column.
    """
    times = {s: f"status_{s}_ts" for s in stages}
    marks = times | ({failed: "_failed_ts"} if failed else {})
    per_file = events.groupBy("file_path").agg(
        F.max("ts").alias("last_ts"),
        F.count_if(F.col("status") == F.lit(stages[0])).alias("attempts"),
        *[F.max(F.when(F.col("status") == F.lit(s), F.col("ts"))).alias(c) for s, c in marks.items()],
    )
    ranked = [*reversed(stages), *([failed] if failed else [])]
    status = F.coalesce(*[F.when(F.col(marks[s]) == F.col("last_ts"), F.lit(s)) for s in ranked])
    return per_file.select("file_path", status.alias("status"), "last_ts", "attempts", *times.values())


def latest_status(events: DataFrame, stages: tuple[str, ...] = STAGES, failed: str | None = None) -> DataFrame:
    """Current status and time of the last event per file (K7, K8)."""
    return stage_times(events, stages, failed).select("file_path", "status", "last_ts")


def backlog(events: DataFrame, stages: tuple[str, ...] = STAGES, failed: str | None = None) -> DataFrame:
    """Files per current state, those in the last stage excluded."""
    return latest_status(events, stages, failed).where(F.col("status") != F.lit(stages[-1])).groupBy("status").agg(
        F.count(F.lit(1)).alias("n_files")
    )


def stuck(events: DataFrame, now, older_than_minutes: int, stages: tuple[str, ...] = STAGES, failed: str | None = None) -> DataFrame:
    """Files not in the last stage whose last event is older than the threshold."""
    cutoff = ntz(now) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(older_than_minutes))
    per_file = stage_times(events, stages, failed).select("file_path", "status", "last_ts", "attempts")
    return per_file.where((F.col("status") != F.lit(stages[-1])) & (F.col("last_ts") < cutoff))


def known_names(ledger: DataFrame, archived: DataFrame | None = None) -> DataFrame:
    """Distinct file names already in the ledger or the archive."""
    names = ledger.select("file_path")
    if archived is not None:
        names = names.unionByName(archived.select("file_path"))
    return names.distinct()


def new_files(landing: DataFrame, ledger: DataFrame, archived: DataFrame | None = None) -> DataFrame:
    """Landing files in neither the ledger nor the archive (J3): an anti join,
    so the ledger may be any size."""
    return landing.join(known_names(ledger, archived), "file_path", "left_anti")


def known_files(landing: DataFrame, ledger: DataFrame, archived: DataFrame | None = None) -> DataFrame:
    """Landing files already known."""
    return landing.join(known_names(ledger, archived), "file_path", "left_semi")
