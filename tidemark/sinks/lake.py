"""Lake layout, table reads with fixed schemas, partition-overwrite writes,
and the migrate / reset lifecycle (K2-K5, K11-K13).

No table here is ever read and overwritten in the same job: gold is rebuilt
from silver, serving from gold, so a write never races its own input.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.sinks import fs, publish


@dataclass(frozen=True)
class Lake:
    """Folder layout under one root (a shared path on a cluster)."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def bronze(self) -> str:
        return self.path("bronze/trips")

    @property
    def silver(self) -> str:
        return self.path("silver/trips")

    @property
    def quarantine(self) -> str:
        return self.path("silver/quarantine")

    @property
    def file_cells(self) -> str:
        return self.path("gold/file_cells")

    @property
    def cells(self) -> str:
        return self.path("gold/cells")

    @property
    def hour_denorm(self) -> str:
        return self.path("gold/hour_denorm")

    @property
    def overflow(self) -> str:
        return self.path("gold/overflow")

    @property
    def day_hours(self) -> str:
        return self.path("gold/day_hours")

    @property
    def serving(self) -> str:
        return self.path("serving/hourly")

    @property
    def ledger(self) -> str:
        return self.path("ledger/events")

    @property
    def checkpoint(self) -> str:
        return self.path("_checkpoints/ingest")

    @property
    def published(self) -> str:
        return self.path("gold/_published")

    @property
    def replays(self) -> str:
        return self.path("_replays")

    @property
    def archive(self) -> str:
        return self.path("archive")

    @property
    def errors(self) -> str:
        return self.path("errors")


#: Folders up to this many are looked up by name instead of listing the table.
LOOKED_UP = 3

# name -> (schema, partition columns)
TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "bronze": (schemas.BRONZE, ("source_file",)),
    "silver": (schemas.SILVER, ("p_date", "source_file")),
    "quarantine": (schemas.QUARANTINE, ("source_file",)),
    "file_cells": (schemas.FILE_CELLS, ("p_date", "source_file")),
    "cells": (schemas.CELLS, ("p_date",)),
    "hour_denorm": (schemas.HOUR_DENORM, ("p_date",)),
    "overflow": (schemas.OVERFLOW, ("p_date",)),
    "day_hours": (schemas.DAY_HOURS, ("p_date",)),
    "serving": (schemas.SERVING, ()),
    "ledger": (schemas.LEDGER, ("p_day",)),
}


def table_path(lake: Lake, name: str) -> str:
    return getattr(lake, name)


def read_table(spark: SparkSession, lake: Lake, name: str, pointer: dict | None = None) -> DataFrame:
    """Read a lake table with its fixed schema (works on an empty table too); a gold table as published (by ``pointer``)."""
    schema, _ = TABLES[name]
    if name in publish.GOLD and (pointer := pointer or publish.current(spark, lake.published)) is not None:
        return _read_published(spark, lake, name, pointer)
    path = serving_version(spark, lake) if name == "serving" else None
    return spark.read.schema(schema).parquet(path or table_path(lake, name))


def _read_published(spark: SparkSession, lake: Lake, name: str, pointer: dict, dates=None) -> DataFrame:
    schema, _ = TABLES[name]
    base = table_path(lake, name)
    paths = publish.paths(pointer, base, name, dates)
    if not paths:
        return empty(spark, name)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)


def gold_paths(lake: Lake) -> dict[str, str]:
    return {name: table_path(lake, name) for name in publish.GOLD}


def read_dates(spark: SparkSession, lake: Lake, name: str, dates, column: str = "p_date", pointer: dict | None = None) -> DataFrame:
    """Read only the given date folders of a date-partitioned table.

    A filter on the partition column also prunes, but Spark first lists every
    partition folder of the table; opening the folders by path keeps the cost
    of a batch or a point lookup independent of how much history the table
    holds. Folders that do not exist are skipped (an empty result if none do):
    a few are looked up one by one, of more one listing of the folder's names tells.
    A gold table's dates are those published (by ``pointer``, so that several tables
    can be read as they were at one time).
    """
    schema, _ = TABLES[name]
    if name in publish.GOLD:
        pointer = pointer or publish.current(spark, lake.published)
        if pointer is not None:
            return _read_published(spark, lake, name, pointer, dates)
    base = table_path(lake, name)
    names = {f"{column}={d.isoformat()}" for d in dates}
    if len(names) <= LOOKED_UP:
        paths = [p for p in (f"{base}/{n}" for n in sorted(names)) if fs.exists(spark, p)]
    else:
        paths = [p for p in fs.glob(spark, f"{base}/{column}=*") if p.rstrip("/").rsplit("/", 1)[-1] in names]
    if not paths:
        return empty(spark, name)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


def empty(spark: SparkSession, name: str) -> DataFrame:
    schema, _ = TABLES[name]
    return spark.createDataFrame([], schema)


def _conform(df: DataFrame, name: str) -> DataFrame:
    schema, _ = TABLES[name]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def overwrite_partitions(df: DataFrame, lake: Lake, name: str, path: str | None = None) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced.

    Set per write, not per session, so no other writer is affected. ``path`` is
    another folder than the table's, with the same layout.
    """
    _, parts = TABLES[name]
    (
        _conform(df, name)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*parts)
        .parquet(path or table_path(lake, name))
    )


def _serving_versions(spark: SparkSession, lake: Lake) -> list[str]:
    """Folders of the serving versions that are written in full, oldest first."""
    return [p.rsplit("/", 1)[0] for p in fs.glob(spark, f"{lake.serving}/version-*/_SUCCESS")]


def serving_version(spark: SparkSession, lake: Lake) -> str | None:
    """Folder of the newest complete serving version, None before the first."""
    return next(reversed(_serving_versions(spark, lake)), None)


def publish_serving(spark: SparkSession, lake: Lake, df: DataFrame) -> None:
    """Write the serving rows as a new version; readers see it once its write has committed.

    Nothing that a reader may hold is replaced in place. The version before stays for
    readers that have just picked it; older ones, and those a crash cut short, go.
    """
    done = _serving_versions(spark, lake)
    last = int(done[-1].rsplit("-", 1)[1]) if done else 0
    version = f"{lake.serving}/version-{max(time.time_ns(), last + 1):020d}"  # ascends if the clock steps back
    _conform(df, "serving").coalesce(1).write.parquet(version)
    keep = {p.rsplit("/", 1)[1] for p in [*done[-1:], version]}
    for path in fs.glob(spark, f"{lake.serving}/version-*"):
        if path.rsplit("/", 1)[1] not in keep:
            fs.delete(spark, path)


def append(df: DataFrame, lake: Lake, name: str) -> None:
    _, parts = TABLES[name]
    writer = _conform(df, name).write.mode("append")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(table_path(lake, name))


def compact_ledger(spark: SparkSession, lake: Lake, before) -> int:
    """Rewrite the ledger's day folders before ``before`` as one file per day.

    Every batch appends four small files; compaction keeps the file count per
    day at one. The rows are first checkpointed into ``spark.checkpoint.dir``
    (a reliable checkpoint on shared storage), which cuts the lineage to the
    files about to be replaced, then the days are overwritten in place.
    Returns the number of rows rewritten.
    """
    from tidemark.session import checkpoint_root

    checkpoint_root(spark)  # make sure a checkpoint folder is set
    old = read_table(spark, lake, "ledger").where(F.col("p_day") < F.lit(before))
    frozen = old.checkpoint(eager=True)
    n = frozen.count()
    if n:
        overwrite_partitions(frozen.repartition("p_day"), lake, "ledger")
    return n


def serving_zero(spark: SparkSession) -> DataFrame:
    """24 serving rows at zero (hours 0..23)."""
    return spark.range(24).select(
        F.col("id").cast("int").alias("hour"),
        F.lit(0.0).alias("revenue"),
        F.lit(0.0).alias("avg_revenue"),
        F.lit(0).cast("long").alias("n_days"),
    )


def migrate(spark: SparkSession, lake: Lake) -> list[str]:
    """Create every table that is absent; never touch one that exists.

    Returns the names created. Running it again is a no-op, so a restart does
    not zero the serving table while data is live.
    """
    created = []
    for name in TABLES:
        path = table_path(lake, name)
        if fs.exists(spark, path) and (name != "serving" or serving_version(spark, lake)):
            continue
        if name == "serving":
            publish_serving(spark, lake, serving_zero(spark))
        else:
            # An empty folder is an empty table: every read passes the schema.
            fs.mkdirs(spark, path)
        created.append(name)
    if "day_hours" in created and "cells" not in created:
        # a lake from before day_hours existed: derive it once from gold cells
        from tidemark.operators.gold import day_hour

        cells = read_table(spark, lake, "cells")
        if cells.limit(1).count():
            version, hours = publish.new_version(), day_hour(cells).withColumn("p_date", F.col("date"))
            overwrite_partitions(hours, lake, "day_hours", f"{lake.day_hours}/v={version}")
            dates = {r[0] for r in cells.select("p_date").distinct().collect()}
            publish.publish(spark, lake.published, gold_paths(lake), version, dates, {"day_hours": dates})
    return created


def reset(spark: SparkSession, lake: Lake) -> None:
    """Truncate all data, keep every table's schema.

    The streaming checkpoint is dropped as well, so files still in landing are
    seen as new on the next run, like after truncating the reference ledger.
    """
    fs.delete(spark, lake.published, recursive=True)
    for name in TABLES:
        if name == "serving":
            publish_serving(spark, lake, serving_zero(spark))
            continue
        if name in publish.GOLD:
            fs.delete(spark, table_path(lake, name))
            fs.mkdirs(spark, table_path(lake, name))
            continue
        _, parts = TABLES[name]
        writer = empty(spark, name).write.mode("overwrite").option("partitionOverwriteMode", "static")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(table_path(lake, name))
    fs.delete(spark, lake.checkpoint, recursive=True)
    fs.delete(spark, lake.replays, recursive=True)
