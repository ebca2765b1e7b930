"""Trip file sources: bulk read of named files (S1), a directory or glob
and the landing-folder stream (S5, M1, M2)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import plain_path
from tidemark.operators import silver as silver_op
from tidemark.schemas import BRONZE, RAW_TRIPS, TRIP_COLUMNS, TYPED
from tidemark.sinks import fs

# A backfilled file keeps its old mtime; with the 7-day default the stream would
# silently skip it once newer files were seen. Effectively: never age out.
NEVER_AGE_OUT = "36500d"

#: What Spark says of a file that a task cannot read (truncated, not Parquet).
UNREADABLE = ("FAILED_READ_FILE", "CANNOT_READ_FILE_FOOTER", "is not a Parquet file", "UNABLE_TO_INFER_SCHEMA")
#: And of files whose columns of one name have different types.
MIXED = ("CANNOT_MERGE", "Failed merging schema")
_LISTED = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def _with_source(df: DataFrame) -> DataFrame:
    """Add the file identity: the base name of the file a row came from."""
    return df.withColumn("source_file", plain_path("_metadata.file_name"))


def read_trip_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One scan over an explicit list of files (the reference's bulk read)."""
    return _with_source(spark.read.schema(RAW_TRIPS).parquet(*paths))


def read_trips(spark: SparkSession, path: str, glob_filter: str | None = None) -> DataFrame:
    """A folder (recursively, partition folders included) or a glob of trip files."""
    reader = spark.read.schema(RAW_TRIPS).option("recursiveFileLookup", "true")
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    return _with_source(reader.parquet(path))


def schemas_of(spark: SparkSession, paths: list[str]) -> tuple[dict[tuple, list[str]], list[str]]:
    """Files by the types of their columns, ((lower-case name, name, type), ...), and the files without a readable footer.

    The footers are read on the executors and merged there, in one job for files that agree; where
    they do not, the halves are asked, so b odd files among n cost about b log n jobs.
    """
    if not paths:
        return {}, []
    try:
        found = spark.read.option("mergeSchema", "true").parquet(*paths).schema
        return {tuple(sorted((f.name.lower(), f.name, f.dataType) for f in found)): list(paths)}, []
    except (PySparkException, Py4JJavaError) as e:
        if not any(mark in str(e) for mark in (*UNREADABLE, *MIXED)):
            raise
    if len(paths) == 1:
        return {}, list(paths)
    groups, bad = {}, []
    for half in (paths[: len(paths) // 2], paths[len(paths) // 2 :]):
        more, worse = schemas_of(spark, half)
        for key, files in more.items():
            groups.setdefault(key, []).extend(files)
        bad += worse
    return groups, bad


def _raw_rows(spark: SparkSession, types: tuple, paths: list[str], names) -> DataFrame:
    """These columns of files that have the same types, read as they are; a missing one is NULL of its usual type."""
    have = {low: (name, kind) for low, name, kind in types}
    usual = {f.name: f.dataType for f in RAW_TRIPS}
    schema = T.StructType([T.StructField(*have[n.lower()]) for n in names if n.lower() in have])
    rows = _with_source(spark.read.schema(schema).parquet(*paths))
    return rows.select(
        *[F.col(f"`{have[n.lower()][0]}`").alias(n) if n.lower() in have else F.lit(None).cast(usual[n]).alias(n) for n in names],
        "source_file",
    )


def read_landed(spark: SparkSession, paths: list[str], raw: bool = False) -> tuple[DataFrame, DataFrame | None, list[str]]:
    """(typed rows of all files, with ``raw`` also every raw column in its fixed type, the files that cannot be read).

    Files may differ in the types of their columns (an amount that is BIGINT or text, ids that are INT) and lack some:
    those of equal types are read together and cast by ``try_cast``, so what a value loses by its cast puts its row into
    the quarantine. A file goes to the unreadable ones only if it has no footer, or a type that no cast takes.
    """
    groups, bad = schemas_of(spark, paths)
    typed, copies = spark.createDataFrame([], TYPED), spark.createDataFrame([], BRONZE) if raw else None
    for types, files in groups.items():
        try:
            rows = silver_op.typed(_raw_rows(spark, types, files, TRIP_COLUMNS))
            if raw:
                every = _raw_rows(spark, types, files, RAW_TRIPS.names)
                copy = every.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW_TRIPS], "source_file")
        except AnalysisException as e:
            if "DATATYPE_MISMATCH" not in str(e):
                raise
            bad += files
            continue
        typed = typed.unionByName(rows)
        copies = copies.unionByName(copy) if raw else None
    return typed, copies, bad


def landing_stream(
    spark: SparkSession,
    landing: str,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """Streaming file source over the landing folder: the paths of the files that came.

    The files are listed, not read (their content is pruned): what they hold is read in the batch,
    whatever its types, and a batch knows its files even if they have no rows.

    * identity is the base file name (``fileNameOnly``): a name seen once is
      never read again, even if a file with that name lands again;
    * hidden files (``.x.parquet.inflight``) are ignored until renamed;
    * ``maxFilesPerTrigger`` bounds one micro-batch when a backlog piles up;
    * with ``archive_dir`` consumed files are moved out of landing (K9); the
      move happens when the next batch starts, so it lags one batch.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(_LISTED)
        .option("fileNameOnly", "true")
        .option("maxFileAge", NEVER_AGE_OUT)
        .option("latestFirst", "false")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(landing).select("path")


def present(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of a batch's files that are still there: one set aside by an earlier try of the batch is not."""
    return [p for p in paths if fs.exists(spark, p)]
