"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings results depend on. UTC keeps hour() of a timestamp_ntz pickup equal
# to the wall-clock hour on daylight-saving change days.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app: str = "tidemark",
    shuffle_partitions: int = 8,
    extra: dict | None = None,
) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass the cluster's own
    settings through spark-submit; only the keys in SESSION_CONF matter here."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and is visible to every executor.
    Where it is unset, a local master (tests) gets a folder of our own, registered
    so that ``DataFrame.checkpoint()`` and scratch writes work too; any other
    master is refused, as its executors could not read that folder.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            conf_dir = None
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # getCheckpointDir() adds a per-application folder; use its parent.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith(("local[", "local*")) and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tidemark-scratch/{label}-{uuid.uuid4().hex[:12]}"
