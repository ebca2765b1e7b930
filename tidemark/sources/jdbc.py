"""JDBC source and sink (S4), for a store that keeps a copy of the aggregates.

The pipeline itself never needs it: stored totals live in the lake's gold
tables. These helpers exist for users who mirror gold into a SQL store. They
are not exercised by the tests, since no database may be started here.

Reads are split into ``num_partitions`` ranges of ``partition_column`` so no
single task pulls a whole table; writes go out in batches from every task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in properties.items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 1))
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "overwrite") -> None:
    """Write ``df``; ``overwrite`` + ``truncate`` keeps the table's DDL."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", "true")
    writer = writer.option("batchsize", "1000")
    for key, value in properties.items():
        writer = writer.option(key, value)
    writer.mode(mode).save()
