"""The silver folder as a table of the catalog (S7), for SQL users beside the pipeline.

The table is external: dropping it leaves the data. Its partitions are those of the folder when they were last brought up
to date, so a reader gets whole partitions only, prunes by the catalog, and lists no folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.sinks.lake import TABLES, Lake, table_path


def _quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def silver_table(spark: SparkSession, lake: Lake, table: str, name: str = "silver") -> None:
    """Create ``table`` over the folder of a lake table if it is absent; add its new partitions, drop those that are gone."""
    schema, parts = TABLES[name]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    place = table_path(lake, name).replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({columns}) USING parquet PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)}) LOCATION '{place}'")
    spark.sql(f"MSCK REPAIR TABLE {_quoted(table)} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
