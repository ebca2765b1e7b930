"""Silver -> gold aggregates and the checks around them.

Plan shape. Every gold answer derives from *cells*, the revenue per
``(date, hour, PULocationID)``. Building cells is the only step that touches
trip rows: a partial hash aggregate runs map-side, so each task ships at most
one row per cell and a zone holding a third of all trips costs no more shuffle
than any other. Everything after that (zone join, hour totals, averages,
reconciliation) works on a table bounded by days x 24 x zone ids, so the zone
join never sees a skewed fact side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import money_sum, wide_sum
from tidemark.schemas import MONEY


CELL_KEYS = ("date", "hour", "PULocationID")


def cells(silver: DataFrame, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Revenue and trip count per (date, hour, zone id) [and ``extra_keys``]."""
    return silver.groupBy(*CELL_KEYS, *extra_keys).agg(
        wide_sum("total_amount").alias("total_amount"),
        F.count(F.lit(1)).alias("n_trips"),
    )


def fold_cells(partials: DataFrame) -> DataFrame:
    """Sum partial cells (e.g. one set per source file) into cells."""
    return partials.groupBy(*CELL_KEYS).agg(
        wide_sum("total_amount").alias("total_amount"),
        F.sum("n_trips").alias("n_trips"),
    )


def hour_denorm(cells_df: DataFrame, zones: DataFrame) -> DataFrame:
    """Revenue per (zone name, date, hour); trips of unknown zones drop out.

    Grouping is by the zone *name*, so ids that share a name are merged. Lake
    cells carry ``p_date`` (= ``date``); grouping on it keeps their
    ``p_date`` partitioning through a broadcast join, so no shuffle is needed.
    Whether the zones are broadcast is left to Spark's own size check
    (``autoBroadcastJoinThreshold``, and AQE at run time). Sums of lake cells stay
    wide; :func:`fits` tells which of them the contract's type can hold.
    """
    z = zones.select(F.col("LocationID").cast("int").alias("LocationID"), F.col("zone"))
    joined = cells_df.join(z, cells_df["PULocationID"] == z["LocationID"], "inner")
    if "p_date" in cells_df.columns:
        out = joined.groupBy("zone", "p_date", "hour").agg(wide_sum("total_amount").alias("total_amount"))
        return out.withColumn("date", F.col("p_date"))
    return joined.groupBy("zone", "date", "hour").agg(money_sum("total_amount").alias("total_amount"))


def fits(value: str = "total_amount") -> Column:
    """Whether a wide sum is one that DECIMAL(18,2) can hold."""
    return F.col(value).try_cast(MONEY).isNotNull()


def unmatched(cells_df: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone ids with no zone row, with their trips and revenue."""
    ids = zones.select(F.col("LocationID").cast("int").alias("LocationID"))
    lost = cells_df.join(ids, cells_df["PULocationID"] == ids["LocationID"], "left_anti")
    return lost.groupBy("PULocationID").agg(
        F.sum("n_trips").alias("n"),
        money_sum("total_amount").alias("total_amount"),
    )


def day_hour(cells_df: DataFrame) -> DataFrame:
    """Revenue per (date, hour) over all trips (A4)."""
    return cells_df.groupBy("date", "hour").agg(money_sum("total_amount").alias("revenue"))


def day_hour_by_partition(cells_df: DataFrame) -> DataFrame:
    """``day_hour`` of cells that carry ``p_date`` (= ``date``), grouped on
    ``p_date``: cells already hash-partitioned by ``p_date`` need no shuffle,
    and the result keeps that partitioning for a one-file-per-date write."""
    return (
        cells_df.groupBy("p_date", "hour")
        .agg(wide_sum("total_amount").alias("revenue"))
        .withColumn("date", F.col("p_date"))
    )


def hourly(cells_df: DataFrame) -> DataFrame:
    """Cumulative revenue per hour of day over all trips (A1)."""
    return cells_df.groupBy("hour").agg(money_sum("total_amount").alias("revenue"))


def avg_by_hour(day_hour_df: DataFrame) -> DataFrame:
    """Average hourly revenue per hour of day over the observed (date, hour) cells.

    ``day_hour`` has one row per observed cell, so the row count per hour is the
    number of distinct dates that hour was seen on; no COUNT DISTINCT needed.
    """
    return day_hour_df.groupBy("hour").agg(
        (F.sum("revenue").cast("double") / F.count(F.lit(1))).alias("avg_revenue"),
    )


def hour_state(day_hour_df: DataFrame) -> DataFrame:
    """Mergeable running state per hour: (revenue sum, observed cells)."""
    return day_hour_df.groupBy("hour").agg(
        F.sum("revenue").alias("rev_sum"),
        F.count(F.lit(1)).alias("n_cells"),
    )


def merge_state(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two running states; valid when they cover disjoint dates."""
    return a.unionByName(b).groupBy("hour").agg(
        F.sum("rev_sum").alias("rev_sum"),
        F.sum("n_cells").alias("n_cells"),
    )


def state_avg(state: DataFrame) -> DataFrame:
    return state.select(
        "hour",
        (F.col("rev_sum").cast("double") / F.col("n_cells")).alias("avg_revenue"),
    )


def merge_totals(stored: DataFrame, batch: DataFrame, key: str = "hour", value: str = "revenue") -> DataFrame:
    """Stored totals + batch totals by key, as a full outer join with COALESCE."""
    s = stored.select(F.col(key).alias("k_s"), F.col(value).alias("v_s"))
    b = batch.select(F.col(key).alias("k_b"), F.col(value).alias("v_b"))
    j = s.join(b, s["k_s"] == b["k_b"], "full_outer")
    out = j.select(
        F.coalesce("k_s", "k_b").alias(key),
        (F.coalesce("v_s", F.lit(0)) + F.coalesce("v_b", F.lit(0))).try_cast(MONEY).alias(value),
    )
    return out.where(F.col(key).isNotNull())


def additive_merge(stored: DataFrame, batch: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Aggregate-key table semantics: rows with equal keys are summed."""
    cols = [*keys, value]
    return (
        stored.select(*cols)
        .unionByName(batch.select(*cols))
        .groupBy(*keys)
        .agg(money_sum(value).alias(value))
    )


def reconcile(cells_df: DataFrame, zones: DataFrame) -> DataFrame:
    """Conservation check: all revenue = zone-matched revenue + unmatched revenue (V3).

    ``total_matched`` is what the inner zone join of hour_denorm carries (a
    cell counts once per zone row with its id), ``total_unmatched`` what the
    anti join finds; a duplicated zone id or a lost row shows up as
    ``balanced = false``. One pass over cells, one broadcast of zone ids.
    """
    per_id = zones.groupBy(F.col("LocationID").cast("int").alias("LocationID")).agg(F.count(F.lit(1)).alias("k"))
    j = cells_df.join(per_id, cells_df["PULocationID"] == per_id["LocationID"], "left")
    one = j.agg(
        wide_sum("total_amount").alias("total_all"),
        wide_sum(F.col("total_amount") * F.col("k")).alias("total_matched"),
        wide_sum(F.when(F.col("k").isNull(), F.col("total_amount"))).alias("total_unmatched"),
    )
    balanced = F.col("total_all") == (F.col("total_matched") + F.col("total_unmatched"))
    return one.select(*(F.col(c).try_cast(MONEY).alias(c) for c in one.columns), balanced.alias("balanced"))

