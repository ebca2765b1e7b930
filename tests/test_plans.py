"""Physical-plan assertions: pruning, pushdown, partition filters, broadcast,
map-side partial aggregation."""

from __future__ import annotations

import contextlib
import io
import re

from tests.fixtures import trip, write_day
from tidemark import api
from tidemark.operators import explore, gold
from tidemark.operators import silver as silver_op
from tidemark.plans import batch
from tidemark.sources import standin
from tidemark.sources.trips import read_trip_files

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hour_denorm_broadcasts_zones_and_aggregates_map_side(spark):
    p = plan(batch.hour_denorm(spark, SF))
    assert "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p
    # each exchange is fed by a partial aggregate (map-side combine)
    tree = p.split("\n\n")[0]
    assert len(re.findall(r"(?<!Broadcast)Exchange \(", tree)) == 2
    assert tree.count("HashAggregate") == 4
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_silver_scan_prunes_columns_and_pushes_null_filter(spark, tmp_path):
    f = write_day(tmp_path, "2019-01-01", [trip("2019-01-01 05:00:00", 1.0)])
    p = plan(silver_op.silver(read_trip_files(spark, [str(f)]), carry=("source_file",)))
    assert "IsNotNull(tpep_pickup_datetime)" in p
    m = re.search(r"ReadSchema: struct<([^>]*)>", p)
    cols = sorted(c.split(":")[0] for c in m.group(1).split(","))
    assert cols == ["PULocationID", "total_amount", "tpep_pickup_datetime"]


def test_total_revenue_reads_one_date_folder(spark, tmp_path, zones_csv):
    land = tmp_path / "land"
    for d in ("2019-01-01", "2019-01-02"):
        write_day(land, d, [trip(f"{d} 05:00:00", 1.0)])
    root = str(tmp_path / "lake")
    api.run_etl(spark, str(land), root, zones_csv)
    p = plan(api.total_revenue_df(spark, root, "2019-01-01", 5))
    assert re.search(r"PartitionFilters: \[.*p_date.*2019-01-01", p)
    # only that date's folder is listed, not the whole table
    loc = re.search(r"Location: InMemoryFileIndex \[([^\]]*)\]", p).group(1)
    assert "p_date=2019-01-01" in loc and "p_date=2019-01-02" not in loc


def test_month_filter_is_a_pushed_range(spark):
    p = plan(explore.month_filter(standin.monthly(spark, SF), "1996-03"))
    assert "GreaterThanOrEqual(o_orderdate,1996-03-01" in p
    assert "LessThan(o_orderdate,1996-04-01" in p


def test_reconcile_has_no_cross_join(spark):
    p = plan(gold.reconcile(batch.cells(spark, SF), batch.zones(spark, SF)))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "BroadcastHashJoin" in p


def test_grain_cardinality_folds_rows_before_distinct_counts(spark):
    p = plan(batch.grain_cardinality(spark, SF))
    tree = p.split("\n\n")[0]
    # the Expand for the distinct counts sits above the first (cell) aggregate
    assert tree.index("Expand") < tree.rindex("HashAggregate")


def test_gold_rebuild_reuses_the_date_partitioning(spark):
    from pyspark.sql import functions as F

    # as in rebuild_gold: folded cells, one partition set per date
    cells = batch.cells(spark, SF).withColumn("p_date", F.col("date")).repartition("p_date")
    day_hours = gold.day_hour_by_partition(cells)
    denorm = gold.hour_denorm(cells, F.broadcast(batch.zones(spark, SF))).repartition("p_date")
    for df in (day_hours, denorm):
        tree = plan(df).split("\n\n")[0]
        # only the cells' own exchanges (cell aggregation, repartition by p_date)
        assert len(re.findall(r"(?<!Broadcast)Exchange \(", tree)) == 2
