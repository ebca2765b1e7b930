"""Cases the reference leaves untested: several ticks, late and re-landed
files, explicit replay, crashes, in-flight and backfilled files, unknown zones,
bad rows, empty cells, reset and migrate."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from tests.fixtures import trip, write_day
from tidemark import api
from tidemark.sinks.lake import Lake, read_table
from tidemark.streaming.ingest import run_ingest


def _cells(spark, root):
    rows = api.hour_denorm_df(spark, root).groupBy("date", "hour").agg(F.sum("total_amount").alias("v")).collect()
    return {(r["date"].isoformat(), r["hour"]): float(r["v"]) for r in rows}


def test_multi_tick_no_double_counting(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    write_day(landing, "2019-01-02", [trip("2019-01-02 05:20:00", 15.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.cumulative_revenue(spark, root, 5) == pytest.approx(25.0)
    assert api.avg_revenue(spark, root, 5) == pytest.approx(12.5)
    assert api.total_revenue(spark, root, "2019-01-01", 5) == pytest.approx(10.0)


def test_late_file_for_processed_day_adds(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    write_day(landing, "2019-01-02", [trip("2019-01-02 05:20:00", 15.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    write_day(landing, "late1", [trip("2019-01-01 06:00:00", 3.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    assert _cells(spark, root) == {("2019-01-01", 5): 10.0, ("2019-01-01", 6): 3.0, ("2019-01-02", 5): 15.0}


def test_same_name_again_is_ignored(spark, landing, root, zones_csv):
    p = write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    os.remove(p)
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 999.0)])
    rep = api.run_etl(spark, str(landing), root, zones_csv)
    assert rep.n_batches == 0
    assert api.total_revenue(spark, root, "2019-01-01", 5) == pytest.approx(10.0)


def test_explicit_replay_replaces_only_that_file(spark, landing, root, zones_csv):
    a = write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0), trip("2019-01-02 07:00:00", 4.0)])
    write_day(landing, "2019-01-02", [trip("2019-01-02 05:20:00", 15.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    assert _cells(spark, root)[("2019-01-02", 7)] == 4.0
    os.remove(a)
    # new content: 05h changes, the stray 2019-01-02 row is gone
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 12.0)])
    api.replay(spark, root, [str(a)], zones_csv)
    assert _cells(spark, root) == {("2019-01-01", 5): 12.0, ("2019-01-02", 5): 15.0}
    # replaying the same content again changes nothing
    api.replay(spark, root, [str(a)], zones_csv)
    assert _cells(spark, root) == {("2019-01-01", 5): 12.0, ("2019-01-02", 5): 15.0}
    assert api.cumulative_revenue(spark, root, 5) == pytest.approx(27.0)


def test_replay_that_empties_a_date_clears_gold(spark, landing, root, zones_csv):
    a = write_day(landing, "x", [trip("2019-02-01 05:00:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    os.remove(a)
    write_day(landing, "x", [trip("2019-02-02 05:00:00", 10.0)])
    api.replay(spark, root, [str(a)], zones_csv)
    assert _cells(spark, root) == {("2019-02-02", 5): 10.0}
    cells = read_table(spark, Lake(root), "cells").select("date").distinct().collect()
    assert [r["date"].isoformat() for r in cells] == ["2019-02-02"]
    day_hours = read_table(spark, Lake(root), "day_hours").select("date").distinct().collect()
    assert [r["date"].isoformat() for r in day_hours] == ["2019-02-02"]


@pytest.mark.parametrize("stage", ["silver", "gold"])
def test_crash_then_rerun_equals_one_shot(spark, tmp_path, zones_csv, stage):
    land = tmp_path / "land"
    for d in range(1, 7):
        day = f"2019-01-0{d}"
        write_day(land, day, [trip(f"{day} 0{d}:10:00", 10.0 * d), trip(f"{day} 0{d}:40:00", 1.0, location=2)])
    crashed, oneshot = str(tmp_path / "crashed"), str(tmp_path / "oneshot")
    zones = api._zones(spark, zones_csv)
    with pytest.raises(Exception, match="injected failure"):
        run_ingest(spark, str(land), Lake(crashed), zones, max_files_per_trigger=2, fail_at=stage)
    # the ledger shows the crashed files as not done
    status = {r["file_path"]: r["status"] for r in api.ledger_status_df(spark, crashed).collect()}
    assert status and all(s != "done" for s in status.values())
    run_ingest(spark, str(land), Lake(crashed), zones, max_files_per_trigger=2)
    run_ingest(spark, str(land), Lake(oneshot), zones)
    assert _cells(spark, crashed) == _cells(spark, oneshot)
    status = {r["file_path"]: r["status"] for r in api.ledger_status_df(spark, crashed).collect()}
    assert len(status) == 6 and set(status.values()) == {"done"}
    s1 = sorted(tuple(r) for r in api.serving_df(spark, crashed).collect())
    s2 = sorted(tuple(r) for r in api.serving_df(spark, oneshot).collect())
    assert s1 == s2


def test_inflight_file_waits_until_renamed(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    p = write_day(landing, "tmp", [trip("2019-01-02 05:10:00", 15.0)])
    hidden = landing / ".2019-01-02.parquet.inflight"
    os.rename(p, hidden)
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.total_revenue(spark, root, "2019-01-02", 5) == 0.0
    os.rename(hidden, landing / "2019-01-02.parquet")
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.total_revenue(spark, root, "2019-01-02", 5) == pytest.approx(15.0)


def test_backfilled_file_with_old_mtime_is_ingested(spark, landing, root, zones_csv):
    write_day(landing, "2019-05-01", [trip("2019-05-01 05:10:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    old = write_day(landing, "2017-01-01", [trip("2017-01-01 05:10:00", 7.0)])
    long_ago = time.time() - 3 * 365 * 86400
    os.utime(old, (long_ago, long_ago))
    rep = api.run_etl(spark, str(landing), root, zones_csv)
    assert rep.n_batches == 1
    assert api.total_revenue(spark, root, "2017-01-01", 5) == pytest.approx(7.0)


def test_unknown_zone_is_reported_and_reconciled(spark, landing, root, zones_csv):
    write_day(
        landing,
        "2019-01-01",
        [trip("2019-01-01 05:10:00", 10.0, 1), trip("2019-01-01 05:20:00", 5.0, 99), trip("2019-01-01 05:30:00", 1.0, 2)],
    )
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.total_revenue(spark, root, "2019-01-01", 5) == pytest.approx(11.0)  # zone 99 not in denorm
    assert api.cumulative_revenue(spark, root, 5) == pytest.approx(16.0)  # but in the hourly total
    lost = api.unmatched_zones_df(spark, root, zones_csv).collect()
    assert [(r["PULocationID"], r["n"], float(r["total_amount"])) for r in lost] == [(99, 1, 5.0)]
    rec = api.reconcile_df(spark, root, zones_csv).first()
    assert rec["balanced"] and float(rec["total_all"]) == 16.0 and float(rec["total_unmatched"]) == 5.0


def test_zone_ids_sharing_a_name_merge(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 2.0, 2), trip("2019-01-01 05:20:00", 3.0, 3)])
    api.run_etl(spark, str(landing), root, zones_csv)
    rows = api.hour_denorm_df(spark, root).collect()
    assert [(r["zone"], float(r["total_amount"])) for r in rows] == [("Jamaica Bay", 5.0)]
    assert api.total_revenue(spark, root, "2019-01-01", 5, zone="Jamaica Bay") == pytest.approx(5.0)


def test_bad_rows_are_quarantined_and_batch_succeeds(spark, landing, root, zones_csv):
    write_day(
        landing,
        "2019-01-01",
        [
            trip("2019-01-01 05:10:00", 10.0),
            trip(None, 4.0),
            trip("2019-01-01 05:20:00", 1e20),  # does not fit DECIMAL(18,2)
            trip("2019-01-01 05:30:00", None),  # NULL amount stays (summed as nothing)
            trip("2019-01-01 05:40:00", -2.5),  # negative amounts stay
        ],
    )
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.total_revenue(spark, root, "2019-01-01", 5) == pytest.approx(7.5)
    q = sorted((r["reason"], r["source_file"]) for r in api.quarantine_df(spark, root).collect())
    assert q == [("bad_amount", "2019-01-01.parquet"), ("null_pickup", "2019-01-01.parquet")]


def test_empty_cell_is_zero(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.total_revenue(spark, root, "2019-01-01", 6) == 0.0
    assert api.total_revenue(spark, root, "2020-01-01", 5) == 0.0


def test_hour_is_wall_clock_on_dst_change_day(spark, landing, root, zones_csv):
    write_day(landing, "2019-03-10", [trip("2019-03-10 02:30:00", 5.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.total_revenue(spark, root, "2019-03-10", 2) == pytest.approx(5.0)


def test_migrate_is_idempotent_and_serving_starts_at_zero(spark, root):
    created = api.migrate(spark, root)
    assert "serving" in created
    assert api.migrate(spark, root) == []
    rows = api.serving_df(spark, root).collect()
    assert len(rows) == 24 and all(r["revenue"] == 0.0 for r in rows)
    assert api.avg_revenue(spark, root, 3) == 0.0


def test_reset_truncates_and_allows_reingest(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    api.reset(spark, root)
    assert api.total_revenue(spark, root, "2019-01-01", 5) == 0.0
    assert api.avg_revenue(spark, root, 5) == 0.0
    assert api.ledger_status_df(spark, root).count() == 0
    rep = api.run_etl(spark, str(landing), root, zones_csv)
    assert rep.n_batches == 1
    assert api.total_revenue(spark, root, "2019-01-01", 5) == pytest.approx(10.0)


def test_archive_moves_consumed_files(spark, landing, root, zones_csv):
    for d in range(1, 5):
        write_day(landing, f"2019-01-0{d}", [trip(f"2019-01-0{d} 05:10:00", 1.0)])
    api.run_etl(spark, str(landing), root, zones_csv, max_files_per_trigger=2, archive=True)
    # the source moves a batch's files as the next one starts, the tick's end the last batch's
    assert not [p.name for p in landing.iterdir() if p.suffix == ".parquet"]
    assert api.cumulative_revenue(spark, root, 5) == pytest.approx(4.0)


def test_stuck_files_report(spark, tmp_path, zones_csv):
    import datetime as dt

    land = tmp_path / "land"
    write_day(land, "2019-01-01", [trip("2019-01-01 05:10:00", 1.0)])
    root = str(tmp_path / "lake")
    with pytest.raises(Exception, match="injected failure"):
        run_ingest(spark, str(land), Lake(root), api._zones(spark, zones_csv), fail_at="silver")
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(minutes=5)
    stuck = api.stuck_files_df(spark, root, later, older_than_minutes=1).collect()
    assert [(r["file_path"], r["status"], r["attempts"]) for r in stuck] == [("2019-01-01.parquet", "silver", 1)]  # the last stage written
    assert [tuple(r) for r in api.backlog_df(spark, root).collect()] == [("silver", 1)]


def test_ledger_compaction_keeps_rows_and_cuts_files(spark, landing, root, zones_csv):
    import datetime as dt
    import glob

    for d in range(1, 4):
        write_day(landing, f"2019-01-0{d}", [trip(f"2019-01-0{d} 05:10:00", 1.0)])
        api.run_etl(spark, str(landing), root, zones_csv)
    before = sorted(tuple(r) for r in api.ledger_status_df(spark, root).collect())
    n_files = len(glob.glob(f"{root}/ledger/events/p_day=*/*.parquet"))
    assert n_files >= 6
    tomorrow = dt.datetime.now(dt.timezone.utc).date() + dt.timedelta(days=1)
    assert api.compact_ledger(spark, root, tomorrow) == 12  # 3 files x 4 states
    assert len(glob.glob(f"{root}/ledger/events/p_day=*/*.parquet")) <= 2  # one per day (UTC midnight may split)
    assert sorted(tuple(r) for r in api.ledger_status_df(spark, root).collect()) == before


def test_day_hours_follow_cells_and_feed_serving(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0), trip("2019-01-01 05:40:00", 2.0, location=999)])
    write_day(landing, "2019-01-02", [trip("2019-01-02 05:20:00", 15.0), trip("2019-01-02 07:00:00", 4.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    lake = Lake(root)
    rows = read_table(spark, lake, "day_hours").collect()
    # unmatched zones are included: day_hours is over all trips
    assert {(r["date"].isoformat(), r["hour"]): float(r["revenue"]) for r in rows} == {
        ("2019-01-01", 5): 12.0,
        ("2019-01-02", 5): 15.0,
        ("2019-01-02", 7): 4.0,
    }
    assert all(r["p_date"] == r["date"] for r in rows)
    assert api.cumulative_revenue(spark, root, 5) == pytest.approx(27.0)
    assert api.avg_revenue(spark, root, 5) == pytest.approx(13.5)


def test_migrate_derives_missing_day_hours_from_cells(spark, landing, root, zones_csv):
    import shutil

    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    shutil.rmtree(Lake(root).day_hours)  # a lake written before the table existed
    assert api.migrate(spark, root) == ["day_hours"]
    rows = read_table(spark, Lake(root), "day_hours").collect()
    assert [(r["date"].isoformat(), r["hour"], float(r["revenue"])) for r in rows] == [("2019-01-01", 5, 10.0)]


def test_serving_reads_survive_a_rewrite_in_progress(spark, landing, root, zones_csv):
    import glob

    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    # a batch that is writing, or that stopped before its write was committed
    unfinished = f"{Lake(root).serving}/version-{2**63 - 1:020d}"
    os.makedirs(f"{unfinished}/_temporary")
    api._SERVING_CACHE.pop(root, None)
    assert api.avg_revenue(spark, root, 5) == pytest.approx(10.0)  # a reader that has read nothing before
    assert api.avg_revenue_df(spark, root).count() == 24
    held = api.serving_df(spark, root)
    # the next batch publishes a new version; who holds the one before can still read it
    write_day(landing, "2019-01-02", [trip("2019-01-02 05:20:00", 20.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    assert api.avg_revenue(spark, root, 5) == pytest.approx(15.0)
    assert held.where("hour = 5").first()["avg_revenue"] == pytest.approx(10.0)
    assert not os.path.exists(unfinished) and len(glob.glob(f"{Lake(root).serving}/version-*")) == 2


def test_stage_times_ties_and_attempts(spark):
    import datetime as dt

    from tidemark.operators import ledger

    t = [dt.datetime(2019, 1, 1, 0, m) for m in range(6)]
    events = [("a", "bronze", t[0]), ("a", "silver", t[1]), ("a", "bronze", t[2]), ("a", "silver", t[2]),
              ("b", "bronze", t[0]), ("b", "done", t[3]), ("b", "gold", t[3]), ("c", "bronze", t[4]), ("c", "other", t[5])]
    df = spark.createDataFrame(events, "file_path string, status string, ts timestamp_ntz")
    got = {r["file_path"]: (r["status"], r["attempts"], r["status_silver_ts"]) for r in ledger.stage_times(df).collect()}
    assert got == {"a": ("silver", 2, t[2]), "b": ("done", 1, None), "c": (None, 1, None)}
    plan = ledger.stage_times(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
