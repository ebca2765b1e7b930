"""Replays, crashes and reruns end in what one run over the present files gives."""

from __future__ import annotations

import pytest

from tests.fixtures import trip, write_day, write_typed
from tidemark import api
from tidemark.sinks import fs
from tidemark.sinks.lake import Lake, read_table
from tidemark.sinks.split import split_days
from tidemark.sources.trips import read_trip_files
from tidemark.sources.zones import read_zones_csv
from tidemark.streaming.batch import InjectedFailure, pending_dates
from tidemark.streaming.replay import POINTS
from tidemark.streaming.ingest import replay_files


@pytest.mark.parametrize("point", [p for p in POINTS if p in ("staged", "first_leaf", "stale", "gold")])  # the query stops at all of them
def test_stopped_replay_is_finished_by_a_plain_tick(spark, landing, root, zones_csv, point):
    path = write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0), trip(None, 1.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    write_day(landing, "a", [trip("2022-02-02 06:00:00", 25.0)])
    lake, zones = Lake(root), api._zones(spark, zones_csv)
    with pytest.raises(InjectedFailure):
        replay_files(spark, [str(path)], lake, zones, fail_at=point)
    write_day(landing, "b", [trip("2022-02-03 06:00:00", 1.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    old, new = (10.0, 0.0) if point == "staged" else (0.0, 25.0)
    assert api.total_revenue(spark, root, "2022-02-01", 6) == old
    assert api.total_revenue(spark, root, "2022-02-02", 6) == new
    assert api.cumulative_revenue(spark, root, 6) == old + new + 1
    assert api.quarantine_df(spark, root).count() == (point == "staged")
    assert not fs.glob(spark, f"{lake.replays}/*")
    assert {r.status for r in api.ledger_status_df(spark, root).collect()} == ({"bronze", "done"} if point == "staged" else {"done"})


@pytest.mark.parametrize("name", ["a b", "a+b", "50%", "a%20b", "é=1", "it's"])
def test_replay_of_files_with_awkward_names(spark, landing, root, zones_csv, name):
    path = write_day(landing, "x", [trip("2022-02-01 06:00:00", 10.0)]).rename(landing / f"{name}.parquet")
    api.run_etl(spark, str(landing), root, zones_csv, bronze=True)
    assert {r.source_file for r in read_table(spark, Lake(root), "silver").collect()} == {path.name}
    write_day(landing, "x", [trip("2022-02-02 06:00:00", 1.0)]).rename(path)
    api.replay(spark, root, [str(path)], zones_csv)
    assert api.cumulative_revenue(spark, root, 6) == 1.0
    assert [r.source_file for t in ("silver", "bronze") for r in read_table(spark, Lake(root), t).collect()] == [path.name] * 2
    assert api.run_etl(spark, str(landing), root, zones_csv).n_batches == 0


def test_replay_of_an_unreadable_file_changes_nothing(spark, landing, root, zones_csv):
    path = write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    path.write_text("no parquet")
    with pytest.raises(ValueError, match="a.parquet"):
        api.replay(spark, root, [str(path)], zones_csv)
    assert api.cumulative_revenue(spark, root, 6) == 10.0


def test_sums_beyond_the_type_are_set_aside(spark, landing, root, zones_csv):
    write_day(landing, "a", [trip("2022-02-01 06:00:00", 9e15), trip("2022-02-01 06:10:00", 9e15), trip("2022-02-01 06:20:00", 5.0, 2)])
    write_day(landing, "b", [trip("2022-02-01 07:00:00", 2.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    assert [(r.zone, r.hour, str(r.total_amount)) for r in api.overflow_df(spark, root).collect()] == [("Alphabet City", 6, "18000000000000000.00")]
    assert sorted((r.zone, r.hour, float(r.total_amount)) for r in api.hour_denorm_df(spark, root).collect()) == [("Alphabet City", 7, 2.0), ("Jamaica Bay", 6, 5.0)]
    assert api.total_revenue(spark, root, "2022-02-01", 6) == 18e15 + 5
    assert api.cumulative_revenue(spark, root, 6) == 18e15 + 5 and api.reconcile_df(spark, root, zones_csv).first().balanced
    write_day(landing, "a", [trip("2022-02-01 06:00:00", 9e15)])  # it fits again
    api.replay(spark, root, [str(landing / "a.parquet")], zones_csv)
    assert api.overflow_df(spark, root).count() == 0 and api.total_revenue(spark, root, "2022-02-01", 6) == 9e15


def test_files_of_other_types_and_columns(spark, landing, root, zones_csv):
    types = "tpep_pickup_datetime TIMESTAMP, PULocationID INT, total_amount BIGINT"
    write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.5)])
    write_typed(landing, "b", types, [("2022-02-01 06:01:00", 1, 7)])
    write_typed(landing, "c", "tpep_pickup_datetime VARCHAR, pulocationid VARCHAR, total_amount VARCHAR", [("2022-02-01 06:02:00", "1", "1.25"), ("soon", "1", "2"), ("2022-02-01 06:02:00", "1", "much"), ("2022-02-01 06:02:00", "x", "3")])
    write_typed(landing, "d", "tpep_pickup_datetime TIMESTAMP WITH TIME ZONE, total_amount DECIMAL(9,3)", [("2022-02-01 06:03:00+00", "1.005")])
    write_typed(landing, "e", "tpep_pickup_datetime TIMESTAMP, PULocationID INT, total_amount STRUCT(v INT)", [("2022-02-01 06:04:00", 1, {"v": 1})])
    report = api.run_etl(spark, str(landing), root, zones_csv)
    assert report.errors == ["e.parquet"]
    got = sorted((r.source_file, r.PULocationID, str(r.total_amount)) for r in read_table(spark, Lake(root), "silver").collect())
    assert got == [("a.parquet", 1, "10.50"), ("b.parquet", 1, "7.00"), ("c.parquet", 1, "1.25"), ("d.parquet", None, "1.01")]
    assert sorted(r.reason for r in api.quarantine_df(spark, root).collect()) == ["bad_amount", "bad_location", "bad_pickup"]
    assert api.cumulative_revenue(spark, root, 6) == 19.76


@pytest.mark.parametrize("stage", ["silver", "gold"])
def test_crashed_replay_converges(spark, landing, root, zones_csv, stage):
    path = write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    write_day(landing, "a", [trip("2022-02-02 06:00:00", 25.0)])
    lake, zones = Lake(root), read_zones_csv(spark, zones_csv)
    with pytest.raises(InjectedFailure):
        replay_files(spark, [str(path)], lake, zones, fail_at=stage)
    assert fs.glob(spark, f"{lake.replays}/*.intent")
    api.replay(spark, root, [str(path)], zones_csv)
    assert api.cumulative_revenue(spark, root, 6) == 25.0
    assert api.total_revenue(spark, root, "2022-02-01", 6) == 0.0
    assert api.total_revenue(spark, root, "2022-02-02", 6) == 25.0
    assert not pending_dates(spark, lake)


def test_replay_to_an_unknown_zone_clears_the_named_cells(spark, landing, root, zones_csv):
    path = write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0, 77)])
    api.replay(spark, root, [str(path)], zones_csv)
    assert api.total_revenue(spark, root, "2022-02-01", 6) == 0.0
    assert api.cumulative_revenue(spark, root, 6) == 10.0


def test_replay_of_a_file_that_is_empty_now(spark, landing, root, zones_csv):
    path = write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0)])
    write_day(landing, "b", [trip("2022-02-01 06:30:00", 1.5)])
    api.run_etl(spark, str(landing), root, zones_csv)
    write_day(landing, "a", [])
    api.replay(spark, root, [str(path)], zones_csv)
    assert api.cumulative_revenue(spark, root, 6) == 1.5
    assert api.total_revenue(spark, root, "2022-02-01", 6) == 1.5


def test_replay_renews_the_raw_copy(spark, landing, root, zones_csv):
    path = write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv, bronze=True)
    write_day(landing, "a", [trip("2022-02-01 06:00:00", 99.0)])
    api.replay(spark, root, [str(path)], zones_csv)
    assert [r.total_amount for r in read_table(spark, Lake(root), "bronze").collect()] == [99.0]


def test_split_resumes_after_a_stop_between_days(spark, tmp_path):
    src = write_day(tmp_path, "month", [trip(f"2022-03-{d:02d} 0{h}:00:00", d + h / 4) for d in range(1, 6) for h in range(6)] + [trip("2022-04-01 00:00:00")])
    rows = read_trip_files(spark, [str(src)]).drop("source_file").repartition(3)
    out = str(tmp_path / "days")
    first = split_days(spark, rows, out, month="2022-03")
    assert len(first) == 5
    fs.delete(spark, first[2])
    again = split_days(spark, rows, out, month="2022-03")
    assert again == [first[2]]
    assert spark.read.parquet(out).count() == 30


def test_unreadable_files_do_not_hold_up_the_others(spark, landing, root, zones_csv):
    write_day(landing, "a", [trip("2022-02-01 06:00:00", 10.0)])
    whole = write_day(landing, "b", [trip("2022-02-01 07:00:00", 5.0)])
    kept = whole.read_bytes()
    whole.write_bytes(kept[: len(kept) // 2])
    write_day(landing, "c", [])
    report = api.run_etl(spark, str(landing), root, zones_csv)
    assert report.errors == ["b.parquet"]
    assert {r.file_path: r.status for r in api.ledger_status_df(spark, root).collect()} == {"a.parquet": "done", "b.parquet": "error", "c.parquet": "done"}
    assert [r["status"] for r in api.backlog_df(spark, root).collect()] == ["error"]
    assert api.cumulative_revenue(spark, root, 6) == 10.0
    assert not whole.exists()
    whole.write_bytes(kept)  # mended: its name is taken, so it comes in by a replay
    assert api.run_etl(spark, str(landing), root, zones_csv).n_run == 0
    api.replay(spark, root, [str(whole)], zones_csv)
    assert api.cumulative_revenue(spark, root, 7) == 5.0
    assert {r.status for r in api.ledger_status_df(spark, root).collect()} == {"done"}
