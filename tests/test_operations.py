"""Days split into parts, and retries of stuck files."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.fixtures import trip, write_day
from tidemark import api
from tidemark.operators import ledger
from tidemark.sinks import fs
from tidemark.sinks.lake import Lake, read_table
from tidemark.sinks.split import COMPLETE, LISTING, complete_days, read_day_parts, split_day_parts
from tidemark.streaming.batch import file_names, stamp

LATER = dt.datetime(2100, 1, 1)


def _raw(spark, tmp_path, rows):
    return spark.read.parquet(str(write_day(tmp_path / "raw", "raw", rows)))


def test_a_hot_day_of_equal_rows_gets_many_parts(spark, tmp_path):
    raw = _raw(spark, tmp_path, [trip("2022-02-01 06:00:00")] * 900 + [trip("2022-02-02 06:00:00")] * 50 + [trip(None)] * 5)
    out = str(tmp_path / "days")
    assert [p.rsplit("=", 1)[1] for p in split_day_parts(spark, raw, out, 100)] == ["2022-02-01", "2022-02-02"]
    assert complete_days(spark, out) == {"2022-02-01": 9, "2022-02-02": 1}
    sizes = [r["count"] for r in read_day_parts(spark, out).where("d = '2022-02-01'").groupBy("part").count().collect()]
    assert len(sizes) == 9 and sum(sizes) == 900 and max(sizes) < 200
    assert read_day_parts(spark, out).columns == [*raw.columns, "d", "part"]
    assert split_day_parts(spark, raw, out, 100) == []


def test_small_parts_share_tasks(spark, tmp_path):
    raw = _raw(spark, tmp_path, [trip(f"2022-02-0{1 + i % 3} 06:00:00", float(i)) for i in range(900)])
    out, listing = str(tmp_path / "days"), spark.conf.get(LISTING)
    split_day_parts(spark, raw, out, 10)
    assert complete_days(spark, out) == {f"2022-02-0{k}": 30 for k in (1, 2, 3)}
    files = fs.glob(spark, f"{out}/d=*/part=*/*.parquet")
    assert len(files) > 80 and len({re.search(r"/part-(\d+)-", f).group(1) for f in files}) <= spark.sparkContext.defaultParallelism
    read = read_day_parts(spark, out)
    assert spark.conf.get(LISTING) == listing
    assert sorted(r[0] for r in read.select("total_amount").collect()) == [float(i) for i in range(900)]


def test_days_without_a_marker_are_written_anew(spark, tmp_path):
    raw = _raw(spark, tmp_path, [trip(f"2022-02-0{1 + i % 3} 06:00:00", float(i)) for i in range(90)])
    out = str(tmp_path / "days")
    assert read_day_parts(spark, out) is None
    with pytest.raises(OSError, match="injected"):
        split_day_parts(spark, raw, out, 10, fail_at="unmarked")
    assert read_day_parts(spark, out) is None
    assert len(split_day_parts(spark, raw, out, 10)) == 3
    fs.delete(spark, f"{out}/d=2022-02-02/{COMPLETE}")
    assert read_day_parts(spark, out).count() == 60
    assert [p.rsplit("=", 1)[1] for p in split_day_parts(spark, raw, out, 10)] == ["2022-02-02"]
    assert read_day_parts(spark, out).agg(F.sum("total_amount")).first()[0] == sum(range(90))


def test_an_empty_month_gives_no_days(spark, tmp_path):
    raw = _raw(spark, tmp_path, [trip("2022-02-01 06:00:00")])
    assert split_day_parts(spark, raw, str(tmp_path / "days"), month="2022-03") == []


def test_stuck_and_lost_files_are_tried_and_given_up(spark, landing, root, zones_csv):
    write_day(landing, "2022-02-01", [trip("2022-02-01 06:00:00", 4.0)])
    write_day(landing, "2022-02-02", [trip("2022-02-02 06:00:00", 5.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    lake = Lake(root)
    # another writer left one file at silver; one is known by name alone
    stamp(file_names(spark, ["2022-02-02.parquet"]), lake, "bronze", 7)
    stamp(file_names(spark, ["lost.parquet"]), lake, "bronze", 7)
    kw = {"now": LATER, "max_attempts": 4}
    report = api.retry_stuck(spark, root, str(landing), zones_csv, **kw)
    assert (report.done, report.waiting, report.errors) == (["2022-02-02.parquet"], ["lost.parquet"], [])
    assert api.total_revenue(spark, root, "2022-02-02", 6) == 5.0
    assert api.retry_stuck(spark, root, str(landing), zones_csv, **kw).waiting == ["lost.parquet"]
    assert api.retry_stuck(spark, root, str(landing), zones_csv, **kw).errors == ["lost.parquet"]
    left = api.retry_stuck(spark, root, str(landing), zones_csv, **kw)
    assert not left.done and not left.waiting and not left.errors
    states = {r.file_path: r.status for r in ledger.latest_status(read_table(spark, lake, "ledger"), failed=ledger.FAILED).collect()}
    assert states == {"2022-02-01.parquet": "done", "2022-02-02.parquet": "done", "lost.parquet": "error"}


def test_a_fresh_event_is_not_stuck(spark, landing, root, zones_csv):
    api.migrate(spark, root)
    stamp(file_names(spark, ["new.parquet"]), Lake(root), "bronze", 1)
    report = api.retry_stuck(spark, root, str(landing), zones_csv)
    assert not report.waiting and not report.errors


def test_a_mended_file_set_aside_goes_to_the_archive(spark, landing, root, zones_csv):
    (landing / "2022-02-01.parquet").write_text("no trips")
    api.run_etl(spark, str(landing), root, zones_csv)
    lake = Lake(root)
    write_day(lake.errors, "2022-02-01", [trip("2022-02-01 06:00:00", 4.0)])
    for crc in fs.glob(spark, f"{lake.errors}/.*.crc"):
        fs.delete(spark, crc)
    assert api.retry_stuck(spark, root, str(landing), zones_csv, now=LATER).done == ["2022-02-01.parquet"]
    assert fs.exists(spark, f"{lake.archive}/2022-02-01.parquet") and not fs.list_files(spark, lake.errors)
    assert api.total_revenue(spark, root, "2022-02-01", 6) == 4.0
