"""Sources and sinks: split_days, CSV zones, bronze copy, continuous trigger,
file-name parsing."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import trip, write_day, write_typed
from tidemark import api
from tidemark.operators import explore
from tidemark.schemas import RAW_TRIPS
from tidemark.sinks.lake import Lake, read_table
from tidemark.sinks.split import split_days
from tidemark.sources.trips import read_trip_files, read_trips
from tidemark.sources.zones import read_zones_csv, write_zones_csv


def test_split_days_one_file_per_day_and_skips_existing(spark, tmp_path):
    src = write_day(
        tmp_path / "raw",
        "yellow_tripdata_2019-02",
        [
            trip("2019-01-31 23:50:00", 1.0),  # stray day of the previous month
            trip("2019-02-01 05:00:00", 2.0),
            trip("2019-02-01 06:00:00", 3.0),
            trip("2019-02-02 07:00:00", 4.0),
            trip(None, 5.0),
        ],
    )
    out = str(tmp_path / "days")
    raw = read_trip_files(spark, [str(src)])
    written = split_days(spark, raw, out, month="2019-02")
    assert sorted(p.rsplit("/", 1)[1] for p in written) == ["2019-02-01.parquet", "2019-02-02.parquet"]
    assert split_days(spark, raw.drop("source_file"), out, month="2019-02") == []
    per_day = {r["date"].isoformat(): r["n"] for r in explore.rows_per_day(read_trips(spark, out)).collect()}
    assert per_day == {"2019-02-01": 2, "2019-02-02": 1}


def test_split_by_glob(spark, tmp_path):
    for m in ("01", "02"):
        write_day(tmp_path / "raw", f"yellow_tripdata_2019-{m}", [trip(f"2019-{m}-03 05:00:00", 1.0)])
    write_day(tmp_path / "raw", "other_2019-03", [trip("2019-03-03 05:00:00", 1.0)])
    df = read_trips(spark, str(tmp_path / "raw"), glob_filter="yellow_tripdata_2019-*")
    assert sorted(r["source_file"] for r in df.select("source_file").collect()) == [
        "yellow_tripdata_2019-01.parquet",
        "yellow_tripdata_2019-02.parquet",
    ]


def test_zone_csv_round_trip(spark, tmp_path, zones_csv):
    z = read_zones_csv(spark, zones_csv)
    assert z.schema["LocationID"].dataType.simpleString() == "int"
    write_zones_csv(z, str(tmp_path / "z2"))
    back = sorted(tuple(r) for r in read_zones_csv(spark, str(tmp_path / "z2")).collect())
    assert back == sorted(tuple(r) for r in z.collect())


def test_bronze_copy_keeps_every_column(spark, landing, root, zones_csv):
    kinds = {"LongType()": ("BIGINT", 3), "TimestampNTZType()": ("TIMESTAMP", dt.datetime(2019, 1, 1, 5, 10)), "DoubleType()": ("DOUBLE", 10.0), "StringType()": ("VARCHAR", "Y")}
    columns = [(f.name, *kinds[str(f.dataType)]) for f in RAW_TRIPS]
    write_typed(landing, "2019-01-01", ", ".join(f"{n} {t}" for n, t, _ in columns), [tuple(v for _, _, v in columns)])
    api.run_etl(spark, str(landing), root, zones_csv, bronze=True)
    b = read_table(spark, Lake(root), "bronze").collect()
    assert [r.asDict() for r in b] == [{n: v for n, _, v in columns} | {"source_file": "2019-01-01.parquet"}]
    assert api.total_revenue(spark, root, "2019-01-01", 5) == pytest.approx(10.0)


def test_continuous_trigger_picks_up_new_files(spark, landing, root, zones_csv):
    write_day(landing, "2019-01-01", [trip("2019-01-01 05:10:00", 10.0)])
    q = api.start_etl(spark, str(landing), root, zones_csv, interval="1 second")
    try:
        q.processAllAvailable()
        write_day(landing, "2019-01-02", [trip("2019-01-02 05:10:00", 5.0)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert api.cumulative_revenue(spark, root, 5) == pytest.approx(15.0)


def test_file_name_parse(spark):
    names = spark.createDataFrame([("2019-03-10.parquet",), ("2019-03-10.late.parquet",), ("junk",)], "file_path string")
    got = {r["file_path"]: (r["date"], r["month"]) for r in explore.parse_file_names(names).collect()}
    assert got["2019-03-10.parquet"] == (dt.date(2019, 3, 10), "2019-03")
    assert got["2019-03-10.late.parquet"] == (dt.date(2019, 3, 10), "2019-03")
    assert got["junk"] == (None, "")


def test_serving_lookup_and_dense_hours(spark):
    from tidemark.operators import serving

    hourly = spark.createDataFrame([(1, 2.5), (23, 1.0)], "hour int, revenue double")
    dense = {r["hour"]: r["revenue"] for r in serving.dense_hours(spark, hourly).collect()}
    assert len(dense) == 24 and dense[1] == 2.5 and dense[0] == 0.0
    with pytest.raises(ValueError):
        serving.lookup_hour(hourly, 24)
    assert serving.lookup_hour(hourly, 23).collect()[0]["revenue"] == 1.0
    assert explore.first_n(hourly, 1, "hour").collect()[0]["hour"] == 1
    assert hourly.where(F.col("hour").between(0, 23)).count() == 2


def test_read_dates_opens_only_existing_folders(spark, tmp_path):
    from tidemark.sinks.lake import migrate, overwrite_partitions, read_dates

    lake = Lake(str(tmp_path / "lake"))
    migrate(spark, lake)
    day0 = dt.date(2024, 1, 1)
    rows = spark.range(40).select(
        F.date_add(F.lit(day0), F.col("id").cast("int")).alias("date"),
        F.lit(1).alias("hour"),
        F.lit(2).cast("decimal(18,2)").alias("revenue"),
    )
    overwrite_partitions(rows.withColumn("p_date", F.col("date")), lake, "day_hours")
    few = [day0 + dt.timedelta(days=2), dt.date(2030, 1, 1)]  # checked one by one
    many = [day0 + dt.timedelta(days=k) for k in range(0, 60, 3)]  # one listing
    assert read_dates(spark, lake, "day_hours", few).count() == 1
    got = read_dates(spark, lake, "day_hours", many).select("p_date").collect()
    assert sorted(r["p_date"] for r in got) == [d for d in many if d < day0 + dt.timedelta(days=40)]
    assert read_dates(spark, lake, "day_hours", [dt.date(2031, 1, 1)]).count() == 0
