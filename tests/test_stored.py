"""Stored tables: the chain of checks notices any altered table; additive tables count a batch once; the catalog's table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.fixtures import trip, write_day
from tidemark import api
from tidemark.operators import audit
from tidemark.sinks import additive, fs
from tidemark.sinks.lake import Lake, read_table
from tidemark.streaming.batch import note_pending


def _bad(spark, root, zones_csv, **kw):
    return sorted((r.step, str(r.date)) for r in api.audit_df(spark, root, zones_csv, **kw).where("not ok").collect())


def test_the_chain_holds_with_awkward_rows_and_without_any(spark, landing, root, zones_csv):
    api.migrate(spark, root)
    assert _bad(spark, root, zones_csv) == []
    write_day(landing, "a", [trip("2022-02-01 06:00:00", 9e15), trip("2022-02-01 06:10:00", 9e15), trip("2022-02-01 06:20:00", None, 99), trip("2022-02-01 06:20:00", -1.0, None), trip(None)])
    write_day(landing, "b", [])
    write_day(landing, "c", [trip("2022-02-01 06:00:00", 2.0, 2), trip("2022-02-02 06:00:00", 2.0, 3), trip("2022-02-02 06:00:00", 2.0, 3)])
    api.run_etl(spark, str(landing), root, zones_csv)
    rows = api.audit_df(spark, root, zones_csv).collect()
    assert {r.step for r in rows} == set(audit.STEPS) and all(r.ok and not r.pending for r in rows)


def test_a_lost_leaf_and_a_lost_table_are_noticed(spark, landing, root, zones_csv):
    for i in (1, 2, 3):
        write_day(landing, f"f{i}", [trip(f"2022-02-0{i} 06:00:00", 10.0 * i)])
    api.run_etl(spark, str(landing), root, zones_csv)
    lake = Lake(root)
    fs.delete(spark, f"{lake.silver}/p_date=2022-02-01")
    fs.delete(spark, f"{lake.file_cells}/p_date=2022-02-02")
    want = [("file_cells_to_cells", "2022-02-02"), ("silver_to_file_cells", "2022-02-01"), ("silver_to_file_cells", "2022-02-02")]
    assert _bad(spark, root, zones_csv) == want
    import datetime as dt

    assert _bad(spark, root, zones_csv, dates=[dt.date(2022, 2, 1), dt.date(2022, 2, 3)]) == [want[1]]
    note_pending(spark, lake, [dt.date(2022, 2, 2)])
    assert {(str(r.date), r.pending) for r in api.audit_df(spark, root, zones_csv).collect()} == {("2022-02-01", False), ("2022-02-02", True), ("2022-02-03", False), ("None", True)}


def _table(tmp_path) -> additive.AdditiveTable:
    return additive.AdditiveTable(str(tmp_path / "table"), (T.StructField("k", T.StringType()),), "v")


def _held(spark, table):
    return {r.k: str(r.v) for r in additive.read(spark, table).collect()}


def test_a_batch_counts_once(spark, tmp_path):
    table = _table(tmp_path)
    frame = lambda *rows: spark.createDataFrame(list(rows), "k string, v double")
    assert _held(spark, table) == {} and additive.compact(spark, table) == 0
    assert additive.add(table, frame(("a", 1.0), ("a", 2.0), (None, 5.0)), 0)
    assert additive.add(table, frame(("a", 1.0), ("b", None)), 2)
    assert additive.add(table, frame(("a", 1.0), ("b", None)), 2)
    want = {"a": "4.00", None: "5.00", "b": "0.00"}
    assert _held(spark, table) == want
    assert additive.compact(spark, table) == 2 and _held(spark, table) == want
    assert not additive.add(table, frame(("a", 100.0)), 2)
    assert additive.add(table, frame(("a", 10.0)), 1)  # a gap between folded ids is still open
    assert additive.add(table, frame(), 3)
    want["a"] = "14.00"
    assert _held(spark, table) == want
    assert additive.compact(spark, table) == 2 and _held(spark, table) == want
    assert additive._state(spark, table)["folded"] == [[0, 3]]
    with pytest.raises(ValueError):
        additive.add(table, frame(), -1)


def test_stops_leave_the_totals_as_they_were(spark, tmp_path, monkeypatch):
    table = _table(tmp_path)
    frame = spark.createDataFrame([("a", 1.0)], "k string, v double")
    additive.add(table, frame, 0)

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(additive.fs, "rename", stop)
        for run in (lambda: additive.add(table, frame, 1), lambda: additive.compact(spark, table)):
            with pytest.raises(OSError):
                run()
            assert _held(spark, table) == {"a": "1.00"}
    assert additive.add(table, frame, 1) and additive.compact(spark, table) == 2 and _held(spark, table) == {"a": "2.00"}
    assert len(fs.glob(spark, f"{table.root}/bases/base=*")) == 1


def test_a_reader_from_before_a_compaction_finds_its_files(spark, tmp_path):
    table = _table(tmp_path)
    frame = spark.createDataFrame([("a", 1.0)], "k string, v double")
    additive.add(table, frame, 0)
    before = additive.read(spark, table)
    additive.compact(spark, table)
    assert [str(r.v) for r in before.collect()] == ["1.00"]


def test_as_the_sink_of_a_stream(spark, tmp_path):
    table, source = _table(tmp_path), str(tmp_path / "in")
    for i in range(3):
        spark.createDataFrame([("a", float(i))], "k string, v double").coalesce(1).write.mode("append").parquet(source)
    for run in range(2):  # the second time from a lost checkpoint: the same batch again
        stream = spark.readStream.schema("k string, v double").parquet(source).writeStream
        query = stream.foreachBatch(additive.sink(table)).option("checkpointLocation", str(tmp_path / f"c{run}")).trigger(availableNow=True).start()
        query.awaitTermination()
        assert _held(spark, table) == {"a": "3.00"}


def test_the_catalogs_table_follows_the_folder(spark, landing, root, zones_csv):
    path = write_day(landing, "a b=c", [trip("2022-02-01 06:00:00", 10.0)])
    api.run_etl(spark, str(landing), root, zones_csv)
    api.external_table(spark, root, "silver_followed")
    assert spark.table("silver_followed").count() == 1
    write_day(landing, "a b=c", [trip("2022-02-02 06:00:00", 1.0), trip("2022-02-03 06:00:00", 1.0)])
    api.replay(spark, root, [str(path)], zones_csv)
    api.external_table(spark, root, "silver_followed")
    assert {str(r.date) for r in spark.table("silver_followed").collect()} == {"2022-02-02", "2022-02-03"}
    plan = spark.table("silver_followed").where(F.col("p_date") == "2022-02-03")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(p_date" in plan
    spark.sql("DROP TABLE silver_followed")
    assert read_table(spark, Lake(root), "silver").count() == 2
