"""Daily trip files for the tests, written by DuckDB from rows of (pickup, amount, zone id)."""

from __future__ import annotations

import timeit
from pathlib import Path

import duckdb


def trip(pickup: str | None, amount: float | None = 10.0, location: int = 1) -> tuple:
    return pickup, amount, location


def write_day(folder: Path, name: str, rows: list[tuple]) -> Path:
    """``<folder>/<name>.parquet`` with the three columns that the pipeline reads; an empty list gives an empty file."""
    out = Path(folder, f"{name}.parquet")
    out.parent.mkdir(parents=True, exist_ok=True)
    with duckdb.connect() as db:
        db.execute("CREATE TABLE t (tpep_pickup_datetime TIMESTAMP, total_amount DOUBLE, PULocationID BIGINT)")
        if rows:
            db.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
        db.execute(f"COPY t TO '{out}' (FORMAT parquet)")
    return out


def write_typed(folder: Path, name: str, columns: str, rows: list[tuple]) -> Path:
    """``<folder>/<name>.parquet`` with columns of these types."""
    out = Path(folder, f"{name}.parquet")
    out.parent.mkdir(parents=True, exist_ok=True)
    with duckdb.connect() as db:
        db.execute("SET TimeZone='UTC'")
        db.execute(f"CREATE TABLE t ({columns})")
        db.executemany(f"INSERT INTO t VALUES ({', '.join('?' * len(rows[0]))})", rows)
        db.execute(f"COPY t TO '{out}' (FORMAT parquet)")
    return out


def typical_seconds(call, calls: int) -> float:
    """The middle one of so many timed calls, after an untimed one."""
    call()
    return sorted(timeit.repeat(call, number=1, repeat=calls))[calls // 2]
