"""Gold dates are published, not replaced (K3, A5).

A rebuild writes its dates of all gold tables beside the old ones, as ``<table>/v=<version>/p_date=<date>``. One small
pointer file then says, for each table, which version of each date is current, and readers go by the newest pointer: they
see all tables of all dates as they were before the rebuild or as they are after it. The pointer is written aside and
published by a rename. What a publication replaced stays until the next one, for readers that hold it; versions that no
pointer names (a rebuild that stopped) go then too.

The pointer has an entry for each date and table. A version whose dates are all current is read as one folder, so a bulk
load costs one path, however many dates it has.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
import uuid

from pyspark.sql import SparkSession

from tidemark.sinks import fs

#: The tables published together.
GOLD = ("cells", "day_hours", "hour_denorm", "overflow")


def _pointers(spark: SparkSession, folder: str) -> list[str]:
    return fs.glob(spark, f"{folder}/[0-9]*.json")


def current(spark: SparkSession, folder: str) -> dict | None:
    """The newest pointer: dates {table: {date: version}}, sizes {table: {version: dates written}}; None before the first."""
    while found := _pointers(spark, folder):
        text = fs.read_text(spark, found[-1])
        if text is not None:  # else it was replaced meanwhile
            return json.loads(text)
    return None


def new_version() -> str:
    return f"{time.time_ns():020d}"


def paths(pointer: dict, base: str, table: str, dates=None) -> list[str]:
    """Folders of a table's current dates (or of those of them that are asked for)."""
    held = pointer["dates"].get(table, {})
    if dates is not None:
        asked = sorted({d.isoformat() for d in dates})
        return [f"{base}/v={held[d]}/p_date={d}" for d in asked if d in held]
    by: dict[str, list[str]] = {}
    for d, v in held.items():
        by.setdefault(v, []).append(d)
    whole = {v for v, own in by.items() if pointer["sizes"][table].get(v) == len(own)}
    return sorted([f"{base}/v={v}" for v in whole] + [f"{base}/v={v}/p_date={d}" for v, own in by.items() if v not in whole for d in own])


def adopt(spark: SparkSession, bases: dict[str, str]) -> dict:
    """The first pointer's state: dates of a lake from before there were pointers become its version 0."""
    dates: dict[str, dict[str, str]] = {t: {} for t in GOLD}
    sizes: dict[str, dict[str, int]] = {t: {} for t in GOLD}
    for table, base in bases.items():
        for leaf in fs.glob(spark, f"{base}/p_date=*"):
            fs.mkdirs(spark, f"{base}/v=0")
            name = leaf.rstrip("/").rsplit("/", 1)[-1]
            if not fs.rename(spark, leaf, f"{base}/v=0/{name}"):
                raise OSError(f"{leaf} could not be moved")
        for leaf in fs.glob(spark, f"{base}/v=0/p_date=*"):
            dates[table][leaf.rsplit("=", 1)[1]] = "0"
        sizes[table] = {"0": len(dates[table])}
    return {"dates": dates, "sizes": sizes, "replaced": []}


def publish(spark: SparkSession, folder: str, bases: dict[str, str], version: str, dates, present: dict[str, set[_dt.date]]) -> None:
    """Make ``version`` current for ``dates`` in the tables of ``present``, which says what dates it has of each."""
    old = current(spark, folder) or adopt(spark, bases)
    held = {t: dict(old["dates"].get(t, {})) for t in GOLD}
    sizes = {t: dict(old["sizes"].get(t, {})) for t in GOLD}
    replaced = []
    for table, has in present.items():
        for d in {x.isoformat() for x in dates}:
            if (before := held[table].pop(d, None)) is not None:
                replaced.append(f"{bases[table]}/v={before}/p_date={d}")
        held[table].update({d.isoformat(): version for d in has})
        sizes[table][version] = len(has)
    for table in GOLD:
        used = set(held[table].values())
        sizes[table] = {v: n for v, n in sizes[table].items() if v in used}
    found = _pointers(spark, folder)
    last = int(found[-1].rsplit("/", 1)[1].removesuffix(".json")) if found else 0
    aside = f"{folder}/aside-{uuid.uuid4().hex}"
    fs.write_text(spark, aside, json.dumps({"dates": held, "sizes": sizes, "replaced": replaced}))
    if not fs.rename(spark, aside, f"{folder}/{max(time.time_ns(), last + 1):020d}.json"):
        raise OSError("the pointer of the gold tables could not be published")
    _clean(spark, folder, bases, [{"dates": held}, old], old["replaced"], found[:-1])


def _clean(spark: SparkSession, folder: str, bases: dict[str, str], kept: list[dict], replaced: list[str], pointers: list[str]) -> None:
    """Remove what the publication before replaced, versions that neither pointer names, and older pointers."""
    for path in [*replaced, *pointers, *fs.glob(spark, f"{folder}/aside-*")]:
        fs.delete(spark, path)
    for table, base in bases.items():
        used = {v for p in kept for v in p["dates"].get(table, {}).values()}
        for path in fs.glob(spark, f"{base}/v=*"):
            if path.rsplit("=", 1)[1] not in used:
                fs.delete(spark, path)
