"""What a consumer may rely on: totals by cell, averages by hour, arguments, repeated ticks, answer times."""

from __future__ import annotations

from collections import defaultdict

import pytest

from tests.fixtures import trip, typical_seconds, write_day
from tidemark import api

# amounts in quarters, so that sums are exact; zone 9 is in no zone file
TRIPS = {
    "2021-11-05": [("2021-11-05 00:00:00", 4.25, 1), ("2021-11-05 23:59:59", 7.5, 2), ("2021-11-05 23:00:00", 0.25, 3)],
    "2021-11-06": [("2021-11-06 23:10:00", 6.0, 1), ("2021-11-06 11:45:00", 2.75, 9), ("2021-11-06 11:46:00", 3.5, 2)],
    "2021-11-07": [("2021-11-07 01:30:00", 12.0, 2), ("2021-11-07 01:30:00", 12.0, 2)],
}


@pytest.fixture()
def lake(spark, landing, root, zones_csv):
    for day, rows in TRIPS.items():
        write_day(landing, day, [trip(*r) for r in rows])
    api.run_etl(spark, str(landing), root, zones_csv)
    return root


def expected():
    cell, hour = defaultdict(float), defaultdict(float)
    for rows in TRIPS.values():
        for at, amount, zone in rows:
            cell[at[:10], int(at[11:13])] += amount * (zone != 9)
            hour[int(at[11:13])] += amount
    return cell, hour


def test_totals_and_averages_follow_the_rows(spark, lake):
    cell, hour = expected()
    for day in TRIPS:
        for h in range(24):
            assert api.total_revenue(spark, lake, day, h) == cell[day, h], (day, h)
    for h in range(24):
        assert api.cumulative_revenue(spark, lake, h) == hour[h]


def test_a_tick_without_new_files_changes_nothing(spark, landing, lake, zones_csv):
    cell, _ = expected()
    for _ in range(2):
        assert api.run_etl(spark, str(landing), lake, zones_csv).n_batches == 0
    assert api.total_revenue(spark, lake, "2021-11-07", 1) == cell["2021-11-07", 1]


@pytest.mark.parametrize("hour", [-5, 24, 99, True, 3.0, "7"])
def test_what_is_no_hour_is_refused(spark, lake, hour):
    with pytest.raises(ValueError):
        api.avg_revenue(spark, lake, hour)
    with pytest.raises(ValueError):
        api.total_revenue(spark, lake, "2021-11-05", hour)


def test_answers_come_in_time(spark, lake):
    assert typical_seconds(lambda: api.total_revenue(spark, lake, "2021-11-06", 23), 20) <= 1.0
    assert typical_seconds(lambda: api.avg_revenue(spark, lake, 23), 50) <= 0.050
