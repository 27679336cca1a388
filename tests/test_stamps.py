import datetime as dt
import zoneinfo

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np
import pyarrow as pa

from marketloom.operators import stamps

CASES = [  # text, zone, norm
    ("2023-10-05 11:15:00", "Asia/Kolkata", "2023-10-05T05:45:00.000000Z"),
    ("30-Oct-2025 09:15 AM IST", "America/New_York", "2025-10-30T03:45:00.000000Z"),
    ("17/10/2024 14:15", "Asia/Kolkata", "2024-10-17T08:45:00.000000Z"),
    ("2025-12-11T02:24:54.000000650Z", None, "2025-12-11T02:24:54.000000Z"),
    ("\t1715283257000 ", "Asia/Kolkata", "2024-05-09T19:34:17.000000Z"),
    ("1762929900230000", None, "2025-11-12T06:45:00.230000Z"),
    ("Mon, 20 Jan 2025 08:04:27 +0000", "Asia/Kolkata", "2025-01-20T08:04:27.000000Z"),
    ("2024-07-18T13:15:00.034+0530", None, "2024-07-18T07:45:00.034000Z"),
    ("20240430T063008", None, "2024-04-30T06:30:08.000000Z"),
    ("2024-05-09 14:15:00 Asia/Kolkata", "Europe/London", "2024-05-09T08:45:00.000000Z"),
    ("2024-11-03 01:30:00", "America/New_York", "2024-11-03T05:30:00.000000Z"),  # occurs twice
    ("2024-03-10 02:30:00", "America/New_York", "2024-03-10T07:30:00.000000Z"),  # skipped
    ("12-Jan-2024 12:05 AM IST", None, "2024-01-11T18:35:00.000000Z"),
    ("2024-13-01T09:15:00Z", None, None),
    ("2023-02-29 10:00:00", None, None),
    ("2024-01-01 10:00:00", "Mars/Olympus", None),
    ("25:61", None, None),
    ("pending", None, None),
    ("", None, None),
    ("   ", None, None),
    (None, "Asia/Kolkata", None),
    ("x" * 100_000, None, None),
]


def test_cases_and_extra_columns(spark):
    rows = [(i, t, z, "own") for i, (t, z, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows * 2, "id int, stamp string, zone string, norm string")
    got = stamps.normalise(df, "stamp", "norm", zone_col="zone").collect()
    assert len(got) == 2 * len(CASES)
    for r in got:
        assert r["norm"] == CASES[r["id"]][2], r
    assert stamps.normalise(df.limit(0), "stamp", "norm").collect() == []


def test_dates_are_indian(spark):
    cases = [("13-07-2023", "2023-07-13"), ("31-JUL-2023 ", "2023-07-31"), ("20230726", "2023-07-26"), ("1 November 2023", "2023-11-01"), ("2023-07-04T22:36:00Z", "2023-07-05"), ("1689853342000", "2023-07-20"), ("2023-07-21 00:00:00", "2023-07-21"), ("31/02/2024", None), ("N.A.", None), (None, None)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "d string")
    assert [r[1] for r in stamps.normalise(df, "d", "n", dates=True).collect()] == [n for _, n in cases]


@settings(max_examples=150, deadline=None)
@given(st.datetimes(dt.datetime(1990, 1, 1), dt.datetime(2037, 12, 31)), st.sampled_from(["America/New_York", "Europe/London", "Asia/Kolkata", "Australia/Lord_Howe", "Africa/Casablanca"]))
def test_zone_tables_agree_with_the_zone_data(wall, name):
    wall = wall.replace(microsecond=0)
    zone = zoneinfo.ZoneInfo(name)
    # fold 0 is the earlier instant, and for skipped readings the offset before the change
    want = wall.replace(tzinfo=zone, fold=0).astimezone(dt.timezone.utc)
    values, ok = stamps.parse_batch(pa.array([wall.strftime("%Y-%m-%d %H:%M:%S")]), pa.array([name]), False)
    assert ok[0] and values[0] == int(want.timestamp()) * 1_000_000


def test_zones_beyond_the_tables():
    for year in (2099, 2101, 2450, 2499, 2500, 2504, 2900, 2999, 9000):
        for month in (1, 7):
            for name in ("America/New_York", "Europe/Berlin", "Asia/Kolkata"):
                wall = dt.datetime(year, month, 1, 12)
                us = (wall - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
                want = us - int(wall.replace(tzinfo=zoneinfo.ZoneInfo(name)).utcoffset().total_seconds()) * 1_000_000
                got, _ = stamps.wall_to_utc(np.array([us]), name)
                assert got[0] == want and stamps.utc_to_wall(got, name)[0] == us, (year, month, name)
