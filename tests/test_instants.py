from datetime import datetime as t
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
import pytest

from strataloom.operators.instants import blame_instants, commit_instants, instants, local_to_utc, log_instants, offset_minutes, parse_dates, zone_table, zone_version


@pytest.mark.parametrize(
    "text,minutes",
    [("+0530", 330), ("-0330", -210), (" -0700 ", -420), ("−0500", -300), ("GMT+1", 60), ("UTC-03:30", -210), ("GMT+0545", 345), ("Z", 0), ("GMT", 0), ("2", 120), ("10", 600), ("+14", 840)]
    + [(x, None) for x in ("+9900", "+1401", "+0075", "unknown", "", "??", None, "+12345", "local")],
)
def test_offsets(text, minutes):
    assert offset_minutes(text) == minutes


CASES = [
    ("2023-01-02T21:29:45.812142Z", "Europe/Berlin", 1672694985, 0),
    ("Date:   Thu Oct 12 06:44:45 2017 -0330", None, 1507803285, -210),
    ("Tue Aug 17 22:06:22 2021", "Asia/Kolkata", 1629218182, 330),
    ("1722914271 +0900", "+0100", 1722914271, 540),
    ("1441963938373", "+0100", 1441963938, 0),
    ("1673424578000000", None, 1673424578, 0),
    ("Mar 15, 2024 7:36:48 AM GMT+01:00", None, 1710484608, 60),
    ("Oct 8, 2020 12:06:12 PM GMT+08:00", None, 1602129972, 480),
    ("20.01.2023 20:47:44 +00:00", None, 1674247664, 0),
    ("2023-02-08 02:52:55 UTC", "-0700", 1675824775, 0),
    ("Mon, 16 Jan 2023 00:08:18 +0900", None, 1673795298, 540),
    ("2023-04-19T14:42:11", "-08:00", 1681944131, -480),
] + [(x, z, None, None) for x, z in (("0000-00-00 00:00:00", "-0500"), ("2018-22-22 19:05:34 +0000", None), ("2023-02-29T01:00:00Z", None), ("2024-01-04T33:34:36Z", None), ("2022-03-27 02:30:00", "Europe/Berlin"), ("2022-10-30 02:30:00", "Europe/Berlin"), ("2023-09-08 08:37:06", None), ("2023-09-08 08:37:06", "local"), ("Date:", "+0100"), ("unknown", "+0100"), ("", "Z"), (None, "Z"), ("x" * 100_000, "Z"), ("修复", "Z"))]


def test_dates():
    out = parse_dates(pd.Series([c[0] for c in CASES], dtype=object), pd.Series([c[1] for c in CASES], dtype=object), zone_version())
    for (text, zone, epoch, offset), e, o in zip(CASES, out["utc_epoch"], out["offset_min"]):
        assert (None if e is pd.NA else e, None if o is pd.NA else o) == (epoch, offset), (text, zone)


@pytest.mark.parametrize("name", ["Europe/Berlin", "America/New_York", "Australia/Sydney", "Asia/Kathmandu"])
def test_zone_tables_agree_with_the_library(name):
    wall = np.arange(1_500_000_000, 1_600_000_000, 1_234_567)
    seconds, sure = local_to_utc(wall, zone_table(name, zone_version()))
    for w, s, ok in zip(wall, seconds, sure):
        local = t.fromtimestamp(int(w), ZoneInfo("UTC")).replace(tzinfo=ZoneInfo(name))
        if ok:
            assert local.utcoffset().total_seconds() == s
    with pytest.raises(RuntimeError):
        zone_table(name, "another version")


def test_tables(spark):
    commits = spark.createDataFrame([(1, t(2020, 1, 1, 12), "+0100", "x"), (1, t(2020, 1, 1, 12), "+0100", "x"), (2, None, "Z", "x"), (3, t(2020, 1, 1), "??", "x")], "id long, date timestamp_ntz, gmt_offset string, rec_key string")
    assert [tuple(r) for r in commit_instants(commits).distinct().collect()] == [("git_commit", "1", 1577876400, 60)]
    log = spark.createDataFrame([(5, "2020-01-01 00:00:00", "+0100"), (6, None, None)], "log_id long, date string, orig_timezone string")
    assert [tuple(r) for r in log_instants(log).collect()] == [("commit_stat_log", "5", 1577833200, 60)]
    schema = "blame_id long, authors array<struct<author string, author_hash_map map<string,struct<epoch bigint, lines int, time_zone string>>, commit_hash_map map<string,struct<epoch bigint, lines int, time_zone string>>>>"
    blame = spark.createDataFrame([(9, [("a", {"h": (1577833200123, 1, "??"), "g": (-1, 1, "Z"), "i": None}, {"h": (1577833200123, 2, "??")})]), (8, None)], schema)
    assert [tuple(r) for r in blame_instants(blame).distinct().collect()] == [("blame", "9:h", 1577833200, 0)]
    assert instants(commits.limit(0), log.limit(0), blame.limit(0)).isEmpty()


def test_blanks_and_long_texts(spark):
    log = spark.createDataFrame([(1, " " * 500 + "2020-01-01 00:00:00" + "\n" * 300, "+0100"), (2, "2020-01-01" + " " * 400 + "00:00:00", "+0100"), (3, "2" * 100_000, "+0100")], "log_id long, date string, orig_timezone string")
    assert sorted(tuple(r)[1:] for r in log_instants(log).collect()) == [("1", 1577833200, 60), ("2", 1577833200, 60)]
