"""Timestamps of mixed formats and zones as one UTC instant with the offset recorded (problem 6).

A text is reduced to its shape mask: every digit becomes 9, every letter a, all else stays. A mask fixes the place of
every field, so it is given to a parser once, and all rows of that shape are converted together by slicing columns of a
byte matrix. Named zones go through transition tables made from one stated version of the public zone database.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

MAX_OFFSET_MIN = 14 * 60
#: The English names in dates and the words that mean UTC.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
WEEKDAYS = "mon tue wed thu fri sat sun".split()
UTC_WORDS = {"z", "utc", "gmt", "ut"}

_LETTERS = {c: "a" for c in range(0x41, 0x7B) if chr(c).isalpha()}
_MASK = str.maketrans(_LETTERS | {c: "9" for c in range(0x30, 0x3A)})
_MINUS = str.maketrans({"\u2212": "-", "\u2013": "-", "\u00a0": " "})
_CLOCK = r"(?P<H>99?):(?P<M>99)(?::(?P<S>99)(?:[.,](?P<f>9+))?)?"
_ZONE = r"(?: *(?P<zw>a{1,3}))?(?: *(?P<zo>[+-]9{1,2}(?::?99)?))?$"
#: The shapes that dates are written in, over masks.
_SHAPES = [
    re.compile(rf"(?:(?P<tag>aaaa): *)?{body}{_ZONE}")
    for body in (
        rf"(?P<Y>9999)-(?P<m>99?)-(?P<d>99?)(?:(?P<T>a)| +){_CLOCK}",
        rf"(?P<Y>9999)/(?P<m>99?)/(?P<d>99?) +{_CLOCK}",
        rf"(?P<d>99?)\.(?P<m>99?)\.(?P<Y>9999) +{_CLOCK}",
        rf"(?P<wd>a{{3,9}}),? +(?P<mon>a{{3,9}}) +(?P<d>99?) +{_CLOCK} +(?P<Y>9999)",
        rf"(?:(?P<wd>a{{3,9}}), +)?(?P<d>99?) +(?P<mon>a{{3,9}}) +(?P<Y>9999) +{_CLOCK}",
        rf"(?P<mon>a{{3,9}}) +(?P<d>99?), +(?P<Y>9999) +{_CLOCK} +(?P<ap>aa)",
        r"(?P<e>9{1,18})",
    )
]


def zone_version() -> str:
    """Version of the zone database that this Python has, or ``system`` where it comes without one."""
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "system"


@lru_cache(maxsize=4096)
def _plan(mask: str) -> dict[str, tuple[int, int]] | None:
    """Places of the fields in texts of this shape; None if the shape is no date."""
    for shape in _SHAPES:
        if found := shape.match(mask):
            return {k: found.span(k) for k, v in found.groupdict().items() if v is not None}
    return None


@lru_cache(maxsize=65536)
def offset_minutes(text: str | None) -> int | None:
    """Minutes east of UTC of an offset in any spelling: hours or hours and minutes, plus if unsigned, up to 14 hours.

    ``Z``, ``UTC`` and ``GMT`` alone are 0 and may precede the offset. Anything else, null and blanks give None.
    """
    if text is None:
        return None
    found = re.fullmatch(r"(?i)(z|utc|gmt|ut)?\s*(?:([+-])?\s*(\d{1,2})(?::?(\d{2}))?)?", text.translate(_MINUS).strip())
    if not found or not found.group(0):
        return None
    _, sign, hours, minutes = found.groups()
    if hours is None:
        return 0
    total = int(hours) * 60 + int(minutes or 0)
    if int(minutes or 0) > 59 or total > MAX_OFFSET_MIN:
        return None
    return -total if sign == "-" else total


@lru_cache(maxsize=1024)
def zone_table(name: str, version: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Transitions of a named zone from 1900 to 2100: UTC seconds at which an offset begins, and the offsets in seconds.

    The first entry is the beginning of time. None if there is no zone of that name. The version is part of the key, and
    a worker whose zone database differs from the driver's refuses to answer.
    """
    if version != zone_version():
        raise RuntimeError(f"zone database {zone_version()} here, {version} on the driver")
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_+-]*(/[A-Za-z0-9_+-]+){0,2}", name):
        return None
    try:
        from importlib.resources import files

        *folders, leaf = name.split("/")
        with files(".".join(["tzdata.zoneinfo", *folders])).joinpath(leaf).open("rb") as source:
            zone = ZoneInfo.from_file(source, key=name)
    except (ImportError, OSError, ValueError, KeyError):
        try:
            zone = ZoneInfo(name)
        except (OSError, ValueError, KeyError):
            return None
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def at(second: int) -> int:
        return int((epoch + timedelta(seconds=second)).astimezone(zone).utcoffset().total_seconds())

    first, last, step = -2208988800, 4102444800, 7 * 86400
    begins, offsets = [-(1 << 62)], [at(first)]
    for t in range(first + step, last, step):
        if at(t) != offsets[-1]:
            low, high = t - step, t
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if at(middle) == offsets[-1] else (low, middle)
            begins.append(high)
            offsets.append(at(high))
    return np.array(begins, dtype=np.int64), np.array(offsets, dtype=np.int64)


def local_to_utc(wall: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets in seconds of wall-clock seconds, and where they are certain: neither skipped nor repeated."""
    begins, offsets = table

    def of(utc: np.ndarray) -> np.ndarray:
        return offsets[np.searchsorted(begins, utc, side="right") - 1]

    before, after = of(wall - 86400), of(wall + 86400)
    fits_before, fits_after = of(wall - before) == before, of(wall - after) == after
    sure = np.where(before == after, fits_before, fits_before ^ fits_after)
    return np.where(fits_before, before, after), sure


def _days(year: np.ndarray, month: np.ndarray, day: np.ndarray) -> np.ndarray:
    """Days since 1970 of proleptic Gregorian dates."""
    y = year - (month <= 2)
    era = y // 400
    yoe = y - era * 400
    doy = (153 * (month + np.where(month > 2, -3, 9)) + 2) // 5 + day - 1
    return era * 146097 + yoe * 365 + yoe // 4 - yoe // 100 + doy - 719468


def _number(chars: np.ndarray, span: tuple[int, int]) -> np.ndarray:
    out = np.zeros(len(chars), dtype=np.int64)
    for i in range(*span):
        out = out * 10 + (chars[:, i].astype(np.int64) - 48)
    return out


def _words(chars: np.ndarray, span: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    block = np.ascontiguousarray(chars[:, span[0] : span[1]])
    values, which = np.unique(block.view(f"S{span[1] - span[0]}").ravel(), return_inverse=True)
    return np.array([v.decode().lower() for v in values], dtype=object), which


def seconds_of(number: np.ndarray) -> np.ndarray:
    """Whole seconds of epoch numbers in seconds, milliseconds or microseconds, told apart by size."""
    return np.where(number >= 10**14, number // 10**6, np.where(number >= 10**11, number // 1000, number))


def parse_dates(texts: pd.Series, zones: pd.Series, version: str) -> pd.DataFrame:
    """utc_epoch and offset_min of each text, both null where there is no certain instant.

    An offset in the text goes before the zone beside it; a bare epoch number has offset 0. Weekday names aren't held
    against the date. Blanks around a date don't matter, however many. Null, empty and unknown texts, however long, and dates
    that don't exist give nulls.
    """
    n = len(texts)
    epoch, offset, good = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
    clean = [t.strip().translate(_MINUS).strip() if isinstance(t, str) else "" for t in texts]
    beside_all = np.array([z if isinstance(z, str) else "" for z in zones], dtype=object)
    masks = pd.Series([t.translate(_MASK) if t.isascii() else "" for t in clean])
    for mask, rows in masks.groupby(masks).indices.items():
        plan = _plan(mask)
        if plan is None:
            continue
        chars = np.frombuffer("".join(clean[i] for i in rows).encode(), dtype=np.uint8).reshape(len(rows), len(mask))
        ok = np.ones(len(rows), bool)
        if "tag" in plan:
            values, which = _words(chars, plan["tag"])
            ok &= (values == "date")[which]
        east, zoned = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        if "zw" in plan:
            values, which = _words(chars, plan["zw"])
            ok &= np.isin(values, list(UTC_WORDS))[which]
            zoned[:] = True
        if "zo" in plan:
            values, which = _words(chars, plan["zo"])
            parsed = [offset_minutes(v) for v in values]
            ok &= np.array([p is not None for p in parsed])[which]
            east = np.array([p or 0 for p in parsed], dtype=np.int64)[which]
            zoned[:] = True
        if "e" in plan:
            epoch[rows], offset[rows], good[rows] = seconds_of(_number(chars, plan["e"])), east, ok
            continue
        if "T" in plan:
            values, which = _words(chars, plan["T"])
            ok &= (values == "t")[which]
        year, day, hour, minute = (_number(chars, plan[k]) for k in ("Y", "d", "H", "M"))
        second = _number(chars, plan["S"]) if "S" in plan else np.zeros(len(rows), np.int64)
        if "mon" in plan:
            values, which = _words(chars, plan["mon"])
            month = np.array([MONTHS.index(v[:3]) + 1 if v[:3] in MONTHS else 0 for v in values], dtype=np.int64)[which]
        else:
            month = _number(chars, plan["m"])
        if "wd" in plan:
            values, which = _words(chars, plan["wd"])
            ok &= np.array([v[:3] in WEEKDAYS for v in values])[which]
        if "ap" in plan:
            values, which = _words(chars, plan["ap"])
            ok &= np.isin(values, ["am", "pm"])[which] & (hour >= 1) & (hour <= 12)
            hour = hour % 12 + 12 * (values == "pm")[which]
        leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
        ok &= (year >= 1) & (month >= 1) & (month <= 12) & (hour < 24) & (minute < 60) & (second < 60)
        month = np.where(ok, month, 1)
        length = np.array([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31])[month - 1] + (leap & (month == 2))
        ok &= (day >= 1) & (day <= length)
        wall = _days(year, month, day) * 86400 + hour * 3600 + minute * 60 + second
        if not zoned.all():
            beside = pd.Series(beside_all[rows])
            for zone, at in beside.groupby(beside).indices.items():
                if (fixed := offset_minutes(zone)) is not None:
                    east[at] = fixed
                elif (table := zone_table(zone.strip(), version)) is not None:
                    seconds, sure = local_to_utc(wall[at], table)
                    east[at], exact = seconds // 60, seconds % 60 == 0
                    ok[at] &= sure & exact
                else:
                    ok[at] = False
        epoch[rows], offset[rows], good[rows] = wall - east * 60, east, ok
    return pd.DataFrame({"utc_epoch": pd.Series(epoch, dtype="Int64").where(good), "offset_min": pd.Series(offset, dtype="Int32").where(good)})


def instant(text: Column, zone: Column) -> Column:
    """struct<utc_epoch bigint, offset_min int> of a date text and the zone beside it; nulls where there is no instant."""
    version = zone_version()

    @F.pandas_udf("utc_epoch bigint, offset_min int")
    def convert(texts: pd.Series, zones: pd.Series) -> pd.DataFrame:
        return parse_dates(texts, zones, version)

    return convert(text, zone)


@F.pandas_udf(IntegerType())
def offset_of(texts: pd.Series) -> pd.Series:
    """Minutes east of UTC of an offset text, each distinct spelling parsed once; null if it isn't usable."""
    codes, values = pd.factorize(texts, use_na_sentinel=True)
    table = pd.array([offset_minutes(v) for v in values] + [None], dtype="Int32")
    return pd.Series(table[codes])


def commit_instants(commits: DataFrame) -> DataFrame:
    """git_commit: the wall clock ``date`` lies at ``gmt_offset``; rows without either give nothing."""
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(date as timestamp_ntz))")
    rows = commits.where("date is not null and gmt_offset is not null and id is not null")
    rows = rows.select(F.col("id").cast("string").alias("rec_key"), micros.alias("micros"), offset_of("gmt_offset").alias("offset_min")).where("offset_min is not null")
    seconds = F.expr("(micros - pmod(micros, 1000000L)) div 1000000L")
    return rows.select(F.lit("git_commit").alias("src"), "rec_key", (seconds - F.col("offset_min") * 60).alias("utc_epoch"), "offset_min")


def log_instants(log: DataFrame) -> DataFrame:
    """commit_stat_log: ``date`` is a text of any form, ``orig_timezone`` an offset or zone name used if it has none."""
    rows = log.where("date is not null and log_id is not null").select(F.col("log_id").cast("string").alias("rec_key"), instant(F.col("date"), F.col("orig_timezone")).alias("i"))
    return rows.where("i.utc_epoch is not null").select(F.lit("commit_stat_log").alias("src"), "rec_key", "i.utc_epoch", "i.offset_min")


def blame_instants(blame: DataFrame) -> DataFrame:
    """blame: positive epochs of both hash maps, already UTC; the offset is 0 where ``time_zone`` isn't usable."""
    authors = blame.where("blame_id is not null").select("blame_id", F.explode("authors").alias("author"))
    maps = authors.select("blame_id", F.explode(F.array("author.author_hash_map", "author.commit_hash_map")).alias("m"))
    rows = maps.select("blame_id", F.explode("m").alias("hash", "v")).where("v.epoch > 0").select("blame_id", "hash", "v.epoch", "v.time_zone").distinct()
    seconds = F.expr("case when epoch >= 100000000000000 then epoch div 1000000 when epoch >= 100000000000 then epoch div 1000 else epoch end")
    key = F.concat(F.col("blame_id").cast("string"), F.lit(":"), F.col("hash"))
    return rows.select(F.lit("blame").alias("src"), key.alias("rec_key"), seconds.alias("utc_epoch"), F.coalesce(offset_of("time_zone"), F.lit(0)).alias("offset_min"))


def instants(commits: DataFrame, log: DataFrame, blame: DataFrame) -> DataFrame:
    """All instants of problem 6: src, rec_key, utc_epoch, offset_min; every combination once."""
    return commit_instants(commits).unionByName(log_instants(log)).unionByName(blame_instants(blame)).distinct()
