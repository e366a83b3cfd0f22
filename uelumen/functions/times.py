"""Event times as ISO-8601 UTC text with 0, 3, 6 or 9 fraction digits, and their epoch milliseconds.

Accepted: 13 digits (epoch milliseconds), ISO date-times with an offset, and ``yyyy-MM-dd HH:mm:ss`` with up to nine
fraction digits in a zone. Local times that a change of the zone's offset skips or repeats are rejected.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from uelumen.functions.text import strip

LOCAL = r"\A(\d{4}-\d\d-\d\d) (\d\d:\d\d:\d\d)(?:\.(\d{1,9}))?\z"
OFFSET = r"\A(\d{4}-\d\d-\d\d)T(\d\d:\d\d(?::\d\d)?)(?:\.(\d{1,9}))?(Z|z|[+-]\d\d:\d\d(?::\d\d)?)\z"


@functools.lru_cache(maxsize=16)
def unclear_local_times(zone: str, first: int = 1970, last: int = 2069) -> list[tuple[str, str]]:
    """[from, to) of the local times that a change of offset skips or repeats."""
    tz, out = ZoneInfo(zone), []
    at, end = datetime(first, 1, 1, tzinfo=timezone.utc), datetime(last + 1, 1, 1, tzinfo=timezone.utc)
    while at < end:
        after = at + timedelta(days=7)
        if at.astimezone(tz).utcoffset() != after.astimezone(tz).utcoffset():
            lo, hi = at, after
            while hi - lo > timedelta(seconds=1):
                mid = (lo + (hi - lo) / 2).replace(microsecond=0)
                lo, hi = (mid, hi) if mid.astimezone(tz).utcoffset() == lo.astimezone(tz).utcoffset() else (lo, mid)
            borders = [(hi.replace(tzinfo=None) + x.astimezone(tz).utcoffset()).strftime("%Y-%m-%d %H:%M:%S") for x in (lo, hi)]
            out.append((min(borders), max(borders)))
        at = after
    return out


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _clock_of(seconds: Column) -> Column:
    """HH:mm:ss of epoch seconds, whatever the session's zone."""
    return F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in (F.floor(F.pmod(seconds, F.lit(86_400)) / 3600), F.floor(F.pmod(seconds, F.lit(3600)) / 60), F.pmod(seconds, F.lit(60)))])


def _instant(seconds: Column, fraction: Column) -> Column:
    """ISO text of epoch seconds and a fraction of nine digits."""
    date = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int")).cast("string")
    digits = F.when(fraction == "000000000", "").when(F.substring(fraction, 4, 6) == "000000", F.substring(fraction, 1, 3)).when(F.substring(fraction, 7, 3) == "000", F.substring(fraction, 1, 6)).otherwise(fraction)
    return F.concat(date, F.lit("T"), _clock_of(seconds), F.regexp_replace(F.concat(F.lit("."), digits), r"\A\.\z", ""), F.lit("Z"))


def _seconds(pattern: Column) -> Column:
    """Seconds from 1970-01-01 of a plain date and time, null if there is no such date or time."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), pattern.try_cast("timestamp_ntz"))


def _local(s: Column, zone: str) -> Column:
    def utc(pattern: Column) -> Column:
        unclear = F.lit(False)
        for a, b in unclear_local_times(zone):
            unclear = unclear | ((pattern >= a) & (pattern < b))
        return F.when(~unclear, F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(_seconds(pattern)), zone)))

    return bind(F.regexp_replace(s, r"\.\d+\z", ""), utc)


def _offset(sign: Column) -> Column:
    """Seconds east of UTC of ``Z`` or ``+hh:mm[:ss]``, null beyond 18 hours."""
    hours, minutes, secs = (F.substring(sign, i, 2).try_cast("int") for i in (2, 5, 8))
    size = bind(hours * 3600 + minutes * 60 + F.coalesce(secs, F.lit(0)), lambda x: F.when((x <= 18 * 3600) & (minutes < 60), x))
    return F.when(F.upper(sign) == "Z", 0).otherwise(F.when(sign.startswith("-"), -1).otherwise(1) * size)


def _parts(text: Column, zone: str) -> Column:
    """struct(seconds, fraction): epoch seconds (null if not accepted) and nine fraction digits."""

    def of(s: Column) -> Column:
        plain = F.concat_ws(" ", F.regexp_extract(s, OFFSET, 1), F.rpad(F.regexp_extract(s, OFFSET, 2), 8, ":00"))
        kind = F.when(s.rlike(r"\A\d{13}\z"), 1).when(s.rlike(LOCAL), 2).when(s.rlike(OFFSET), 3)
        return bind(
            kind,
            lambda k: F.struct(
                F.when(k == 1, F.substring(s, 1, 10).try_cast("long")).when(k == 2, _local(s, zone)).when(k == 3, _seconds(plain) - bind(F.regexp_extract(s, OFFSET, 4), _offset)).cast("long").alias("seconds"),
                F.rpad(F.when(k == 1, F.substring(s, 11, 3)).when(k == 2, F.regexp_extract(s, LOCAL, 3)).when(k == 3, F.regexp_extract(s, OFFSET, 3)).otherwise(""), 9, "0").alias("fraction"),
            ),
        )

    return bind(strip(text), of)


def normalise(text: Column, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """ISO UTC text, or null where the text is no accepted time."""
    return bind(_parts(text, zone), lambda p: F.when(p["seconds"].isNotNull(), _instant(p["seconds"], p["fraction"])))


def epoch_millis(iso: Column) -> Column:
    """Milliseconds of ISO UTC text; the fraction beyond them is cut."""
    return bind(_parts(iso, "UTC"), lambda p: p["seconds"] * 1000 + F.substring(p["fraction"], 1, 3).cast("long"))


def clock(iso: Column, zone: str = "Asia/Ho_Chi_Minh") -> Column:
    """HH:mm:ss in a zone; the text itself where it is no time."""
    local = bind(_parts(iso, "UTC"), lambda p: bind(F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(p["seconds"]), zone)), _clock_of))
    return F.coalesce(F.when(local != "", local), iso)


def now_iso() -> Column:
    ms = F.unix_millis(F.current_timestamp())
    return _instant(F.floor(ms / 1000), F.rpad(F.lpad((ms % 1000).cast("string"), 3, "0"), 9, "0"))
