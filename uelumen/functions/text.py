"""Text rules as columns. ``strip`` removes every character up to U+0020 from both ends, as trimming means throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX, INT_MAX = "9223372036854775807", "2147483647"


BLANKS = "".join(map(chr, range(33)))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANKS))


def is_blank(c: Column) -> Column:
    """Null, empty or Unicode white space only."""
    return c.isNull() | ~c.rlike(r"[^\s\x1c-\x1f\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]")


def strip_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def sha256(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def event_name(c: Column) -> Column:
    """Lower case, runs of other characters as one ``_``, none at the ends; null if nothing remains."""
    s = F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(s != "", s)


def event_outcome(c: Column) -> Column:
    """'' (also for blank), abort, reject or success; null for null or any other text."""
    s = F.lower(strip(c))
    return F.when(s.isin("", "abort", "reject", "success"), s)


def imsi(c: Column) -> Column:
    s = strip(c)
    return F.when(s.rlike(r"\A[0-9]{5,15}\z"), s)


def msisdn(c: Column) -> Column:
    s = F.regexp_replace(c, r"[\s()+-]", "")
    return F.when(s.rlike(r"\A[0-9]{5,15}\z"), s)


def mtmsi(c: Column) -> Column:
    s = F.regexp_replace(F.upper(strip(c)), r"\A0X", "")
    return F.when(s.rlike(r"\A(?:[0-9]{1,10}|[0-9A-F]{1,8})\z"), s)


def _whole(c: Column, kind: str) -> tuple[Column, Column]:
    s = strip(c)
    value = F.when(s.rlike(r"\A[+-]?[0-9]+\z"), s.try_cast(kind))
    return s, value


def nullable_number(c: Column, kind: str = "long") -> Column:
    """A non-negative whole number; null for blank and for what :func:`number_fault` reports."""
    _, value = _whole(c, kind)
    return F.when(value >= 0, value)


def number_fault(c: Column, kind: str = "long") -> Column:
    """True where a non-blank text is no non-negative whole number that fits ``kind``."""
    s, value = _whole(c, kind)
    return ~is_blank(c) & (s != "") & F.coalesce(value < 0, F.lit(True))


def first_of(*columns: Column, default: str = "-") -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.when(c.cast("string") != "", c.cast("string")) for c in columns], F.lit(default))
