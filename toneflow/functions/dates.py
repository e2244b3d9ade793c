"""Timestamps of articles.  Calendar days are UTC days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# The usual form, which Spark reads as it is.
USUAL_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}(:\d{2})?)?)?$"
# Extended or basic date; hour, minute, second and fraction; zone.
ISO_DATE = r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
ISO_CLOCK = r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
ISO_ZONE = r"(?:(Z)|([+-]\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.]\d+)?)?)?)?)?$"
ISO_TIME = ISO_DATE + ISO_CLOCK + ISO_ZONE


def parse_iso(text: Column) -> Column:
    """ISO-8601 date or time with offset or ``Z``; null when it does not parse.

    Takes the extended and the basic form, any sign between date and time, a
    comma or point before the fraction, of which microseconds count, and
    offsets with or without colon.  A plain cast would also take a year, a time
    of day (of today) or a named zone, which are not timestamps of an article.
    """
    def part(*groups: int, default: str = "00") -> Column:
        found = F.concat(*[F.regexp_extract(text, ISO_TIME, g) for g in groups])
        return F.when(found == "", F.lit(default)).otherwise(found)

    fraction = F.rpad(part(9, default="0"), 6, "0")
    offset = F.when(part(11, default="") == "", F.lit("+00:00")).otherwise(F.concat(part(11), F.lit(":"), part(12), F.lit(":"), part(13)))
    plain = F.concat(part(1), F.lit("-"), part(2, 4), F.lit("-"), part(3, 5), F.lit("T"), part(6), F.lit(":"), part(7),
                     F.lit(":"), part(8), F.lit("."), fraction, offset)
    return F.when(F.rlike(text, F.lit(USUAL_TIME)), F.try_to_timestamp(text)).when(
        F.rlike(text, F.lit(ISO_TIME)), F.try_to_timestamp(plain))


def day(ts: Column) -> Column:
    return F.to_date(ts)


def day_stamp(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def day_prefix(text: Column) -> Column:
    """First ten characters of an ISO timestamp, without parsing it."""
    return F.substring(text, 1, 10)


def within_days(ts: Column, now: Column, days: int) -> Column:
    """``now - days <= ts <= now``; whole multiples of 24 hours."""
    return ts.between(now - F.make_dt_interval(F.lit(days)), now)
