"""Bucketing of clock times and years as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catlens.config import CURRENT_YEAR, UNKNOWN
from catlens.functions.text import _col, strip_ascii

# Bucket names of the ticket job.
LATE_NIGHT = "LATE_NIGHT_0_6"
MORNING = "MORNING_6_12"
AFTERNOON = "AFTERNOON_12_18"
EVENING = "EVENING_18_24"
PRE_1990 = "PRE_1990"
Y1990S = "1990s"
Y2000S = "2000s"
Y2010S = "2010s"
Y2020S = "2020s"

# Fixed value: four ASCII digits HHMM followed by A or P.
CLOCK_PATTERN = r"^[0-9]{4}[AP]$"
# Fixed value: a plain decimal number with optional exponent (no inf/nan,
# no type suffixes, no digit separators).
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def time_of_day_bucket(c: Column | str) -> Column:
    """'HHMMA'/'HHMMP' -> part of day; malformed, hh > 12 or mm > 59 -> UNKNOWN.

    ``hh % 12`` plus 12 for P, so 12xxA is hour 0 and 12xxP / 00xxP hour 12.
    """
    return time_bucket_normalized(normalize_time(c))


def normalize_time(c: Column | str) -> Column:
    """Stripped, upper-case clock text (computed once, then bucketed)."""
    return F.upper(strip_ascii(c))


def time_bucket_normalized(s: Column | str) -> Column:
    """Bucket of an already stripped, upper-case clock text."""
    s = _col(s)
    hh = F.substring(s, 1, 2).try_cast("int")
    mm = F.substring(s, 3, 2).try_cast("int")
    hour24 = (hh % 12) + F.when(F.substring(s, 5, 1) == "P", 12).otherwise(0)
    part = F.element_at(
        F.array(F.lit(LATE_NIGHT), F.lit(MORNING), F.lit(AFTERNOON), F.lit(EVENING)),
        F.floor(hour24 / 6).cast("int") + 1,
    )
    ok = F.coalesce(s.rlike(CLOCK_PATTERN), F.lit(False))
    return F.when(~ok | (hh > 12) | (mm > 59), F.lit(UNKNOWN)).otherwise(part)


def year_bucket(c: Column | str, current_year: int = CURRENT_YEAR) -> Column:
    """Year text -> decade bucket; outside [1970, current_year + 1] -> UNKNOWN.

    Decimals truncate toward zero. Every bound is an integer, so comparing
    the parsed double with the bound equals comparing its truncation, and no
    narrowing cast (which could overflow) is needed.
    """
    return year_bucket_from_number(parse_year(c), current_year)


def parse_year(c: Column | str) -> Column:
    """Stripped year text as a double; NULL unless it is a plain decimal
    number (computed once, then bucketed)."""
    s = strip_ascii(c)
    return F.when(F.coalesce(s.rlike(NUMBER_PATTERN), F.lit(False)), s.try_cast("double"))


def year_bucket_from_number(y: Column | str, current_year: int = CURRENT_YEAR) -> Column:
    """Bucket of a parsed year (double or NULL)."""
    y = _col(y)
    return (
        F.when(y.isNull() | (y < 1970) | (y >= current_year + 2), F.lit(UNKNOWN))
        .when(y < 1990, F.lit(PRE_1990))
        .when(y < 2000, F.lit(Y1990S))
        .when(y < 2010, F.lit(Y2000S))
        .when(y < 2020, F.lit(Y2010S))
        .otherwise(F.lit(Y2020S))
    )
