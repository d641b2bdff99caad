"""Lenient text parsing as native column expressions (B2, C3, strip).

All of these stay inside whole-stage codegen: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catlens.config import UNKNOWN

# Fixed value: the ASCII whitespace set that is stripped from both ends
# (space, tab, line feed, carriage return, form feed, vertical tab).
STRIP_CHARS = " \t\n\r\f\x0b"

# Fixed value: an optionally signed integer, optionally followed by a
# fractional part that is dropped (truncation, as a non-ANSI cast does).
LENIENT_INT_PATTERN = r"^([+-]?[0-9]+)([.][0-9]*)?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ascii(c: Column | str) -> Column:
    """Remove ASCII whitespace from both ends (a character-set trim, no regex)."""
    return F.btrim(_col(c), F.lit(STRIP_CHARS))


def lenient_int(c: Column | str) -> Column:
    """String -> int; '21', ' 21 ', '+5', '21.7', '21.' parse, anything else is NULL.

    Safe under ANSI mode: ``try_cast`` turns overflow (and the empty string a
    non-match extracts) into NULL instead of raising; the regex keeps text and
    exponents out. One regex evaluation per row.
    """
    return F.regexp_extract(strip_ascii(c), LENIENT_INT_PATTERN, 1).try_cast("int")


def clean_category(c: Column | str) -> Column:
    """NULL or blank -> 'UNKNOWN', otherwise the stripped text (case kept)."""
    return F.coalesce(F.nullif(strip_ascii(c), F.lit("")), F.lit(UNKNOWN))


def int_to_string(c: Column | str) -> Column:
    """Class name of a code: its decimal string."""
    return _col(c).cast("string")
