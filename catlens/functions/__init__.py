"""Scalar column functions (native Spark expressions, no UDFs)."""

from catlens.functions.buckets import time_of_day_bucket, year_bucket
from catlens.functions.text import clean_category, int_to_string, lenient_int, strip_ascii

__all__ = [
    "clean_category",
    "int_to_string",
    "lenient_int",
    "strip_ascii",
    "time_of_day_bucket",
    "year_bucket",
]
