"""Edge tables and randomized checks for the scalar functions."""

import random
import string

import pytest
from pyspark.sql import functions as F

from catlens.functions import clean_category, lenient_int, time_of_day_bucket, year_bucket


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


LENIENT = [
    ("21", 21), (" 21 ", 21), ("+5", 5), ("21.7", 21), ("21.", 21), (".5", None), ("abc", None),
    ("1e2", None), ("99999999999", None), ("", None), (None, None), ("-3", -3), ("\t7\n", 7),
]


def test_lenient_int_edges(spark):
    got = _eval(spark, [v for v, _ in LENIENT], lenient_int)
    assert got == [e for _, e in LENIENT]


def test_ansi_is_on_and_lenient_int_does_not_raise(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("abc",), ("12.5",), ("99999999999",)], "v string")
    with pytest.raises(Exception):
        df.select(F.col("v").cast("int")).collect()
    assert [r[0] for r in df.select(lenient_int("v")).collect()] == [None, 12, None]


TIME = [
    ("0930A", "MORNING_6_12"), ("1200A", "LATE_NIGHT_0_6"), ("1200P", "AFTERNOON_12_18"),
    ("0030P", "AFTERNOON_12_18"), ("0000A", "LATE_NIGHT_0_6"), ("0559A", "LATE_NIGHT_0_6"),
    ("0600A", "MORNING_6_12"), ("1159A", "MORNING_6_12"), ("0559P", "AFTERNOON_12_18"),
    ("0600P", "EVENING_18_24"), (" 0615p ", "EVENING_18_24"), ("1159P", "EVENING_18_24"),
    ("1300A", "UNKNOWN"), ("1260A", "UNKNOWN"), ("930A", "UNKNOWN"), ("09:30A", "UNKNOWN"),
    ("0930X", "UNKNOWN"), ("0930", "UNKNOWN"), ("   ", "UNKNOWN"), (None, "UNKNOWN"),
]


def test_time_bucket_edges(spark):
    got = _eval(spark, [v for v, _ in TIME], time_of_day_bucket)
    assert got == [e for _, e in TIME]


YEAR = [
    ("1969", "UNKNOWN"), ("1969.99", "UNKNOWN"), ("1970", "PRE_1990"), ("1989.9", "PRE_1990"),
    ("1990", "1990s"), ("1999.9", "1990s"), ("2000", "2000s"), ("2010", "2010s"), ("2019", "2010s"),
    ("2020", "2020s"), ("2027", "2020s"), ("2027.9", "2020s"), ("2028", "UNKNOWN"), ("2e3", "2000s"),
    (" 2015 ", "2010s"), ("0", "UNKNOWN"), ("-5", "UNKNOWN"), ("nan", "UNKNOWN"), ("inf", "UNKNOWN"),
    ("2015d", "UNKNOWN"), ("1_990", "UNKNOWN"), ("n/a", "UNKNOWN"), ("", "UNKNOWN"), (None, "UNKNOWN"),
    ("1e400", "UNKNOWN"),
]


def test_year_bucket_edges(spark):
    got = _eval(spark, [v for v, _ in YEAR], year_bucket)
    assert got == [e for _, e in YEAR]


CATS = [(None, "UNKNOWN"), ("", "UNKNOWN"), ("   ", "UNKNOWN"), ("\t", "UNKNOWN"), (" NY ", "NY"),
        ("ny", "ny"), ("014", "014"), ("a b", "a b")]


def test_clean_category_edges(spark):
    got = _eval(spark, [v for v, _ in CATS], clean_category)
    assert got == [e for _, e in CATS]


# --- independent statement of the rules, test-only ---------------------------------

WS = " \t\n\r\f\x0b"


def py_time(v):
    if v is None:
        return "UNKNOWN"
    s = v.strip(WS).upper()
    if len(s) != 5 or any(ch not in string.digits for ch in s[:4]) or s[4] not in "AP":
        return "UNKNOWN"
    hh, mm = int(s[:2]), int(s[2:4])
    if hh > 12 or mm > 59:
        return "UNKNOWN"
    h = hh % 12 + (12 if s[4] == "P" else 0)
    return ["LATE_NIGHT_0_6", "MORNING_6_12", "AFTERNOON_12_18", "EVENING_18_24"][h // 6]


def py_year(v, current=2026):
    import re

    if v is None:
        return "UNKNOWN"
    s = v.strip(WS)
    if not re.fullmatch(r"[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?", s):
        return "UNKNOWN"
    f = float(s)
    if f != f or f in (float("inf"), float("-inf")):
        return "UNKNOWN"
    y = int(f)
    if y < 1970 or y > current + 1:
        return "UNKNOWN"
    for bound, name in ((1990, "PRE_1990"), (2000, "1990s"), (2010, "2000s"), (2020, "2010s")):
        if y < bound:
            return name
    return "2020s"


def _random_strings(seed, alphabet, n=3000):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 7)))) for _ in range(n)]


def test_time_bucket_matches_rules_on_random_strings(spark):
    vals = _random_strings(1, "0123456789AaPp :x\t") + [f"{h:02d}{m:02d}{ap}" for h in range(14) for m in (0, 30, 59, 60) for ap in "AP"]
    got = _eval(spark, vals, time_of_day_bucket)
    assert got == [py_time(v) for v in vals]


def test_year_bucket_matches_rules_on_random_strings(spark):
    vals = _random_strings(2, "0123456789.+-eE x") + [str(y) for y in range(1960, 2035)] + [f"{y}.5" for y in range(1965, 2030)]
    got = _eval(spark, vals, year_bucket)
    assert got == [py_year(v) for v in vals]


def py_lenient_int(v):
    import re

    if v is None:
        return None
    m = re.fullmatch(r"([+-]?[0-9]+)([.][0-9]*)?", v.strip(WS))
    if not m:
        return None
    n = int(m.group(1))
    return n if -(2**31) <= n < 2**31 else None


def py_clean(v):
    if v is None or v.strip(WS) == "":
        return "UNKNOWN"
    return v.strip(WS)


def test_lenient_int_matches_rules_on_random_strings(spark):
    vals = _random_strings(3, "0123456789.+- e\tx") + ["2147483647", "2147483648", "-2147483648", "-2147483649"]
    got = _eval(spark, vals, lenient_int)
    assert got == [py_lenient_int(v) for v in vals]


def test_clean_category_matches_rules_on_random_strings(spark):
    vals = _random_strings(4, "ab \t\n\r\x0bY1") + [None]
    got = _eval(spark, vals, clean_category)
    assert got == [py_clean(v) for v in vals]


def test_keyless_row_hash_separates_null_positions(spark):
    from catlens.operators.cleaning import row_hash

    df = spark.createDataFrame(
        [(None, "x"), ("x", None), (None, None), ("x", "x"), ("x", "x")], "a string, b string"
    )
    rows = df.select(row_hash(None, ["a", "b"]).alias("h"), row_hash(None, ["a", "b"], "s").alias("hs")).collect()
    h = [r.h for r in rows]
    assert len(set(h[:4])) == 4 and h[3] == h[4]
    assert all(0 <= v < 2**32 for v in h)
    assert [r.hs for r in rows] != h
    # keyed: md5 prefix of the key text, as the SQL oracle computes it
    k = spark.createDataFrame([(7,)], "k long").select(row_hash(F.col("k"), []).alias("h")).first().h
    import hashlib

    assert k == int(hashlib.md5(b"7").hexdigest()[:8], 16)
