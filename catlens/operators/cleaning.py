"""Projection, parsing and cleaning of the raw table.

``clean`` is one projection over the source: select the needed columns, parse
the code leniently, drop rows without a code, bucket time and year and clean
every categorical column, all as native expressions in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catlens.config import JobConfig
from catlens.functions import clean_category, lenient_int
from catlens.functions.buckets import normalize_time, parse_year, time_bucket_normalized, year_bucket_from_number

SPLIT_HASH = "_split_h"


def qcol(name: str) -> Column:
    """Column by exact name (spaces, '?', dots and backticks are literal)."""
    return F.col("`" + name.replace("`", "``") + "`")


def select_needed(df: DataFrame, cols) -> DataFrame:
    """B1: keep only ``cols``; a missing name fails at analysis time."""
    return df.select(*[qcol(c) for c in cols])


def preview(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """A3: first ``n`` rows; ordered by a key when one is given (deterministic)."""
    if order_by is not None:
        df = df.orderBy(qcol(order_by))
    return df.limit(n)


def content_text(cols) -> Column:
    """The row's raw values as one text, NULL kept apart from blank (fixed form, so SQL can reproduce it)."""
    return F.concat_ws("\x1f", *[F.coalesce(qcol(c).cast("string"), F.lit("\\N")) for c in cols])


def row_hash(key: Column | None, raw_cols, salt: str = "") -> Column:
    """32-bit split hash in [0, 2^32): the first 8 hex digits of an md5 that SQL can reproduce.

    With a key: of the key's text; a NULL key falls back to the row's raw
    values, so no row is without a hash. Without a key: of the row's raw
    values. Either way the hash does not depend on partitioning.
    """
    text = content_text(raw_cols)
    if key is not None:
        text = F.coalesce(key.cast("string"), F.concat(F.lit("\x1e"), text))
    if salt:
        text = F.concat(F.lit(salt), text)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def with_code(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """B2 + B3: lenient integer code; rows whose code does not parse are dropped."""
    return df.withColumn(cfg.code_out, lenient_int(qcol(cfg.code_col))).filter(F.col(cfg.code_out).isNotNull())


_T = "_time_norm"
_Y = "_year_norm"


def clean(df: DataFrame, cfg: JobConfig) -> DataFrame:
    """The usable, cleaned rows with the split hash attached.

    Output: key (if any), code, both buckets, the cleaned categories and the
    split hash; the raw code/time/year text is not carried further (it is
    what a cache of this table would otherwise hold for nothing). The time
    and year text is normalised in its own projection, so the bucket rules
    read it once instead of re-stripping it per branch.
    """
    sel = select_needed(df, cfg.needed_cols)
    key = qcol(cfg.key_col) if cfg.key_col is not None else None
    sel = sel.withColumn(SPLIT_HASH, row_hash(key, cfg.needed_cols, cfg.split_salt))
    usable = with_code(sel, cfg)
    norm = usable.withColumns({_T: normalize_time(qcol(cfg.time_col)), _Y: parse_year(qcol(cfg.year_col))})
    derived = {
        cfg.hour_bucket_out: time_bucket_normalized(F.col(_T)),
        cfg.year_bucket_out: year_bucket_from_number(F.col(_Y), cfg.current_year),
    }
    derived.update({c: clean_category(qcol(c)) for c in cfg.categorical_cols})
    keep = ([cfg.key_col] if cfg.key_col is not None else []) + [cfg.code_out, cfg.hour_bucket_out, cfg.year_bucket_out]
    keep += [c for c in cfg.categorical_cols if c not in keep] + [SPLIT_HASH]
    return norm.withColumns(derived).select(*[qcol(c) for c in keep])


def require_rows(n_rows: int) -> int:
    """Stop with a clear message when no usable row is left."""
    if n_rows == 0:
        raise ValueError("No usable rows: check the input path and the column names.")
    return n_rows
