"""CSV folder source and sinks (A1, A2, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_csv_dir(spark: SparkSession, path: str, enforce_schema: bool = False) -> DataFrame:
    """Read a folder (or glob, or any Hadoop filesystem URI) of CSV files with a
    header row; every column is a string (no inference pass over the data).

    ``enforceSchema=false`` checks each file's header against the first one, so
    a file with swapped columns raises instead of being read by position.
    """
    return (
        spark.read.format("csv")
        .option("header", "true")
        .option("enforceSchema", "true" if enforce_schema else "false")
        .option("inferSchema", "false")
        .option("mode", "PERMISSIVE")
        .load(path)
    )


def write_csv_dir(df: DataFrame, path: str, mode: str = "error") -> str:
    """Write ``df`` as a CSV folder with a header, keeping blanks as they are
    (the writer trims leading/trailing blanks by default; that is turned off
    so that blank fields survive a round trip)."""
    (
        df.write.mode(mode)
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Results sink: persist a report DataFrame as Parquet."""
    df.write.mode(mode).parquet(path)
    return path
