"""The ``tickets_raw`` fixture: messy all-string ticket-like rows derived from
the driver's ``orders``, ``customer`` and ``nation`` tables.

The column rules are fixed values of the test fixture (FIXTURES.md §2); the
same text runs as SQL in the oracle. Work grows with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TICKET_FIXTURE_COLUMNS = (
    "row_id", "code_raw", "time_raw", "year_raw", "segment", "zone", "color", "status", "priority", "nation",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def tickets_from_tables(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Build the fixture rows.

    Join strategy is left to Catalyst's size check: a side is broadcast only
    when its estimated size is below ``spark.sql.autoBroadcastJoinThreshold``
    (``nation`` always; ``customer`` at small scale), otherwise the join
    shuffles on the key, and AQE re-plans from real sizes and splits a hot
    customer key. No broadcast hint, so nothing unbounded is forced onto
    every executor."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    c = customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    n = nation.select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])

    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    sig = (ck * (ck % 7)) % 23  # the code signal, shared by code, zone and color

    code_raw = (
        F.when(k % 37 == 0, F.lit("abc"))
        .when(k % 41 == 0, F.lit(None).cast("string"))
        .when(k % 43 == 0, F.concat(F.lit(" "), _s(ck % 23), F.lit(".0 ")))
        .otherwise(_s(sig))
    )
    time_raw = (
        F.when(k % 29 == 0, F.lit(None).cast("string"))
        .when(k % 31 == 0, F.lit("1360A"))
        .when(k % 53 == 0, F.lit("930A"))
        .otherwise(
            F.concat(
                F.when(k % 5 == 0, F.lit(" ")).otherwise(F.lit("")),
                F.lpad(_s((ck * 7) % 13), 2, "0"),
                F.lpad(_s(k % 60), 2, "0"),
                F.when(k % 2 == 0, F.lit("A")).when(k % 3 == 0, F.lit("p")).otherwise(F.lit("P")),
            )
        )
    )
    year_raw = (
        F.when(k % 47 == 0, F.lit("n/a"))
        .when(k % 59 == 0, F.lit("0"))
        .when(k % 61 == 0, F.lit("2030"))
        .when(k % 67 == 0, F.lit("1999.9"))
        .otherwise(_s(1968 + (ck * 3 + k) % 62))
    )
    segment = F.when(k % 71 == 0, F.lit("   ")).otherwise(
        F.concat(F.col("c_mktsegment"), F.when(k % 3 == 0, F.lit(" ")).otherwise(F.lit("")))
    )
    zone = F.concat(F.lit("Z"), _s(F.when(k % 4 == 0, k % 6).otherwise(sig % 6)))
    color = F.concat(F.lit("C"), _s(F.when(k % 3 == 0, ck % 4).otherwise(sig % 4)))

    return j.select(
        k.alias("row_id"),
        code_raw.alias("code_raw"),
        time_raw.alias("time_raw"),
        year_raw.alias("year_raw"),
        segment.alias("segment"),
        zone.alias("zone"),
        color.alias("color"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("n_name").alias("nation"),
    )


def tickets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture view over the parquet tables in ``sf_dir``."""
    return tickets_from_tables(
        read_table(spark, sf_dir, "orders"),
        read_table(spark, sf_dir, "customer"),
        read_table(spark, sf_dir, "nation"),
    )
