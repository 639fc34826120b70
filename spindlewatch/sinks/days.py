"""Tables in one folder per day or month, to which deliveries are added.

A delivery replaces the days it holds and no others, in one job: Spark writes
beside the table and swaps whole days in at the end. A filter on days reads only
their folders.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

UNITS = ("day", "month")
DATED = "dated"


def write_days(df: DataFrame, uri: str, delivery: str, instant: str = "data", unit: str = "day") -> None:
    """Add a delivery to the table at ``uri``; days (or months) that it holds are replaced as a whole.

    Rows without a date belong to no day. They lie apart for each ``delivery``,
    so they are replaced only when a delivery of that name comes again. A day of
    any size is written by as many tasks as it needs, small days share one.
    """
    if unit not in UNITS:
        raise ValueError(f"unit has to be one of {UNITS}")
    if delivery == DATED:
        raise ValueError(f"{DATED} is no name for a delivery")
    day = F.to_date(F.date_trunc(unit, F.col(instant).cast("timestamp_ntz")))
    dealt = df.withColumn("day", day).withColumn("undated", F.when(day.isNull(), delivery).otherwise(DATED))
    written = dealt.hint("rebalance", "day", "undated").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy("day", "undated").parquet(uri)


def read_days(
    spark: SparkSession, uri: str, schema: str, first: datetime.date | None = None, last: datetime.date | None = None
) -> DataFrame:
    """Rows of the table at ``uri`` with a column ``day``; only those of the given days, if any are.

    With bounds, rows without a date are left out. ``schema`` names the columns
    to read, so no file has to be opened to find them.
    """
    rows = spark.read.schema(f"{schema}, day date, undated string").parquet(uri).drop("undated")
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first))
    if last is not None:
        rows = rows.where(F.col("day") <= F.lit(last))
    return rows
