"""Failure totals kept by increments: partial sums of each day, added up on reading.

The partial sums are a table in one folder per day (``sinks.days``). When a day
is delivered again, its partial sums replace the old ones, which takes the old
rows out of all totals. Nothing else is read or written, so a delivery costs
its own rows and not the history's.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch.functions import instant_of
from spindlewatch.sinks.days import read_days, write_days

PARTIALS = "data timestamp_ntz, vault_id int, model string, failures bigint, failed bigint, observations bigint"


def add_to_totals(telemetry: DataFrame, uri: str, delivery: str, unit: str = "day") -> None:
    """Replace the partial sums of the days in ``telemetry``.

    A delivery has to hold all rows of its days (of its months, if ``unit`` is ``month``).
    """
    start = F.date_trunc(unit, instant_of(telemetry).cast("timestamp_ntz")).cast("timestamp_ntz")
    rows = telemetry.select(start.alias("data"), "vault_id", "model", "failure")
    partials = rows.groupBy("data", "vault_id", "model").agg(
        F.sum("failure").alias("failures"),
        F.count(F.when(F.col("failure") == 1, 1)).alias("failed"),
        F.count("*").alias("observations"),
    )
    write_days(partials, uri, delivery, "data", unit)


def read_totals(spark: SparkSession, uri: str, by: Sequence[str], first=None, last=None) -> DataFrame:
    """``by`` (of ``day``, ``vault_id`` and ``model``) with the sum of failures, the failed rows and all rows."""
    partials = read_days(spark, uri, PARTIALS, first, last)
    sums = [F.sum(name).alias(name) for name in ("failures", "failed", "observations")]
    return partials.groupBy(*by).agg(*sums)
