"""Telemetry derived from order line items, for tests and benchmarks.

An order stands for a drive, a supplier for a vault, a part name for a model,
the ship date for the observation time, a returned item for a failure and the
price for the power-on hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch.schema import OBSERVED_PATTERN, TELEMETRY

# The columns used, so that no job has to infer them.
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_extendedprice double, "
    "l_returnflag string, l_shipdate timestamp_ntz"
)
PART = "p_partkey bigint, p_name string"
EVENTS = "ts timestamp_ntz, user_id bigint, event_type string"


def load_telemetry(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The raw table: dates and hours as text. Parts are joined only if ``model`` is asked for."""
    wanted = columns or tuple(TELEMETRY.fieldNames())
    rows = spark.read.schema(LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")
    if "model" in wanted:
        parts = spark.read.schema(PART).parquet(f"{sf_dir}/part.parquet")
        rows = rows.join(parts, rows["l_partkey"] == parts["p_partkey"], "left_outer")
    expressions = {
        "data": lambda: F.date_format("l_shipdate", OBSERVED_PATTERN),
        "serial_number": lambda: F.col("l_orderkey").cast("string"),
        "model": lambda: F.col("p_name"),
        "vault_id": lambda: F.col("l_suppkey").cast("int"),
        "failure": lambda: F.when(F.col("l_returnflag").eqNullSafe("R"), 1).otherwise(0),
        "s9_power_on_hours": lambda: F.col("l_extendedprice").cast("string"),
    }
    return rows.select(*[expressions[name]().alias(name) for name in wanted])


def load_error_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as telemetry of few, busy vaults: a user stands for a vault, an error for a failure."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet").select(
        F.date_format("ts", OBSERVED_PATTERN).alias("data"),
        F.col("user_id").cast("int").alias("vault_id"),
        F.when(F.col("event_type").eqNullSafe("error"), 1).otherwise(0).alias("failure"),
    )
