"""Rows and small helpers that the tests share. Fixtures are in conftest.py."""

from __future__ import annotations

from pyspark.sql import types as T

from spindlewatch.schema import TELEMETRY

TABLES = "/root/testdata/sf0.001"


def day(number: int, clock: str = "00:00:00.000000") -> str:
    return f"2023-04-{number:02d}T{clock}"


def telemetry(spark, rows):
    """Raw telemetry: (data, serial, model, vault, failure, hours as text)."""
    schema = T.StructType(
        [f if f.name != "s9_power_on_hours" else T.StructField(f.name, T.StringType()) for f in TELEMETRY]
    )
    return spark.createDataFrame(rows, schema)


def values(df):
    return [tuple(row) for row in df.collect()]


EDGE_ROWS = [
    (day(1), "A", "M1", 1, 0, "10"),
    (day(2), "A", "M1", 1, 1, "20"),
    (day(3), "A", "M1", 1, 0, "30"),
    (day(3), "A", "M1", 1, 0, "31"),
    (day(1), "B", "M2", 1, 0, None),
    ("junk", "B", "M2", 1, 1, "5"),
    ("junk", "C", "M2", 2, 0, "7"),
    (day(1), None, "M3", None, 1, "9"),
    (day(1), "D", None, 2, 1, "abc"),
    (day(1), "E", "M1", 2, None, "4"),
    (day(1), "F", "M1", 2, 2, "4"),
]
