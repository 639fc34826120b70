"""The telemetry table: one row per drive and observation time."""

from __future__ import annotations

from pyspark.sql import types as T

# Text formats of the input and of the daily report.
OBSERVED_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
REPORT_DAY_PATTERN = "dd-MM-yyyy"

TELEMETRY = T.StructType(
    [
        T.StructField("data", T.StringType()),
        T.StructField("serial_number", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("vault_id", T.IntegerType()),
        T.StructField("failure", T.IntegerType()),
        T.StructField("s9_power_on_hours", T.DoubleType()),
    ]
)

# The member that holds a column's value where a CSV-to-Parquet
# conversion left a union struct instead of a plain column.
UNION_MEMBERS = {
    "serial_number": "member1",
    "vault_id": "member0",
    "failure": "member0",
    "s9_power_on_hours": "member0",
}

# Columns each report needs, hence the columns of its extract.
EXTRACT_COLUMNS = {
    "daily": ("data", "vault_id", "failure"),
    "rankings": ("vault_id", "model", "failure"),
    "hours": ("data", "serial_number", "failure", "s9_power_on_hours"),
}

# One cell per field of a keyed hash.
CELLS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("field", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
