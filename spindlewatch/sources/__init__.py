from spindlewatch.sources.telemetry import (
    build_if_absent,
    ingest_days,
    ingest_extract,
    read_csv,
    read_extract_days,
    read_parquet,
    read_raw_csv,
)

__all__ = [
    "build_if_absent",
    "ingest_days",
    "ingest_extract",
    "read_csv",
    "read_extract_days",
    "read_parquet",
    "read_raw_csv",
]
