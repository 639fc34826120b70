"""File sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def write_csv(df: DataFrame, *uris: str, single_file: bool = False) -> None:
    """Write CSV with a header to every URI, replacing what is there.

    With several URIs the result is computed once and kept while it is written.
    ``single_file`` keeps row order in one part file and is meant for report
    tables of a few rows: one task writes them all.
    """
    _fan_out(df, uris, single_file, lambda part, uri: part.write.mode("overwrite").option("header", True).csv(uri))


def write_parquet(df: DataFrame, *uris: str) -> None:
    """Write Parquet to every URI, replacing what is there."""
    _fan_out(df, uris, False, lambda part, uri: part.write.mode("overwrite").parquet(uri))


def _fan_out(df: DataFrame, uris: tuple[str, ...], single_file: bool, write: Callable[[DataFrame, str], None]) -> None:
    if not uris:
        raise ValueError("no URI to write to")
    keep = len(uris) > 1 and not df.is_cached
    if keep:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for uri in uris:
            write(df.coalesce(1) if single_file else df, uri)
    finally:
        if keep:
            df.unpersist()
