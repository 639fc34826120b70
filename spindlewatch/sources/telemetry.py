"""Reading telemetry and building the per-report extracts."""

from __future__ import annotations

import datetime
import hashlib
import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch import storage
from spindlewatch.functions import instant_of, typed_telemetry
from spindlewatch.schema import EXTRACT_COLUMNS, TELEMETRY
from spindlewatch.sinks.days import read_days, write_days
from spindlewatch.sinks.tables import write_csv, write_parquet

PROVENANCE = "_made_from.json"


def read_parquet(spark: SparkSession, uri: str) -> DataFrame:
    """Typed telemetry. The footer's schema decides, so union structs and plain columns both work."""
    return typed_telemetry(spark.read.parquet(uri))


def read_raw_csv(spark: SparkSession, uri: str, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Columns by header name, all text: no inference pass over the data.

    Files whose headers differ are an error. They are never read by position.
    """
    raw = spark.read.option("header", True).option("enforceSchema", False).csv(uri)
    return raw.withColumnsRenamed(dict(renames or {}))


def read_csv(spark: SparkSession, uri: str, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Typed telemetry from CSV with a header."""
    return typed_telemetry(read_raw_csv(spark, uri, renames))


def provenance(spark: SparkSession, inputs: str, **settings: object) -> dict[str, object]:
    """What an output is made from: the input files with sizes and times of change, and the settings of the build.

    Files are counted, added up and digested, so the record is small however many there are.
    """
    files = storage.files_below(spark, inputs)
    digest = hashlib.sha256()
    for path, size, changed in files:
        digest.update(f"{path}\0{size}\0{changed}\n".encode())
    return {
        "inputs": inputs,
        "files": len(files),
        "bytes": sum(size for _, size, _ in files),
        "newest": max((changed for _, _, changed in files), default=0),
        "digest": digest.hexdigest(),
        **settings,
    }


def recorded_provenance(spark: SparkSession, uri: str) -> dict[str, object] | None:
    """The record beside the commit marker of ``uri``; None if there is none."""
    record = f"{uri.rstrip('/')}/{PROVENANCE}"
    return json.loads(storage.read_text(spark, record)) if storage.exists(spark, record) else None


def build_if_absent(
    spark: SparkSession, uri: str, build: Callable[[str], None], made_from: Mapping[str, object] | None = None
) -> bool:
    """Run ``build(uri)`` unless an earlier run committed ``uri``. Returns whether it ran.

    With ``made_from``, a committed output counts only if it was made from just
    that. The record is written after the commit marker, so an output without
    one, or with that of another input, is built again.
    """
    if storage.committed(spark, uri) and (made_from is None or recorded_provenance(spark, uri) == dict(made_from)):
        return False
    build(uri)
    if made_from is not None:
        storage.replace_text(spark, f"{uri.rstrip('/')}/{PROVENANCE}", json.dumps(made_from, indent=1))
    return True


def ingest_extract(
    spark: SparkSession,
    raw_csv: str,
    csv_extract: str,
    parquet_extract: str,
    columns: Sequence[str] | str,
    renames: Mapping[str, str] | None = None,
    follow_changes: bool = False,
) -> dict[str, bool]:
    """Raw CSV to a CSV extract of a report's columns to a Parquet extract.

    ``columns`` is a list or the name of a report. Every stage is skipped if its
    output is complete; the result tells which stages ran. With
    ``follow_changes`` a complete output is skipped only if the files, renames
    and columns it was made from are still the same. Both stages only
    project, so they run without a shuffle. The Parquet extract is typed: dates
    are parsed here, once, and kept as timestamps without a zone.
    """
    if not storage.exists(spark, raw_csv):
        raise FileNotFoundError(raw_csv)
    wanted = EXTRACT_COLUMNS[columns] if isinstance(columns, str) else tuple(columns)

    def csv_stage(uri: str) -> None:
        write_csv(read_raw_csv(spark, raw_csv, renames).select(*[F.col(c) for c in wanted]), uri)

    def parquet_stage(uri: str) -> None:
        typed = read_csv(spark, csv_extract)
        if "data" in typed.columns:
            typed = typed.withColumn("data", instant_of(typed).cast("timestamp_ntz"))
        write_parquet(typed, uri)

    def made_from(inputs: str) -> dict[str, object] | None:
        settings = {"columns": list(wanted), "renames": dict(renames or {})}
        return provenance(spark, inputs, **settings) if follow_changes else None

    csv_built = build_if_absent(spark, csv_extract, csv_stage, made_from(raw_csv))
    # The record of the second stage is taken after the first one has run.
    return {
        "csv": csv_built,
        "parquet": build_if_absent(spark, parquet_extract, parquet_stage, made_from(csv_extract)),
    }


def ingest_days(
    spark: SparkSession,
    raw_csv: str,
    extract: str,
    delivery: str,
    columns: Sequence[str] | str,
    renames: Mapping[str, str] | None = None,
    unit: str = "day",
) -> None:
    """One delivery of raw CSV into a typed extract with a folder per day (or month).

    Days that the delivery holds are replaced as a whole, all others stay
    untouched. The columns have to include ``data``.
    """
    wanted = EXTRACT_COLUMNS[columns] if isinstance(columns, str) else tuple(columns)
    typed = read_csv(spark, raw_csv, renames).select(*wanted)
    write_days(typed.withColumn("data", instant_of(typed).cast("timestamp_ntz")), extract, delivery, "data", unit)


def read_extract_days(
    spark: SparkSession,
    extract: str,
    columns: Sequence[str] | str,
    first: datetime.date | None = None,
    last: datetime.date | None = None,
) -> DataFrame:
    """Typed telemetry of the given days of an extract; no other days are read."""
    wanted = EXTRACT_COLUMNS[columns] if isinstance(columns, str) else tuple(columns)
    types = {f.name: f.dataType.simpleString() for f in TELEMETRY} | {"data": "timestamp_ntz"}
    return read_days(spark, extract, ", ".join(f"{name} {types[name]}" for name in wanted), first, last)
