"""Whole jobs: a report from telemetry to its CSV tables and keyed hashes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from spindlewatch.functions import joined_text, not_null
from spindlewatch.plans import daily_vault_failures, hours_by_cohort, rank_vaults, top_models
from spindlewatch.sinks import hashes, write_csv
from spindlewatch.sinks.published import publish_copies


@dataclass
class Outputs:
    """Where results go. Every part is optional.

    ``folders`` each get one CSV table per result; with ``together`` all copies of
    a table change at once, as versions that ``sinks.published`` finds. ``store`` is the cell table, in
    which every job has a folder of its own and appends ``batch`` to it, by
    default the one after the last. ``connect`` makes a client of a
    key-value store inside the tasks. ``preview`` is called with each result.
    """

    folders: Sequence[str] = ()
    store: str | None = None
    batch: int | None = None
    connect: Callable[[], object] | None = None
    preview: Callable[[DataFrame], None] | None = None
    together: bool = False


@dataclass
class Result:
    """A report, its name, and how it becomes a CSV table and cells."""

    name: str
    report: DataFrame
    to_table: Callable[[DataFrame], DataFrame]
    to_cells: Callable[[DataFrame], DataFrame]
    to_hashes: Callable[[DataFrame], DataFrame] | None = None  # unless the hash has a field per row


def run_daily(telemetry: DataFrame, outputs: Outputs, counts: Sequence[int] = (2, 3, 4)) -> None:
    """Daily vault failures. Rows without a day or vault have no hash key and go to CSV only."""

    def named(report: DataFrame) -> DataFrame:
        return hashes.daily_hashes(report.where(not_null(["data", "vault_id"])))

    _deliver(outputs, "daily", [_hashed("daily", daily_vault_failures(telemetry, counts), _unchanged, named)])


def run_rankings(telemetry: DataFrame, outputs: Outputs, k: int = 10) -> None:
    """Model and vault rankings."""

    def table(ranking: DataFrame) -> DataFrame:
        return ranking.withColumn("unique_models", joined_text("unique_models"))

    models = Result("models", top_models(telemetry, k), _unchanged, hashes.model_cells)
    _deliver(outputs, "rankings", [models, _hashed("vaults", rank_vaults(telemetry, k), table, hashes.vault_hashes)])


def run_hours(telemetry: DataFrame, outputs: Outputs, accuracy: int | None = None) -> None:
    """Power-on hours of failed and other drives, as one CSV file."""

    report = hours_by_cohort(telemetry, accuracy=accuracy)
    _deliver(outputs, "hours", [_hashed("hours", report, _unchanged, hashes.cohort_hashes)], single_file=True)


def _hashed(name: str, report: DataFrame, to_table, to_hashes) -> Result:
    return Result(name, report, to_table, lambda rows: hashes.to_cells(to_hashes(rows)), to_hashes)


def _unchanged(report: DataFrame) -> DataFrame:
    return report


def _deliver(outputs: Outputs, job: str, results: Sequence[Result], single_file: bool = False) -> None:
    """Compute every result once, then preview, write and store it."""
    for result in results:
        result.report.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for result in results:
            if outputs.preview:
                outputs.preview(result.report)
            if outputs.folders:
                targets = [f"{folder.rstrip('/')}/{result.name}" for folder in outputs.folders]
                table = result.to_table(result.report)
                if outputs.together:
                    publish_copies(table, targets, single_file)
                else:
                    write_csv(table, *targets, single_file=single_file)
        if outputs.store:
            cells = hashes.merge_panels(*[result.to_cells(result.report) for result in results])
            store = f"{outputs.store.rstrip('/')}/report={job}"
            hashes.append_batch(cells, store, outputs.batch)
            if outputs.batch is None:  # numbered batches may be run again, which folded ones can't
                hashes.fold(cells.sparkSession, store)
        if outputs.connect:
            for result in results:
                if result.to_hashes:
                    hashes.write_hashes(result.to_hashes(result.report), outputs.connect)
                else:
                    hashes.write_cells(result.to_cells(result.report), outputs.connect)
    finally:
        for result in results:
            result.report.unpersist()
