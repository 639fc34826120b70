"""Keyed hashes: ``key -> {field: text}``, for dashboards and key-value stores.

Two forms are used. A *hash table* has one row per hash, ``key`` and a map
``fields``. *Cells* have one row per field, ``key, field, value``; they also fit
hashes with very many fields and are the stored form.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewatch.functions import joined_text, key_text
from spindlewatch.sinks.sending import send_cells
from spindlewatch.sinks.store import append_batch, current_cells, fold, read_store, vacuum  # noqa: F401  the stored form

# Keys and field names the dashboard reads.
DAILY_PREFIX = "query1"
MODELS_KEY = "query2"
VAULTS_PREFIX = "query2.2"
COHORT_KEYS = {1: "failureStats", 0: "nofailureStats"}
COHORT_LABEL = "# failure"
DAILY_FIELDS = ("date", "vaultId", "failuresCount")
VAULT_FIELDS = ("vaultId", "totalFailures", "uniqueModels")
COHORT_FIELDS = (COHORT_LABEL, "min", "25th_percentile", "50th_percentile", "75th_percentile", "max", "count")


def hash_rows(df: DataFrame, key: Column, fields: Mapping[str, str | Column]) -> DataFrame:
    """One hash per row, values as text."""
    entries: list[Column] = []
    for name, value in fields.items():
        entries += [F.lit(name), (F.col(value) if isinstance(value, str) else value).cast("string")]
    return df.select(key.alias("key"), F.create_map(*entries).alias("fields"))


def daily_hashes(report: DataFrame) -> DataFrame:
    """One hash per day and vault."""
    fields = dict(zip(DAILY_FIELDS, ("data", "vault_id", "failures_count")))
    return hash_rows(report, key_text(DAILY_PREFIX, "data", "vault_id"), fields)


def vault_hashes(ranking: DataFrame) -> DataFrame:
    """One hash per ranked vault; its models are listed with a comma and a blank."""
    fields = dict(zip(VAULT_FIELDS, ("vault_id", "total_failures", joined_text("unique_models", ", "))))
    return hash_rows(ranking, key_text(VAULTS_PREFIX, "vault_id"), fields)


def cohort_hashes(report: DataFrame) -> DataFrame:
    """One hash per cohort under its fixed key.

    A field without a value is set to an empty text, so that nothing of an
    earlier run stays beside the new count.
    """
    key = F.when(F.col("failure") == 1, COHORT_KEYS[1]).otherwise(COHORT_KEYS[0])
    named = {name: F.col("failure" if name == COHORT_LABEL else name).cast("string") for name in COHORT_FIELDS}
    fields = {name: F.coalesce(value, F.lit("")) for name, value in named.items()}
    return hash_rows(report, key, fields)


def single_hash(df: DataFrame, key: str, field: str, count: str) -> DataFrame:
    """Cells of one hash: a field per row, counts as whole numbers."""
    return df.select(
        F.lit(key).alias("key"),
        F.col(field).cast("string").alias("field"),
        F.col(count).cast("bigint").cast("string").alias("value"),
    ).where(F.col("field").isNotNull() & F.col("value").isNotNull())


def model_cells(report: DataFrame) -> DataFrame:
    """The whole model ranking in one hash."""
    return single_hash(report, MODELS_KEY, "model", "total_failures")


def to_cells(hashes: DataFrame) -> DataFrame:
    """Hash table to cells. A field without a value is not stored."""
    return hashes.select("key", F.explode("fields").alias("field", "value")).where(F.col("value").isNotNull())


def upsert_cells(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored cells with the new ones set on top."""
    both = stored.select("key", "field", "value", F.lit(0).alias("batch")).unionByName(
        new.select("key", "field", "value", F.lit(1).alias("batch"))
    )
    return current_cells(both)


def matching(pattern: str) -> Column:
    """Condition on ``key``: an exact key, or every key with a prefix if the pattern ends in ``*``."""
    prefix = pattern.removesuffix("*")
    if set(prefix) & set("*?[]\\"):
        raise ValueError(f"only a trailing * is supported: {pattern}")
    return F.col("key").startswith(prefix) if prefix != pattern else F.col("key") == pattern


def scan_keys(cells: DataFrame, pattern: str) -> DataFrame:
    """Distinct keys that match the pattern."""
    return cells.where(matching(pattern)).select("key").distinct()


def get_all(cells: DataFrame, pattern: str, fields: Sequence[str]) -> DataFrame:
    """The hashes that match the pattern as a table: key, then the fields in the given order."""
    named = [F.max(F.when(F.col("field") == name, F.col("value"))).alias(name) for name in fields]
    return cells.where(matching(pattern)).groupBy("key").agg(*named)


def get_fields(cells: DataFrame, key: str) -> DataFrame:
    """All fields of one hash as rows, for hashes whose field names are data."""
    return cells.where(F.col("key") == key).select("field", "value")


def merge_panels(*panels: DataFrame) -> DataFrame:
    """Several reads as one table; a column one of them lacks is NULL."""
    merged = panels[0]
    for panel in panels[1:]:
        merged = merged.unionByName(panel, allowMissingColumns=True)
    return merged


def write_hashes(hashes: DataFrame, connect: Callable[[], object], marker: str | None = None) -> None:
    """Set every hash of a hash table in a key-value store, from the tasks, in bounded batches.

    Setting a field twice is harmless, so a retried task is. See ``sending.send_cells``.
    """
    write_cells(to_cells(hashes), connect, marker)


def write_cells(cells: DataFrame, connect: Callable[[], object], marker: str | None = None) -> None:
    """``write_hashes`` for cells. A hash is sent in as many batches as it needs, so none is gathered."""
    send_cells(cells, connect, marker=marker)
