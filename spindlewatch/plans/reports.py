"""The three analyses as four report tables.

Input is typed telemetry; its ``data`` column may hold text or, as in extracts, instants.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.functions import day_of, format_day, instant_of, joined_text
from spindlewatch.operators import QUARTILES, distribution_stats, latest_rows_with_history, sum_by, top_k
from spindlewatch.schema import REPORT_DAY_PATTERN

# Largest k whose k vault ids are broadcast.
BROADCAST_ROWS = 10_000

# Failed drives first.
COHORTS = (1, 0)


def daily_vault_failures(
    telemetry: DataFrame, counts: Sequence[int] = (2, 3, 4), day_pattern: str = REPORT_DAY_PATTERN
) -> DataFrame:
    """Vaults with one of the wanted failure counts on a day, by day and vault."""
    rows = telemetry
    if 0 not in counts:
        # Zeros and NULLs change no sum, and a group of nothing else cannot have
        # a wanted count. The scan skips them, which is nearly all telemetry.
        rows = rows.where(F.col("failure") != 0)
    daily = rows.select(day_of(rows), "vault_id", "failure")
    totals = sum_by(daily, ["data", "vault_id"], "failure", "failures_count")
    wanted = totals.where(F.col("failures_count").isin(*counts)).orderBy("data", "vault_id")
    return wanted.withColumn("data", format_day("data", day_pattern))


def top_models(telemetry: DataFrame, k: int = 10) -> DataFrame:
    """Models with the most failures. Models without failures rank too."""
    return top_k(sum_by(telemetry, ["model"], "failure", "total_failures"), k, "total_failures", "model")


def rank_vaults(telemetry: DataFrame, k: int = 10) -> DataFrame:
    """Vaults with the most failed rows, and the sorted list of models that failed in them.

    Failures are counted per (vault, model) once. Vault totals and model lists
    both build on these counts, and only the k leaders get a list.
    """
    failed = telemetry.where((F.col("failure") == 1) & F.col("vault_id").isNotNull())
    per_model = failed.groupBy("vault_id", "model").agg(F.count("failure").alias("_n"))
    totals = sum_by(per_model, ["vault_id"], "_n", "total_failures")
    leaders = top_k(totals, k, "total_failures", "vault_id").select("vault_id")
    if k <= BROADCAST_ROWS:
        leaders = F.broadcast(leaders)
    # The second sum equals the total. Asking for it keeps both uses of the
    # counts identical, so that they are computed and shuffled once.
    named = (
        per_model.join(leaders, "vault_id")
        .groupBy("vault_id")
        .agg(
            F.sum("_n").alias("total_failures"),
            F.array_sort(F.collect_list("model")).alias("unique_models"),
        )
    )
    return top_k(named, k, "total_failures", "vault_id")


def top_vaults(telemetry: DataFrame, k: int = 10, separator: str = ",") -> DataFrame:
    """The vault ranking with each model list as one text."""
    return rank_vaults(telemetry, k).withColumn("unique_models", joined_text("unique_models", separator))


def hours_by_cohort(
    telemetry: DataFrame,
    measure: str = "s9_power_on_hours",
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int | None = None,
) -> DataFrame:
    """Distribution of the latest power-on hours: drives that ever failed, then the others.

    Exact unless ``accuracy`` asks for the sketch.
    """
    rows = telemetry.select(instant_of(telemetry), "serial_number", "failure", measure)
    latest = latest_rows_with_history(rows)
    stats = distribution_stats(latest, measure, "failure", COHORTS, probabilities, accuracy)
    return stats.orderBy(F.desc("failure")).limit(len(COHORTS))
