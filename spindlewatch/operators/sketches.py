"""Percentiles from sketches that are kept, merged and added up day by day.

A sketch is a binary column with a bounded size (Spark's KLL functions). No task
takes all partial sketches of a group: each map task puts its partial of a group
into one of ``PARTS`` parts, a part is merged by one task, and only the merged
parts of a group meet. Sketches of days, stored once, add up the same way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

QUARTILES = (0.25, 0.50, 0.75)
PARTS = 64
LARGEST = 65_535  # fixed value: largest size parameter of the sketch
# The published rank error of the sketch is 2.296 / size ** 0.9021, at 99 % confidence.
ERROR_SCALE, ERROR_POWER = 2.296, 0.9021


def percentile_name(probability: float) -> str:
    return f"{probability * 100:g}th_percentile"


def sketch_size(accuracy: int) -> int:
    """Size parameter for a rank error of rows / accuracy. The largest size gives an accuracy of about 9,600."""
    if accuracy < 1:
        raise ValueError("accuracy has to be positive")
    return min(LARGEST, max(8, int((ERROR_SCALE * accuracy) ** (1 / ERROR_POWER)) + 1))


def rank_error(size: int) -> float:
    """Share of the rows by which a rank may be off, at 99 % confidence."""
    return ERROR_SCALE / size**ERROR_POWER


def sketches(df: DataFrame, column: str, by: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """One row per group: ``by``, ``sketch``, ``min``, ``max``, ``count``. NULL values are not counted.

    A sketch has no place for NaN, which is the largest value; it is kept as
    infinity there. A group without values has no row.
    """
    values = df.where(F.col(column).isNotNull())
    number = F.col(column).cast("double")
    # All rows of a map task and group go to one part, so a map task makes one partial sketch of a group.
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    built = F.kll_sketch_agg_double(F.when(F.isnan(number), float("inf")).otherwise(number), F.lit(sketch_size(accuracy)))
    partial = values.groupBy(*by, part.alias("_part")).agg(
        built.alias("sketch"), F.min(column).alias("min"), F.max(column).alias("max"), F.count("*").alias("count")
    )
    return _merged(partial, by)


def combined(stored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of finer groups, such as days, added up to one row per group of ``by``."""
    part = F.pmod(F.xxhash64(*[name for name in stored.columns if name not in ("sketch", *by)]), F.lit(PARTS))
    return _merged(_merged(stored.withColumn("_part", part), [*by, "_part"]), by)


def sketched_stats(stored: DataFrame, by: Sequence[str], probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """Columns ``min``, one per probability, ``max``, ``count`` and ``by``.

    A percentile is the smallest value that at least the given share of the rows
    does not exceed, up to the sketch's rank error. Groups of no more values than
    the sketch's size are exact.
    """
    picked = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(percentile_name(p)) for p in probabilities]
    return stored.select("min", *picked, "max", "count", *by)


def measured_rank_errors(
    stats: DataFrame, rows: DataFrame, column: str, by: str, probabilities: Sequence[float] = QUARTILES
) -> DataFrame:
    """``stats`` with a column ``<percentile>_rank_error`` each: how far, as a share of the rows, the wanted rank lies off.

    0 where the value is exact. The rows are counted against the values once,
    without sorting; ``stats`` has one row per group.
    """
    counted: list[Column] = []
    for i, p in enumerate(probabilities):
        name = percentile_name(p)
        counted.append(F.count(F.when(F.col("_value") < F.col(name), 1)).alias(f"_below{i}"))
        counted.append(F.count(F.when(F.col("_value") <= F.col(name), 1)).alias(f"_upto{i}"))
    values = rows.select(F.col(by).alias("_by"), F.col(column).alias("_value"))
    # The statistics are used once: a sketch that is merged again may give other values.
    ranks = values.join(stats, F.col("_by").eqNullSafe(F.col(by))).groupBy(*stats.columns).agg(*counted)
    errors = []
    for i, p in enumerate(probabilities):
        wanted = F.greatest(F.lit(1), F.ceil(F.lit(p) * F.col("count")))
        off = F.greatest(F.lit(0), F.col(f"_below{i}") + 1 - wanted, wanted - F.col(f"_upto{i}"))
        errors.append((off / F.col("count")).alias(f"{percentile_name(p)}_rank_error"))
    return ranks.select(*stats.columns, *errors)


def _merged(partial: DataFrame, by: Sequence[str]) -> DataFrame:
    return partial.groupBy(*by).agg(
        F.kll_merge_agg_double("sketch").alias("sketch"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.sum("count").alias("count"),
    )
