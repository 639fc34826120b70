"""Aggregates per group and rankings over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum per group. A NULL key is a group; NULL values are skipped."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name))


def count_by(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Count of non-NULL values per group."""
    return df.groupBy(*keys).agg(F.count(value).alias(name))


def distinct_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sorted distinct non-NULL values per group.

    The pairs are made distinct first. That step spreads a hot key over its
    values, so the list of a group is built from its distinct values only,
    however many rows the group has.
    """
    pairs = df.select(key, value).distinct()
    return pairs.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(name))


def top_k(df: DataFrame, k: int, measure: str, *tie_break: str) -> DataFrame:
    """The ``k`` rows with the largest measure; ties, also at the cut, follow ``tie_break``."""
    return df.orderBy(F.desc_nulls_last(measure), *tie_break).limit(k)
