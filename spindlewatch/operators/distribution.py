"""Minimum, percentiles, maximum and count of a numeric column, overall or per group."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from spindlewatch.operators.sketches import QUARTILES, percentile_name, sketched_stats, sketches
from spindlewatch.storage import kept

# Types whose values a sketch holds as they are.
SKETCHED = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)

# Largest number of (group, probability) rows that is broadcast.
BROADCAST_ROWS = 10_000


def distribution_stats(
    df: DataFrame,
    column: str,
    by: str | None = None,
    groups: Sequence[object] | None = None,
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int | None = None,
) -> DataFrame:
    """Columns ``min``, one per probability, ``max``, ``count`` and, if given, ``by``.

    NULLs are not counted. ``groups`` limits the result to these values of ``by``
    and adds a row of NULLs with count 0 for each one without rows; without
    ``by`` there is always exactly one row.

    With ``accuracy`` the percentiles come from a sketch, whose rank error is about
    rows/accuracy (see ``sketches``) and none for small groups. Without it they are exact: the smallest value that
    at least the given share of the rows does not exceed.
    """
    if accuracy:
        stats = _sketch_stats
    else:
        stats = _exact_stats_of_many if by is not None and groups is None else _exact_stats
    if by is None:
        # Always 0, but computed: the optimizer folds a constant out of the join
        # on it, which leaves a join without an equality.
        only = F.pmod(F.hash(column), F.lit(1))
        rows = df.select(only.alias("_group"), F.col(column).alias("_value"))
        return stats(rows, [0], probabilities, accuracy).drop("_group")
    rows = df.select(F.col(by).alias("_group"), F.col(column).alias("_value"))
    if groups is not None:
        rows = rows.where(F.col("_group").isin(*groups))
    return stats(rows, groups, probabilities, accuracy).withColumnRenamed("_group", by)


def global_stats(df: DataFrame, column: str) -> DataFrame:
    """Minimum, maximum and count of non-NULL values; one row even without input."""
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"), F.count(column).alias("count"))


def _sketch_stats(
    rows: DataFrame, groups: Sequence[object] | None, probabilities: Sequence[float], accuracy: int
) -> DataFrame:
    """Sketches merged in levels for floating point and small integers; Spark's own function for other types."""
    if not isinstance(rows.schema["_value"].dataType, SKETCHED):
        return _approximated_stats(rows, groups, probabilities, accuracy)
    stats = sketched_stats(sketches(rows, "_value", ["_group"], accuracy), ["_group"], probabilities)
    if groups is not None:
        counted = F.coalesce("count", F.lit(0)).cast("bigint")
        stats = _empty_groups(rows, groups).join(stats, "_group", "left").withColumn("count", counted)
    own_type = rows.schema["_value"].dataType
    return _ordered(stats, [F.col(percentile_name(p)).cast(own_type) for p in probabilities], probabilities)


def _approximated_stats(
    rows: DataFrame, groups: Sequence[object] | None, probabilities: Sequence[float], accuracy: int
) -> DataFrame:
    if groups is not None:
        rows = rows.unionByName(_empty_groups(rows, groups).withColumn("_value", _null_of(rows, "_value")))
    picked = F.percentile_approx("_value", list(probabilities), accuracy)
    stats = rows.groupBy("_group").agg(
        F.min("_value").alias("min"), picked.alias("_picked"), F.max("_value").alias("max"), F.count("_value").alias("count")
    )
    return _ordered(stats, [F.col("_picked")[i] for i in range(len(probabilities))], probabilities)


def _exact_stats(
    rows: DataFrame, groups: Sequence[object] | None, probabilities: Sequence[float], _accuracy: None
) -> DataFrame:
    """Order statistics without gathering a group.

    Rows become a histogram (combined before its shuffle, so repeated values
    cannot make a hot partition) which is range partitioned by value. Every
    partition is one bucket, and a running total over the buckets tells in which
    one each wanted rank lies. Only the distinct values of that bucket are then
    ranked one by one. The number of partitions is given, so that they are not
    merged at run time and buckets stay small.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    histogram = rows.where(F.col("_value").isNotNull()).groupBy("_group", "_value").agg(F.count("*").alias("_n"))
    ranged = histogram.repartitionByRange(partitions, "_group", "_value")
    buckets = ranged.groupBy(F.spark_partition_id().alias("_bucket"), "_group").agg(
        F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_n").alias("_n")
    )

    wanted = _located(buckets, probabilities).drop("_bucket")
    if groups is not None and len(groups) * len(probabilities) <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    inside = F.col("_group").eqNullSafe(F.col("_in")) & F.col("_value").between(F.col("_low"), F.col("_high"))
    running = Window.partitionBy("_group", "_which").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        ranged.join(wanted, inside)
        .withColumn("_seen", F.col("_before") + F.sum("_n").over(running))
        .where(F.col("_seen") >= F.col("_rank"))
        .select("_group", "_which", "_value", "_min", "_max", "_total")
    )
    if groups is not None:
        reached = reached.unionByName(_empty_groups(rows, groups), allowMissingColumns=True)
    return _stats_of(reached, probabilities)


def _exact_stats_of_many(
    rows: DataFrame, _groups: None, probabilities: Sequence[float], _accuracy: None
) -> DataFrame:
    """Order statistics of any number of groups, some of which may be hot.

    As above, but the histogram is stored with the number of its range partition,
    its bucket. A wanted rank is found in two levels: the bucket, from the running
    totals of each group over its buckets, and then the value, among the values
    of that group and bucket. Both are reached by equality, so a group that lies
    in many buckets is never gathered, and buckets hold bounded shares of all values.
    """
    histogram = rows.where(F.col("_value").isNotNull()).groupBy("_group", "_value").agg(F.count("*").alias("_n"))
    ranged = kept(
        histogram.repartitionByRange("_group", "_value").withColumn("_bucket", F.spark_partition_id()), "histogram"
    )
    buckets = ranged.groupBy("_bucket", "_group").agg(
        F.min("_value").alias("_low"), F.max("_value").alias("_high"), F.sum("_n").alias("_n")
    )
    wanted = _located(buckets, probabilities).withColumnRenamed("_bucket", "_at")
    running = Window.partitionBy("_group", "_bucket", "_which").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    reached = (
        ranged.join(wanted, F.col("_group").eqNullSafe(F.col("_in")) & (F.col("_bucket") == F.col("_at")))
        .withColumn("_seen", F.col("_before") + F.sum("_n").over(running))
        .where(F.col("_seen") >= F.col("_rank"))
        .select("_group", "_which", "_value", "_min", "_max", "_total")
    )
    return _stats_of(reached, probabilities)


def _located(buckets: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """The bucket of each wanted rank: ``_in`` (the group), ``_bucket``, ``_low``, ``_high``, ``_which``, ``_rank``, and totals."""
    whole = Window.partitionBy("_group")
    upto = whole.orderBy("_low").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    located = buckets.select(
        F.col("_group").alias("_in"),
        "_bucket",
        "_low",
        "_high",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
        F.sum("_n").over(upto).alias("_through"),
        F.min("_low").over(whole).alias("_min"),
        F.max("_high").over(whole).alias("_max"),
        F.sum("_n").over(whole).alias("_total"),
    )
    # Decimal, as 0.1 * 30 in floating point lies above 3.
    shares = [F.ceil(F.lit(Decimal(str(p))) * F.col("_total")).cast("bigint") for p in probabilities]
    ranks = F.array(*[F.greatest(F.lit(1).cast("bigint"), share) for share in shares])
    return located.select("*", F.posexplode(ranks).alias("_which", "_rank")).where(
        (F.col("_before") < F.col("_rank")) & (F.col("_rank") <= F.col("_through"))
    )


def _stats_of(reached: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """One row per group from the values at or behind each wanted rank."""
    stats = reached.groupBy("_group").agg(
        F.max("_min").alias("min"),
        *[F.min(F.when(F.col("_which") == i, F.col("_value"))).alias(f"_p{i}") for i in range(len(probabilities))],
        F.max("_max").alias("max"),
        F.coalesce(F.max("_total"), F.lit(0)).cast("bigint").alias("count"),
    )
    return _ordered(stats, [F.col(f"_p{i}") for i in range(len(probabilities))], probabilities)


def _ordered(stats: DataFrame, picked: Sequence[Column], probabilities: Sequence[float]) -> DataFrame:
    named = [value.alias(percentile_name(p)) for value, p in zip(picked, probabilities)]
    return stats.select("min", *named, "max", "count", "_group")


def _empty_groups(rows: DataFrame, groups: Sequence[object]) -> DataFrame:
    """One row per wanted group, so that a group without rows is still reported."""
    group_type = rows.schema["_group"].dataType
    labels = F.array(*[F.lit(g).cast(group_type) for g in groups])
    return rows.sparkSession.range(1).select(F.explode(labels).alias("_group"))


def _null_of(rows: DataFrame, name: str) -> Column:
    return F.lit(None).cast(rows.schema[name].dataType)
