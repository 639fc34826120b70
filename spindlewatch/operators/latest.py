"""Latest rows per key, and the ever-failed flag of a key's history.

A key may own a large share of all rows. Per-key facts therefore come from
aggregates, which combine before their shuffle, and reach the rows by an equi
join on (key, instant). Before any row is shuffled, each map task drops those
that are not the newest of their key in it. What is left of a key is dealt by
(key, scan partition modulo ``SPREAD``), so no window gathers a hot key with
many ties, and the join splits a hot (key, instant) pair at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# Groups that the rows of a key are dealt over while they are reduced to its newest.
SPREAD = 16

# Tasks that the rows of a hot key are dealt over, even where run-time splitting is off.
FLAG_SALTS = 16

# A key is hot if it owns more than this share of the rows, which no more than 400 keys can.
HOT_SHARE = 1 / 400
TRACKED = 16_384  # keys that a counting task keeps at a time


def latest_instants(df: DataFrame, key: str = "serial_number", instant: str = "data", name: str = "max_date") -> DataFrame:
    """The newest instant of every key, NULL where none is known."""
    return df.groupBy(key).agg(F.max(instant).alias(name))


def latest_rows(df: DataFrame, key: str = "serial_number", instant: str = "data") -> DataFrame:
    """Every row at the newest instant of its key: ties stay, a NULL key or instant drops."""
    return newest_with_facts(df, key, instant, {}).select(*df.columns)


def latest_rows_with_history(
    df: DataFrame, key: str = "serial_number", instant: str = "data", failure: str = "failure"
) -> DataFrame:
    """Latest rows whose failure is 1 if the key failed on any row, dated or not.

    One aggregate finds both the newest instant and the flag, so the rows are
    joined once.
    """
    facts = {"_ever_failed": F.bool_or(F.col(failure) == 1)}
    joined = newest_with_facts(df, key, instant, facts)
    return joined.withColumn(failure, _flagged(F.col("_ever_failed"), failure)).select(*df.columns)


def failed_keys(df: DataFrame, key: str = "serial_number", failure: str = "failure") -> DataFrame:
    """Distinct keys with a failure."""
    return df.where(F.col(failure) == 1).select(key).distinct()


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that own more than ``share`` of the rows: a list of bounded length, whatever the input.

    One pass over the key column, with a frequent-items sketch that combines
    before its shuffle. It misses no such key; a key a little below may be in the list.
    """
    most = int(1 / share)
    found = rows.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top"), F.count("*").alias("n")
    ).first()
    return [item["item"] for item in found["top"] or [] if item["count"] > share * found["n"]]


def flag_ever_failed(
    rows: DataFrame,
    history: DataFrame,
    key: str = "serial_number",
    failure: str = "failure",
    salts: int = FLAG_SALTS,
    hot: Sequence[object] | None = None,
) -> DataFrame:
    """Set failure to 1 on rows whose key failed in ``history``; other rows stay as they are.

    Failed keys that are hot in ``rows`` are copied once per salt, and a row of a
    hot key draws its salt from its own values, which splits them over ``salts``
    tasks. All other keys are there once. ``hot`` gives the hot keys where they
    are known; otherwise ``rows`` are counted first.
    """
    if hot is None:
        hot = hot_keys(rows, key)
    copies = salted_keys(failed_keys(history, key, failure), key, hot, salts)
    salt = F.when(F.col(key).isin(*hot), F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")).otherwise(0)
    matched = rows.withColumn("_salt", salt).join(
        copies, (F.col(key) == F.col("_failed")) & (F.col("_salt") == F.col("_copy")), "left_outer"
    )
    kept = F.when(F.col("_failed").isNull(), F.col(failure)).otherwise(1)
    return matched.withColumn(failure, kept).select(*rows.columns)


def salted_keys(keys: DataFrame, key: str, hot: Sequence[object], salts: int) -> DataFrame:
    """(_failed, _copy): a hot key once per salt, every other key once."""
    last = F.when(F.col(key).isin(*hot), salts - 1).otherwise(0)
    return keys.select(F.col(key).alias("_failed"), F.explode(F.sequence(F.lit(0), last)).alias("_copy"))


def newest_with_facts(df: DataFrame, key: str, instant: str, facts: dict[str, Column]) -> DataFrame:
    """Latest rows with aggregates over all rows of their key; the columns added for the join stay."""
    per_key = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.max(instant).alias("_newest"), *[value.alias(name) for name, value in facts.items()])
    )
    # Sorted merge: it spills, and run-time skew handling can split its row side.
    known = per_key.where(F.col("_newest").isNotNull()).hint("merge")
    # The partition number is not deterministic, which keeps the NULL test of the
    # instant above the projection that parses it: no instant is parsed twice.
    dealt = df.where(F.col(key).isNotNull()).withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    newest_first = Window.partitionBy(key, "_part").orderBy(F.desc(instant))
    candidates = (
        dealt.where(F.col(instant).isNotNull()).withColumn("_rank", F.rank().over(newest_first)).where(F.col("_rank") == 1)
    )
    return candidates.join(known, (F.col(key) == F.col("_key")) & (F.col(instant) == F.col("_newest")))


def _flagged(ever_failed: Column, failure: str) -> Column:
    return F.when(ever_failed, F.lit(1)).otherwise(F.col(failure))
