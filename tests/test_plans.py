"""What the plans must keep doing: push filters, read few columns, shuffle once, split hot keys."""

from __future__ import annotations

import contextlib
import re

import pytest
from samples import values
from pyspark.sql import functions as F

from spindlewatch import sources
from spindlewatch.functions import parse_instant
from spindlewatch.operators import distribution_stats, failed_keys, flag_ever_failed, hot_keys, latest_rows_with_history
from spindlewatch.operators.latest import salted_keys
from spindlewatch.plans import daily_vault_failures, hours_by_cohort, rank_vaults, top_models
from spindlewatch.plans.registry import QUERIES

ROWS = 120_000


@contextlib.contextmanager
def configured(spark, **settings):
    names = {name.replace("__", "."): value for name, value in settings.items()}
    before = {name: spark.conf.get(name) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def plan(df):
    """The physical plan before execution, one scan detail per line."""
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan that ran."""
    df._jdf.collectToPython()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Telemetry where one drive, in one vault and of one model, owns a third of all rows."""
    hot = F.col("id") % 3 == 0
    rows = spark.range(ROWS, numPartitions=8).select(
        F.when(hot, "2023-04-20T00:00:00.000000")
        .otherwise(F.format_string("2023-04-%02dT00:00:00.000000", F.col("id") % 20 + 1))
        .alias("data"),
        F.when(hot, "HOT").otherwise((F.col("id") / 40).cast("int").cast("string")).alias("serial_number"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("M"), F.col("id") % 50)).alias("model"),
        F.when(hot, 1).otherwise((F.col("id") % 400).cast("int")).alias("vault_id"),
        F.when(F.col("id") % 97 == 0, 1).otherwise(0).alias("failure"),
        (F.col("id") * 7919 % ROWS).cast("double").alias("s9_power_on_hours"),
    )
    path = str(tmp_path_factory.mktemp("hot") / "telemetry")
    rows.write.parquet(path)
    return path


@pytest.fixture
def hot(spark, stored):
    return sources.read_parquet(spark, stored)


def test_daily_report_pushes_the_failures_to_a_three_column_scan(hot):
    text = plan(daily_vault_failures(hot))
    assert "Not(EqualTo(failure,0))" in text
    assert "ReadSchema: struct<data:string,vault_id:int,failure:int>" in text


def test_daily_report_reads_all_rows_if_zero_is_wanted(hot):
    assert "Not(EqualTo(failure,0))" not in plan(daily_vault_failures(hot, counts=(0, 1)))


def test_union_members_are_pruned_in_the_scan(spark, hot, tmp_path):
    other = F.lit(None).cast("string").alias("member1")
    wrapped = hot.select(
        "data",
        F.struct(F.col("vault_id").alias("member0"), other).alias("vault_id"),
        F.struct(F.col("failure").alias("member0"), other).alias("failure"),
    )
    wrapped.write.parquet(str(tmp_path / "unions"))
    text = plan(daily_vault_failures(sources.read_parquet(spark, str(tmp_path / "unions"))))
    assert "vault_id:struct<member0:int>" in text and "failure:struct<member0:int>" in text
    assert "Not(EqualTo(failure.member0,0))" in text


def test_rankings_take_the_top_rows_without_a_global_sort(hot):
    for report in (top_models(hot), rank_vaults(hot)):
        text = plan(report)
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_vault_ranking_counts_once(hot):
    report = rank_vaults(hot)
    text = final_plan(report)
    assert "EqualTo(failure,1)" in text
    assert "ReusedExchange" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_hours_report_shares_its_histogram(hot):
    text = final_plan(hours_by_cohort(hot))
    assert "ReusedExchange" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "ReadSchema: struct<data:string,serial_number:string,failure:int,s9_power_on_hours:double>" in text


SPLIT = {
    "spark__sql__shuffle__partitions": "64",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "64k",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "32k",
}


def test_a_hot_drive_is_split_in_the_latest_rows(spark, hot):
    # Reduced rows arrive sorted and small, so the hot pair needs more of them to count as large.
    many = hot.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(8))))
    many = many.withColumn("s9_power_on_hours", F.col("s9_power_on_hours") * F.col("_copy")).drop("_copy")
    typed = many.withColumn("data", parse_instant("data"))
    with configured(spark, **SPLIT):
        latest = latest_rows_with_history(typed).groupBy("failure").agg(F.sum("s9_power_on_hours").alias("hours"))
        text = final_plan(latest)
    assert "SortMergeJoin(skew=true)" in text
    windows = re.findall(r"windowspecdefinition\(([^)]*)", text)
    assert windows and all(re.match(r"serial_number#\d+, _part#\d+,", window) for window in windows)


def test_rows_are_reduced_before_their_shuffle(hot):
    typed = hot.withColumn("data", parse_instant("data"))
    steps = plan(latest_rows_with_history(typed))
    assert re.search(r"WindowGroupLimit.*Final", steps) and re.search(r"WindowGroupLimit.*Partial", steps)
    assert re.search(r"hashpartitioning\(serial_number#\d+, _part#\d+", steps)


def test_a_hot_drive_gives_all_its_rows(spark, hot):
    typed = hot.withColumn("data", parse_instant("data"))
    with configured(spark, **SPLIT):
        found = latest_rows_with_history(typed).where("serial_number = 'HOT'")
        assert values(found.groupBy("failure").count()) == [(1, ROWS // 3)]


def test_salts_spread_a_hot_drive(spark, hot):
    flagged = flag_ever_failed(hot, hot)
    with configured(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert re.search(r"hashpartitioning\(serial_number#\d+, _salt#\d+", plan(flagged))
        assert flagged.count() == ROWS
        assert flagged.where("serial_number = 'HOT'").select("failure").distinct().collect()[0][0] == 1


def test_only_hot_keys_are_copied(spark, hot):
    assert hot_keys(hot, "serial_number") == ["HOT"]
    assert hot_keys(hot.where("serial_number <> 'HOT'"), "serial_number", 1 / 100) == []
    assert hot_keys(hot.where("FALSE"), "serial_number") == []
    failed = failed_keys(hot)
    copies = salted_keys(failed, "serial_number", ["HOT"], 16)
    assert copies.count() == failed.count() + 15
    assert copies.where("_copy > 0").select("_failed").distinct().collect()[0][0] == "HOT"


def test_no_more_keys_are_hot_than_the_share_allows(spark):
    keys = spark.range(20_000).selectExpr("cast(id % 50 as string) as k")
    assert len(hot_keys(keys, "k", 1 / 60)) == 50
    assert hot_keys(keys, "k", 1 / 40) == []


def test_a_hot_drive_is_dealt_with_splitting_off(spark, hot):
    """By the salts alone: without them one task would have a third of all rows."""
    settings = {
        "spark__sql__adaptive__enabled": "false",
        "spark__sql__shuffle__partitions": "32",
        "spark__sql__autoBroadcastJoinThreshold": "-1",
    }
    with configured(spark, **settings):
        flagged = flag_ever_failed(hot, hot)
        tasks = values(flagged.groupBy(F.spark_partition_id()).count())
        plain = values(flag_ever_failed(hot, hot, hot=[]).groupBy(F.spark_partition_id()).count())
        assert sum(n for _, n in tasks) == ROWS
        assert max(n for _, n in plain) > ROWS / 3 > 2 * max(n for _, n in tasks)
        assert sorted(values(flagged)) == sorted(values(flag_ever_failed(hot, hot, hot=[])))


def test_ranks_of_many_groups_are_joined_by_group_and_bucket(spark, hot):
    with configured(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(distribution_stats(hot, "s9_power_on_hours", "serial_number"))
    joins = [line for line in text.splitlines() if "Join" in line]
    assert joins and all("_bucket" in line and "_at" in line for line in joins)


def test_hours_report_on_a_hot_drive_equals_brute_force(spark, hot):
    rows = values(hot.select("data", "serial_number", "failure", "s9_power_on_hours"))
    newest: dict[str, str] = {}
    failed = set()
    for data, serial, failure, _ in rows:
        newest[serial] = max(newest.get(serial, ""), data)
        if failure == 1:
            failed.add(serial)
    wanted = []
    for cohort in (1, 0):
        hours = sorted(h for d, s, _, h in rows if d == newest[s] and (s in failed) == (cohort == 1))
        picked = [hours[-(-len(hours) * q // 4) - 1] for q in (1, 2, 3)]
        wanted.append((hours[0], *picked, hours[-1], len(hours), cohort))
    with configured(spark, spark__sql__adaptive__coalescePartitions__enabled="false", **SPLIT):
        assert values(hours_by_cohort(hot)) == wanted


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_uses_a_cross_join(spark, tables, name):
    text = plan(QUERIES[name](spark, tables))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
