"""Sketches that are merged in levels and added up by day."""

from __future__ import annotations

import math
import random

import pytest
from samples import values
from test_distribution import brute

from spindlewatch.operators import QUARTILES, combined, distribution_stats, measured_rank_errors, sketched_stats, sketches
from spindlewatch.operators.sketches import LARGEST, rank_error, sketch_size


def daily(spark, n, slices=8, seed=3):
    pick = random.Random(seed)
    rows = [(i % 13, i % 3, pick.gauss(0, 100)) for i in range(n)]
    return rows, spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), "d int, g int, v double")


def by_group(df):
    return {row["g"]: row for row in df.collect()}


def test_days_add_up_to_the_whole(spark):
    rows, df = daily(spark, 6_000)
    whole = sketched_stats(combined(sketches(df, "v", ["d", "g"]), ["g"]), ["g"])
    assert whole.columns == ["min", "25th_percentile", "50th_percentile", "75th_percentile", "max", "count", "g"]
    for group, row in by_group(whole).items():
        assert tuple(row)[:-1] == brute([v for _, g, v in rows if g == group])


def test_a_day_can_be_taken_back(spark):
    rows, df = daily(spark, 3_000)
    kept = sketches(df, "v", ["d", "g"]).where("d <> 4")
    for group, row in by_group(sketched_stats(combined(kept, ["g"]), ["g"])).items():
        assert tuple(row)[:-1] == brute([v for d, g, v in rows if g == group and d != 4])


@pytest.mark.parametrize("accuracy", [50, 1_000, 10_000])
def test_ranks_stay_near_at_any_accuracy(spark, accuracy):
    """Twice the published error, as that holds for 99 of 100 sketches; the measured error against sorted ranks."""
    rows, df = daily(spark, 90_000)
    stats = sketched_stats(combined(sketches(df, "v", ["d", "g"], accuracy), ["g"]), ["g"])
    for group, row in by_group(measured_rank_errors(stats, df, "v", "g")).items():
        ordered = sorted(v for _, g, v in rows if g == group)
        for p in QUARTILES:
            name = f"{p * 100:g}th_percentile"
            off = abs(ordered.index(row[name]) + 1 - math.ceil(p * len(ordered))) / len(ordered)
            assert row[f"{name}_rank_error"] == pytest.approx(off)
            assert off <= 2 * rank_error(sketch_size(accuracy))


def test_sizes():
    assert sketch_size(1) == 8 and sketch_size(10**9) == LARGEST
    assert rank_error(sketch_size(1_000)) <= 1 / 1_000
    assert rank_error(sketch_size(10_000)) < 1.04e-4
    with pytest.raises(ValueError):
        sketch_size(0)


def test_partial_sketches_meet_in_levels(spark):
    _, df = daily(spark, 100)
    plan = sketches(df, "v", ["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") >= 2 and "partial_kll_merge_agg_double" in plan
    plan = distribution_stats(df, "v", "g", (0, 1), accuracy=100)._jdf.queryExecution().executedPlan().toString()
    assert "kll_merge_agg_double" in plan and "percentile_approx" not in plan


def test_odd_values(spark):
    rows = [(0, 1, None), (0, 1, 2.0), (0, 1, float("nan")), (0, 1, float("-inf")), (1, 2, None)]
    df = spark.createDataFrame(rows, "d int, g int, v double")
    (row,) = distribution_stats(df, "v", "g", probabilities=(0.3, 0.5, 0.9), accuracy=100).collect()
    assert (row[0], row[1], row[2], row[3], row["count"]) == (float("-inf"), float("-inf"), 2.0, float("inf"), 3)
    assert math.isnan(row["max"])
    assert values(sketches(df.where("FALSE"), "v", ["g"])) == []
    assert values(combined(sketches(df.where("FALSE"), "v", ["d", "g"]), ["g"])) == []


@pytest.mark.parametrize("kind", ["int", "float", "bigint", "decimal(9,2)"])
def test_other_types_keep_their_type(spark, kind):
    df = spark.range(1, 101).selectExpr(f"cast(id as {kind}) as v")
    stats = distribution_stats(df, "v", accuracy=1_000)
    assert {t for _, t in stats.drop("count").dtypes} == {kind}
    assert [float(x) for x in stats.first()] == [1, 25, 50, 75, 100, 100]
