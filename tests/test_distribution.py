"""Percentiles against brute force."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from samples import values

from spindlewatch.operators import QUARTILES, distribution_stats, global_stats


@pytest.fixture(params=["one bucket", "many buckets"])
def buckets(request, spark):
    """Runs a test with merged and with separate range partitions."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(request.param == "one bucket").lower())
    yield
    spark.conf.set(name, before)


def brute(numbers, probabilities=QUARTILES):
    known = sorted(n for n in numbers if n is not None)
    if not known:
        return (None,) * (len(probabilities) + 2) + (0,)
    picked = [known[max(1, math.ceil(Fraction(str(p)) * len(known))) - 1] for p in probabilities]
    return (known[0], *picked, known[-1], len(known))


def frame(spark, rows, slices=8):
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), "g int, v double")


def samples():
    pick = random.Random(7)
    yield "distinct", [(pick.choice([0, 1]), float(n)) for n in pick.sample(range(100_000), 5_000)]
    yield "one value", [(0, 3.5)] * 3_000 + [(1, -1.0)]
    yield "a third equal", [(n % 2, 0.0 if n % 3 == 0 else pick.uniform(-9, 9)) for n in range(4_000)]
    yield "wide range", [(1, pick.choice([-1, 1]) * 10.0 ** pick.randint(-300, 300)) for _ in range(2_000)]
    yield "with nulls", [(n % 2, None if n % 5 else float(n % 17)) for n in range(1_000)]
    yield "single row", [(0, 2.0)]


@pytest.mark.parametrize("name, rows", list(samples()), ids=lambda x: x if isinstance(x, str) else "")
def test_exact_percentiles(spark, buckets, name, rows):
    df = frame(spark, rows)
    assert values(distribution_stats(df, "v")) == [brute([v for _, v in rows])]
    by_group = {row[-1]: row[:-1] for row in values(distribution_stats(df, "v", "g", groups=(1, 0)))}
    assert by_group == {g: brute([v for k, v in rows if k == g]) for g in (1, 0)}


def test_exact_percentiles_of_many_groups(spark, buckets):
    rows = [(n % 37 if n % 38 else None, float(n * 7919 % 1_001)) for n in range(5_000)]
    found = {row[-1]: row[:-1] for row in values(distribution_stats(frame(spark, rows), "v", "g"))}
    assert found == {g: brute([v for k, v in rows if k == g]) for g in {k for k, _ in rows}}


def test_exact_percentiles_of_a_hundred_thousand_groups_one_of_them_hot(spark, buckets):
    rows = spark.range(450_000, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id % 100000 END AS g", "cast(id * 7919 % 450007 as double) AS v"
    )
    found = distribution_stats(rows, "v", "g")
    local: dict[int, list[float]] = {}
    for g, v in rows.toPandas().itertuples(index=False):
        local.setdefault(g, []).append(v)
    picked = found.toPandas()
    assert len(picked) == len(local) == 100_001
    for row in picked.itertuples(index=False):
        assert tuple(row)[:-1] == brute(local[row[-1]])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(st.one_of(st.none(), st.integers(-30, 30).map(float)), max_size=60),
    probabilities=st.lists(st.sampled_from([0.0, 0.05, 0.25, 0.5, 0.9, 1.0]), min_size=1, max_size=4, unique=True),
)
def test_exact_percentiles_of_any_list(spark, numbers, probabilities):
    df = frame(spark, [(0, n) for n in numbers], 4)
    assert values(distribution_stats(df, "v", probabilities=probabilities)) == [brute(numbers, probabilities)]


def test_ranks_are_not_rounded_up_by_floating_point(spark):
    df = frame(spark, [(0, float(n)) for n in range(1, 31)])
    assert values(distribution_stats(df, "v", probabilities=(0.1, 0.7))) == [(1.0, 3.0, 21.0, 30.0, 30)]


def test_groups_limit_the_result(spark):
    df = frame(spark, [(0, 1.0), (2, 2.0), (None, 3.0)])
    for accuracy in (None, 100):
        rows = values(distribution_stats(df, "v", "g", groups=(0, 5), probabilities=(0.5,), accuracy=accuracy))
        assert sorted(rows, key=lambda r: r[-1]) == [(1.0, 1.0, 1.0, 1, 0), (None, None, None, 0, 5)]


def test_column_names(spark):
    df = frame(spark, [(0, 1.0)])
    assert distribution_stats(df, "v", "g", probabilities=(0.05, 0.999)).columns == [
        "min", "5th_percentile", "99.9th_percentile", "max", "count", "g",
    ]


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_sketch_stays_within_its_rank_bound(spark, accuracy):
    pick = random.Random(3)
    numbers = [pick.gauss(0, 100) for _ in range(20_000)]
    row = values(distribution_stats(frame(spark, [(0, n) for n in numbers]), "v", accuracy=accuracy))[0]
    ordered = sorted(numbers)
    assert (row[0], row[-2], row[-1]) == (ordered[0], ordered[-1], len(ordered))
    for value, p in zip(row[1:-2], QUARTILES):
        rank = ordered.index(value) + 1
        assert abs(rank - p * len(ordered)) <= len(ordered) / accuracy + 1


def test_quartiles_never_decrease(spark, tables):
    from spindlewatch.plans.registry import QUERIES, hours_input
    from spindlewatch.plans.reports import hours_by_cohort

    queries = [QUERIES[name](spark, tables) for name in ("hours_by_cohort", "percentiles_approx", "stats_by_cohort")]
    for report in (*queries, hours_by_cohort(hours_input(spark, tables), accuracy=10_000)):
        for row in report.select("min", "25th_percentile", "50th_percentile", "75th_percentile", "max").collect():
            assert list(row) == sorted(row)


def test_global_stats_of_nothing(spark):
    assert values(global_stats(frame(spark, [(0, 1.0)]).where("FALSE"), "v")) == [(None, None, 0)]


def test_nan_is_the_largest_value(spark, buckets):
    df = frame(spark, [(0, 1.0), (0, float("nan")), (0, 2.0)])
    low, median, high, count = values(distribution_stats(df, "v", probabilities=(0.5,)).select("*"))[0]
    assert (low, median, math.isnan(high), count) == (1.0, 2.0, True, 3)
    assert values(df.agg(F.max("v").isin(float("nan")))) == [(True,)]
