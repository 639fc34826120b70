"""Rows that are easy to get wrong, with results written by hand."""

from __future__ import annotations

import pytest
from samples import EDGE_ROWS, day, telemetry, values
from pyspark.sql import Window
from pyspark.sql import functions as F

from spindlewatch.functions import parse_instant, typed_telemetry
from spindlewatch.operators import flag_ever_failed, latest_instants, latest_rows, latest_rows_with_history
from spindlewatch.plans import daily_vault_failures, hours_by_cohort, top_models, top_vaults


@pytest.fixture(scope="module")
def edge(spark):
    return typed_telemetry(telemetry(spark, EDGE_ROWS))


@pytest.fixture(scope="module")
def dated(edge):
    return edge.withColumn("data", parse_instant("data")).drop("model", "vault_id")


def short(df):
    rows = df.select("serial_number", F.dayofmonth("data").alias("day"), "failure", "s9_power_on_hours")
    return sorted(values(rows), key=repr)


FLAGGED = [
    ("A", 3, 1, 30.0),
    ("A", 3, 1, 31.0),
    ("B", 1, 1, None),
    ("D", 1, 1, None),
    ("E", 1, None, 4.0),
    ("F", 1, 2, 4.0),
]


def test_latest_rows_keep_ties_and_their_own_failure(dated):
    assert short(latest_rows(dated)) == [
        ("A", 3, 0, 30.0),
        ("A", 3, 0, 31.0),
        ("B", 1, 0, None),
        ("D", 1, 1, None),
        ("E", 1, None, 4.0),
        ("F", 1, 2, 4.0),
    ]


def test_history_flags_latest_rows(dated):
    assert short(latest_rows_with_history(dated)) == FLAGGED


def test_two_joins_equal_one(dated):
    assert short(flag_ever_failed(latest_rows(dated), dated)) == FLAGGED


@pytest.mark.parametrize("salts", [1, 3])
def test_salts_do_not_change_the_flag(dated, salts):
    assert short(flag_ever_failed(latest_rows(dated), dated, salts=salts)) == FLAGGED


def test_window_form_gives_the_same_rows(dated):
    history = Window.partitionBy("serial_number")
    windowed = (
        dated.where("serial_number IS NOT NULL")
        .withColumn("ever", F.max((F.col("failure") == 1).cast("int")).over(history))
        .withColumn("place", F.rank().over(history.orderBy(F.desc_nulls_last("data"))))
        .where("place = 1 AND data IS NOT NULL")
        .withColumn("failure", F.when(F.col("ever") == 1, 1).otherwise(F.col("failure")))
    )
    assert short(windowed) == FLAGGED


def test_flag_keeps_rows_without_a_serial(dated):
    rows = values(flag_ever_failed(dated, dated).where("serial_number IS NULL").select("failure"))
    assert rows == [(1,)]


def test_latest_instants_keep_every_key(dated):
    found = {row[0]: row[1] and row[1].day for row in values(latest_instants(dated))}
    assert found == {"A": 3, "B": 1, "C": None, None: 1, "D": 1, "E": 1, "F": 1}


@pytest.mark.parametrize("accuracy", [None, 10_000])
def test_hours_report_has_both_cohorts(edge, accuracy):
    assert values(hours_by_cohort(edge, accuracy=accuracy)) == [
        (30.0, 30.0, 30.0, 31.0, 31.0, 2, 1),
        (None, None, None, None, None, 0, 0),
    ]


@pytest.mark.parametrize("accuracy", [None, 10_000])
def test_hours_report_without_input(edge, accuracy):
    assert values(hours_by_cohort(edge.where("FALSE"), accuracy=accuracy)) == [
        (None, None, None, None, None, 0, 1),
        (None, None, None, None, None, 0, 0),
    ]


def test_vault_ranking_drops_the_null_vault_and_skips_null_models(edge):
    assert values(top_vaults(edge)) == [(1, 2, "M1,M2"), (2, 1, "")]


def test_model_ranking_keeps_null_and_healthy_models(spark):
    rows = [(day(1), "A", "good", 1, 0, "1"), (day(1), "B", None, 1, 1, "1"), (day(1), "C", None, 1, 1, "1")]
    assert values(top_models(typed_telemetry(telemetry(spark, rows)))) == [(None, 2), ("good", 0)]


def test_ranking_ties_at_the_cut_follow_the_name(spark):
    rows = [(day(1), "A", m, v, 1, "1") for v, m in ((3, "c"), (1, "a"), (2, "b"))]
    frame = typed_telemetry(telemetry(spark, rows))
    assert values(top_models(frame, k=2)) == [("a", 1), ("b", 1)]
    assert values(top_vaults(frame, k=2)) == [(1, 1, "a"), (2, 1, "b")]


def daily(spark, cells):
    rows = [(d, "A", "M", v, f, "1") for (d, v), failures in cells.items() for f in failures]
    return typed_telemetry(telemetry(spark, rows))


def test_daily_counts_outside_the_list_drop(spark):
    cells = {(day(2), 1): [1] * 5, (day(2), 2): [1, 1, 0, None], (day(2), 3): [1], (day(2), 4): [None, None]}
    assert values(daily_vault_failures(daily(spark, cells))) == [("02-04-2023", 2, 2)]


def test_daily_null_vault_and_unknown_day_are_groups(spark):
    cells = {(day(2), None): [1, 1], ("junk", 7): [1, 1, 1], (day(1), 9): [1] * 4}
    assert values(daily_vault_failures(daily(spark, cells))) == [
        (None, 7, 3),
        ("01-04-2023", 9, 4),
        ("02-04-2023", None, 2),
    ]


def test_daily_zero_can_be_wanted(spark):
    cells = {(day(2), 1): [0, 0], (day(2), 2): [1], (day(2), 3): [None]}
    assert values(daily_vault_failures(daily(spark, cells), counts=(0,))) == [("02-04-2023", 1, 0)]


def test_daily_order_is_by_date_not_by_text(spark):
    cells = {("2023-05-01T00:00:00.000000", 1): [1, 1], (day(30), 2): [1, 1], (day(30, "23:59:59.999999"), 1): [1, 1]}
    assert values(daily_vault_failures(daily(spark, cells))) == [
        ("30-04-2023", 1, 2),
        ("30-04-2023", 2, 2),
        ("01-05-2023", 1, 2),
    ]


def test_vault_failures_of_a_day_never_exceed_the_ranking(spark, tables):
    from spindlewatch.plans.registry import QUERIES

    totals = {v: n for v, n, _ in values(QUERIES["top_vaults"](spark, tables))}
    seen: dict[int, int] = {}
    for _, vault, count in values(QUERIES["daily_vault_failures"](spark, tables)):
        assert count in (2, 3, 4)
        seen[vault] = seen.get(vault, 0) + count
    assert totals and all(seen.get(vault, 0) <= total for vault, total in totals.items())
