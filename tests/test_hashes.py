"""Keyed hashes and the cell store."""

from __future__ import annotations

import json
import os
import uuid

import pytest
from samples import EDGE_ROWS, day, telemetry, values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spindlewatch.functions import typed_telemetry
from spindlewatch.plans import daily_vault_failures, hours_by_cohort, rank_vaults, top_models
from spindlewatch.sinks import hashes


@pytest.fixture(scope="module")
def edge(spark):
    return typed_telemetry(telemetry(spark, EDGE_ROWS))


def as_dict(table):
    return {row["key"]: row["fields"] for row in table.collect()}


def cells(spark, rows):
    return spark.createDataFrame(rows, "key string, field string, value string")


def test_daily_hash(spark):
    rows = [(day(4), "A", "M", 1066, 1, "1")] * 2
    report = daily_vault_failures(typed_telemetry(telemetry(spark, rows)))
    assert as_dict(hashes.daily_hashes(report)) == {
        "query1:04-04-2023:1066": {"date": "04-04-2023", "vaultId": "1066", "failuresCount": "2"}
    }


def test_vault_hash_lists_models_with_a_blank(edge):
    assert as_dict(hashes.vault_hashes(rank_vaults(edge))) == {
        "query2.2:1": {"vaultId": "1", "totalFailures": "2", "uniqueModels": "M1, M2"},
        "query2.2:2": {"vaultId": "2", "totalFailures": "1", "uniqueModels": ""},
    }


def test_cohort_hash_empties_unknown_fields(edge):
    found = {}
    for key, field, value in values(hashes.to_cells(hashes.cohort_hashes(hours_by_cohort(edge)))):
        found.setdefault(key, {})[field] = value
    assert found == {
        "failureStats": {
            "# failure": "1", "min": "30.0", "25th_percentile": "30.0", "50th_percentile": "30.0",
            "75th_percentile": "31.0", "max": "31.0", "count": "2",
        },
        "nofailureStats": {
            "# failure": "0", "min": "", "25th_percentile": "", "50th_percentile": "",
            "75th_percentile": "", "max": "", "count": "0",
        },
    }


def test_single_hash_truncates_counts_and_skips_the_null_model(spark, edge):
    assert sorted(values(hashes.model_cells(top_models(edge)))) == [
        ("query2", "M1", "3"), ("query2", "M2", "1"), ("query2", "M3", "1"),
    ]
    doubles = spark.createDataFrame([("m", 7.9)], "model string, n double")
    assert values(hashes.single_hash(doubles, "query2", "model", "n")) == [("query2", "m", "7")]


def test_a_null_key_part_raises(spark):
    report = spark.createDataFrame([("04-04-2023", None, 2)], "data string, vault_id int, failures_count long")
    with pytest.raises(PySparkException, match="NULL in a key part of query1"):
        hashes.daily_hashes(report).collect()


def test_upsert_replaces_fields_and_keeps_the_rest(spark):
    old = cells(spark, [("a", "x", "1"), ("a", "y", "2"), ("b", "x", "3")])
    new = cells(spark, [("a", "x", "9"), ("c", "x", "4")])
    once = hashes.upsert_cells(old, new)
    wanted = [("a", "x", "9"), ("a", "y", "2"), ("b", "x", "3"), ("c", "x", "4")]
    assert sorted(values(once)) == wanted
    assert sorted(values(hashes.upsert_cells(once, new))) == wanted


def test_store_keeps_the_last_batch_and_reruns_replace(spark, tmp_path):
    store = str(tmp_path / "cells")
    hashes.append_batch(cells(spark, [("a", "x", "1"), ("a", "y", "1")]), store, 9)
    hashes.append_batch(cells(spark, [("a", "x", "wrong"), ("z", "x", "0")]), store, 10)
    hashes.append_batch(cells(spark, [("a", "x", "2")]), store, 10)
    assert sorted(values(hashes.read_store(spark, store))) == [("a", "x", "2"), ("a", "y", "1")]


def test_keys_and_reads(spark):
    table = cells(
        spark,
        [("query1:b:1", "date", "b"), ("query1:b:1", "vaultId", "1"), ("query10", "x", "1"), ("query2", "m", "5")],
    )
    assert values(hashes.scan_keys(table, "query1:*")) == [("query1:b:1",)]
    assert values(hashes.get_all(table, "query1:*", hashes.DAILY_FIELDS)) == [("query1:b:1", "b", "1", None)]
    assert hashes.get_all(table, "query1:*", hashes.DAILY_FIELDS).columns == ["key", *hashes.DAILY_FIELDS]
    assert values(hashes.get_fields(table, "query2")) == [("m", "5")]
    with pytest.raises(ValueError):
        hashes.scan_keys(table, "query?:*")


def test_key_patterns_reach_the_scan_of_the_store(spark, tmp_path):
    store = str(tmp_path / "cells")
    hashes.append_batch(cells(spark, [("a", "x", "1")]), store, 1)
    keys = hashes.scan_keys(hashes.read_store(spark, store), "query1:*")
    assert "StringStartsWith(key,query1:)" in keys._jdf.queryExecution().executedPlan().toString()


def test_panels_merge_by_name(spark):
    left = spark.createDataFrame([("1", "2")], "a string, b string")
    right = spark.createDataFrame([("3",)], "b string")
    assert values(hashes.merge_panels(left, right)) == [("1", "2"), (None, "3")]


def recorder(folder):
    """A client factory that logs to files, usable from the tasks' own processes."""

    class Client:
        def __init__(self):
            self.path = os.path.join(folder, uuid.uuid4().hex)
            self.sent = []

        def hset(self, key, mapping):
            self.sent.append((key, mapping))

        def close(self):
            with open(self.path, "w") as log:
                json.dump(self.sent, log)

    return Client


def sent(folder):
    found: dict[str, dict] = {}
    for name in os.listdir(folder):
        with open(os.path.join(folder, name)) as log:
            for key, mapping in json.load(log):
                found.setdefault(key, {}).update(mapping)
    return found


def test_hashes_are_written_from_the_tasks(edge, tmp_path):
    hashes.write_hashes(hashes.vault_hashes(rank_vaults(edge)), recorder(str(tmp_path)))
    assert sent(tmp_path)["query2.2:1"] == {"vaultId": "1", "totalFailures": "2", "uniqueModels": "M1, M2"}


def test_cells_are_written_twice_without_harm(edge, tmp_path):
    table = hashes.model_cells(top_models(edge)).select("*", F.lit(1).alias("extra"))
    for _ in range(2):
        hashes.write_cells(table, recorder(str(tmp_path)))
    assert sent(tmp_path) == {"query2": {"M1": "3", "M2": "1", "M3": "1"}}
