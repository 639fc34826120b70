"""CSV sinks, ingest stages, jobs and the command line."""

from __future__ import annotations

import csv
from pathlib import Path

import pytest
from samples import EDGE_ROWS, day, telemetry, values
from pyspark.sql import functions as F

from spindlewatch import __main__ as command
from spindlewatch import sources, storage
from spindlewatch.functions import parse_instant, typed_telemetry
from spindlewatch.plans import daily_vault_failures, hours_by_cohort, top_vaults
from spindlewatch.schema import EXTRACT_COLUMNS
from spindlewatch.sinks import hashes, write_csv


def parts(folder):
    return sorted(Path(folder).glob("part-*"))


def lines(folder):
    return [row for part in parts(folder) for row in csv.reader(part.open())]


@pytest.fixture(scope="module")
def edge(spark):
    return typed_telemetry(telemetry(spark, EDGE_ROWS))


def write_raw(spark, path, rows=EDGE_ROWS):
    """A raw file with more columns than any report needs, in another order."""
    raw = telemetry(spark, rows).withColumnRenamed("data", "date")
    raw.select(F.lit("0").alias("s1"), "failure", "date", "model", "vault_id", "serial_number", "s9_power_on_hours").write.mode(
        "overwrite"
    ).option("header", True).csv(str(path))


def test_csv_copies_are_equal_and_replaced(spark, tmp_path):
    rows = [(day(4), "A", "M", 1066, 1, "1")] * 2 + [(day(3), "A", "M", 7, 1, "1")] * 3
    report = daily_vault_failures(typed_telemetry(telemetry(spark, rows)))
    copies = [str(tmp_path / name) for name in ("one", "two")]
    for _ in range(2):
        write_csv(report, *copies)
    text = [["data", "vault_id", "failures_count"], ["03-04-2023", "7", "3"], ["04-04-2023", "1066", "2"]]
    for copy in copies:
        assert [row for i, row in enumerate(lines(copy)) if i == 0 or row != text[0]] == text
    assert not report.is_cached


def test_model_lists_are_quoted(spark, tmp_path):
    rows = [(day(4), "A", m, 1053, 1, "1") for m in ("TOSHIBA MQ01ABF050M", "ST8000NM0055", "ST8000NM0055")]
    write_csv(top_vaults(typed_telemetry(telemetry(spark, rows))), str(tmp_path / "vaults"), single_file=True)
    assert parts(tmp_path / "vaults")[0].read_text() == (
        'vault_id,total_failures,unique_models\n1053,3,"ST8000NM0055,TOSHIBA MQ01ABF050M"\n'
    )


def test_single_file_keeps_order_and_number_format(spark, edge, tmp_path):
    write_csv(hours_by_cohort(edge), str(tmp_path / "hours"), single_file=True)
    assert len(parts(tmp_path / "hours")) == 1
    assert lines(tmp_path / "hours") == [
        ["min", "25th_percentile", "50th_percentile", "75th_percentile", "max", "count", "failure"],
        ["30.0", "30.0", "30.0", "31.0", "31.0", "2", "1"],
        ["", "", "", "", "", "0", "0"],
    ]


@pytest.mark.parametrize("report", ["daily", "rankings", "hours"])
def test_extracts_hold_the_columns_of_their_report(spark, edge, tmp_path, report):
    write_raw(spark, tmp_path / "raw")
    stages = [str(tmp_path / name) for name in ("raw", "csv", "parquet")]
    assert sources.ingest_extract(spark, *stages, report, {"date": "data"}) == {"csv": True, "parquet": True}
    extract = sources.read_parquet(spark, stages[2])
    wanted = edge.withColumn("data", parse_instant("data").cast("timestamp_ntz")).select(extract.columns)
    assert extract.dtypes == wanted.dtypes
    assert sorted(values(extract), key=repr) == sorted(values(wanted), key=repr)
    assert set(extract.columns) == set(EXTRACT_COLUMNS[report])


def test_reports_on_extracts_equal_reports_on_text(spark, edge, tmp_path):
    write_raw(spark, tmp_path / "raw")
    for report, build in (("daily", daily_vault_failures), ("hours", hours_by_cohort)):
        stages = [str(tmp_path / name) for name in ("raw", f"{report}.csv", f"{report}.parquet")]
        sources.ingest_extract(spark, *stages, report, {"date": "data"})
        assert values(build(sources.read_parquet(spark, stages[2]))) == values(build(edge))


def test_complete_stages_are_skipped(spark, tmp_path):
    stages = [str(tmp_path / name) for name in ("raw", "csv", "parquet")]
    write_raw(spark, stages[0])
    sources.ingest_extract(spark, *stages, "rankings")
    before = sorted(values(sources.read_parquet(spark, stages[2])), key=repr)
    write_raw(spark, stages[0], EDGE_ROWS[:1])
    assert sources.ingest_extract(spark, *stages, "rankings") == {"csv": False, "parquet": False}
    assert sorted(values(sources.read_parquet(spark, stages[2])), key=repr) == before


def test_a_half_written_stage_is_built_again(spark, tmp_path):
    stages = [str(tmp_path / name) for name in ("raw", "csv", "parquet")]
    write_raw(spark, stages[0])
    sources.ingest_extract(spark, *stages, "rankings")
    (tmp_path / "parquet" / "_SUCCESS").unlink()
    assert sources.ingest_extract(spark, *stages, "rankings") == {"csv": False, "parquet": True}
    assert sources.read_parquet(spark, stages[2]).count() == len(EDGE_ROWS)


def test_missing_raw_data_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        sources.ingest_extract(spark, *[str(tmp_path / n) for n in "abc"], "daily")


def test_union_structs_read_like_plain_columns(spark, edge, tmp_path):
    no_text = F.lit(None).cast("string")
    unions = edge.select(
        "data",
        F.struct(F.lit(None).cast("long").alias("member0"), F.col("serial_number").alias("member1")).alias("serial_number"),
        "model",
        F.struct(F.col("vault_id").alias("member0"), no_text.alias("member1")).alias("vault_id"),
        F.struct(F.col("failure").alias("member0"), no_text.alias("member1")).alias("failure"),
        F.struct(F.col("s9_power_on_hours").alias("member0"), no_text.alias("member1")).alias("s9_power_on_hours"),
    )
    unions.write.parquet(str(tmp_path / "unions"))
    read = sources.read_parquet(spark, str(tmp_path / "unions"))
    assert read.dtypes == edge.dtypes
    assert sorted(values(read), key=repr) == sorted(values(edge), key=repr)


def test_a_serial_in_the_other_member_is_null(spark):
    row = spark.sql("SELECT named_struct('member0', 5L, 'member1', CAST(NULL AS STRING)) AS serial_number")
    assert values(typed_telemetry(row)) == [(None,)]


def test_scratch_is_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = (storage.scratch_folder(spark, "x") for _ in range(2))
    assert one != two and one.startswith(shared) and two.startswith(shared)


class Unshared:
    """What a cluster session without a shared folder looks like to the storage module."""

    class conf:
        get = staticmethod(lambda name, default=None: default)

    class sparkContext:
        master = "spark://cluster:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.scratch_folder(Unshared, "x")


@pytest.fixture
def run(monkeypatch, spark):
    """The command line inside the test session."""
    monkeypatch.setattr(command, "build_session", lambda *_: spark)
    return lambda *arguments: command.main([str(a) for a in arguments])


def test_rankings_from_raw_to_results(run, spark, tmp_path, capsys):
    write_raw(spark, tmp_path / "raw")
    run("rankings", "--raw", tmp_path / "raw", "--work", tmp_path / "work", "--out", tmp_path / "a", "--out",
        tmp_path / "b", "--store", tmp_path / "cells", "--show")
    for folder in ("a", "b"):
        assert lines(tmp_path / folder / "vaults")[-2:] == [["1", "2", "M1,M2"], ["2", "1", ""]]
        assert ["M1", "3"] in lines(tmp_path / folder / "models")
    assert "total_failures" in capsys.readouterr().out
    store = hashes.read_store(spark, str(tmp_path / "cells"))
    assert sorted(values(hashes.scan_keys(store, "query2.2:*"))) == [("query2.2:1",), ("query2.2:2",)]
    assert sorted(values(hashes.get_fields(store, "query2"))) == [("M1", "3"), ("M2", "1"), ("M3", "1")]


def test_daily_and_hours_share_a_store(run, spark, tmp_path):
    rows = [(day(4), "A", "M", 9, 1, "12")] * 2 + [(day(4), "B", "M", None, 1, "1")] * 2
    write_raw(spark, tmp_path / "raw", rows)
    shared = ["--raw", tmp_path / "raw", "--work", tmp_path / "work", "--rename", "date=data", "--store", tmp_path / "cells"]
    run("daily", *shared, "--out", tmp_path / "out")
    run("hours", *shared, "--out", tmp_path / "out", "--batch", 2, "--accuracy", 100)
    assert lines(tmp_path / "out" / "daily")[-1] == ["04-04-2023", "9", "2"]
    assert lines(tmp_path / "out" / "daily")[-2][1] in ("", "vault_id")
    assert lines(tmp_path / "out" / "hours")[1] == ["1.0", "1.0", "1.0", "12.0", "12.0", "4", "1"]
    store = hashes.read_store(spark, str(tmp_path / "cells"))
    assert {k for k, in values(store.select("key").distinct())} == {
        "query1:04-04-2023:9", "failureStats", "nofailureStats",
    }


def test_raw_input_needs_a_work_folder(capsys):
    with pytest.raises(SystemExit):
        command.parse(["daily", "--raw", "x"])
    assert "--work" in capsys.readouterr().err
