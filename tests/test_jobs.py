"""Jobs that also feed a key-value store."""

from __future__ import annotations

import pytest
from samples import EDGE_ROWS, telemetry, values
from test_hashes import recorder, sent

from spindlewatch.__main__ import refuse_own_disks
from spindlewatch.functions import typed_telemetry
from spindlewatch.jobs import Outputs, run_daily, run_hours, run_rankings
from spindlewatch.sinks.published import newest_version, published_folder


@pytest.fixture(scope="module")
def edge(spark):
    return typed_telemetry(telemetry(spark, EDGE_ROWS))


def test_rankings_reach_the_store_from_the_tasks(edge, tmp_path):
    run_rankings(edge, Outputs(connect=recorder(str(tmp_path))))
    assert sent(tmp_path) == {
        "query2": {"M1": "3", "M2": "1", "M3": "1"},
        "query2.2:1": {"vaultId": "1", "totalFailures": "2", "uniqueModels": "M1, M2"},
        "query2.2:2": {"vaultId": "2", "totalFailures": "1", "uniqueModels": ""},
    }


def test_hours_reach_the_store(edge, tmp_path):
    run_hours(edge, Outputs(connect=recorder(str(tmp_path))))
    found = sent(tmp_path)
    assert found["failureStats"]["50th_percentile"] == "30.0"
    unknown = dict.fromkeys(("min", "25th_percentile", "50th_percentile", "75th_percentile", "max"), "")
    assert found["nofailureStats"] == {"# failure": "0", "count": "0", **unknown}


def test_copies_of_a_job_are_published_together(spark, edge, tmp_path):
    folders = [str(tmp_path / name) for name in ("one", "two")]
    for _ in range(2):
        run_rankings(edge, Outputs(folders=folders, together=True))
    for name in ("models", "vaults"):
        lead, other = (f"{folder}/{name}" for folder in folders)
        assert newest_version(spark, lead) == 2
        first, second = (values(spark.read.csv(published_folder(spark, lead, copy))) for copy in (lead, other))
        assert first and sorted(first, key=repr) == sorted(second, key=repr)


def test_file_folders_are_refused_on_a_cluster():
    refuse_own_disks(["file:///results"], "local[8]")
    refuse_own_disks(["hdfs:///results"], "yarn")
    with pytest.raises(ValueError, match="--shared-files"):
        refuse_own_disks(["hdfs:///results", "file:///results"], "yarn")


def test_nothing_is_kept_after_a_job(edge, spark):
    seen = []
    run_daily(edge, Outputs(preview=seen.append), counts=(1,))
    assert [row[1:] for row in values(seen[0])] == [(1, 1), (None, 1), (1, 1)]
    assert not seen[0].is_cached
