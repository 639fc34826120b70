"""What is kept up by deliveries: days of an extract, totals, newest rows; and copies that change together."""

from __future__ import annotations

import datetime
import json
import os
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import EDGE_ROWS, day, telemetry, values

from spindlewatch import sources, storage
from spindlewatch.functions import parse_instant, typed_telemetry
from spindlewatch.operators import add_to_totals, latest_rows_with_history, merge_newest, read_newest, read_totals, vacuum_newest
from spindlewatch.plans import daily_vault_failures
from spindlewatch.sinks import hashes, published, sending, write_csv


def dated(spark, rows):
    typed = typed_telemetry(telemetry(spark, rows))
    return typed.withColumn("data", parse_instant("data").cast("timestamp_ntz"))


def bag(df):
    return Counter(values(df))


def folders(path):
    return {p.name for p in Path(path).glob("day=*")}


# Days


def deliver(spark, tmp_path, name, rows, extract):
    write_csv(telemetry(spark, rows), f"{tmp_path}/{name}")
    sources.ingest_days(spark, f"{tmp_path}/{name}", extract, name, "daily")


def test_a_delivery_replaces_its_days_only(spark, tmp_path):
    extract = str(tmp_path / "extract")
    first = [(day(d), "A", "M", v, 1, "1") for d in (1, 2, 3) for v in (1, 2)] + [("junk", "A", "M", 9, 1, "1")]
    deliver(spark, tmp_path, "first", first, extract)
    untouched = {p: p.stat().st_mtime_ns for p in Path(extract).rglob("day=2023-04-01/**/*.parquet")}
    second = [(day(2), "A", "M", 7, 1, "1"), (day(4), "A", "M", 8, 1, "1"), ("?", "A", "M", 10, 1, "1")]
    deliver(spark, tmp_path, "second", second, extract)
    for _ in range(2):
        found = sources.read_extract_days(spark, extract, "daily")
        vaults = Counter((str(r["day"]), r["vault_id"]) for r in found.collect())
        assert vaults == Counter(
            [("2023-04-01", 1), ("2023-04-01", 2), ("2023-04-02", 7), ("2023-04-03", 1), ("2023-04-03", 2),
             ("2023-04-04", 8), ("None", 9), ("None", 10)]
        )
        deliver(spark, tmp_path, "second", second, extract)
    assert untouched and {p: p.stat().st_mtime_ns for p in Path(extract).rglob("day=2023-04-01/**/*.parquet")} == untouched


def test_a_report_of_some_days_reads_their_folders(spark, tmp_path):
    extract = str(tmp_path / "extract")
    deliver(spark, tmp_path, "first", [(day(d), "A", "M", 1, 1, "1") for d in (1, 1, 2, 2, 3, 3)], extract)
    some = sources.read_extract_days(spark, extract, "daily", datetime.date(2023, 4, 2), datetime.date(2023, 4, 2))
    report = daily_vault_failures(some)
    assert values(report) == [("02-04-2023", 1, 2)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan.split("PartitionFilters")[1]
    with pytest.raises(ValueError):
        sources.ingest_days(spark, f"{tmp_path}/first", extract, "x", "daily", unit="week")


# Provenance


def test_changes_of_the_raw_files_or_renames_build_again(spark, tmp_path):
    stages = [str(tmp_path / name) for name in ("raw", "csv", "parquet")]

    def ingest(renames=None):
        return sources.ingest_extract(spark, *stages, "rankings", renames, follow_changes=True)

    write_csv(telemetry(spark, EDGE_ROWS), stages[0])
    assert ingest() == {"csv": True, "parquet": True}
    assert ingest() == {"csv": False, "parquet": False}
    assert ingest({"s1": "other"}) == {"csv": True, "parquet": True}
    write_csv(telemetry(spark, EDGE_ROWS[:3]), stages[0])
    assert ingest({"s1": "other"}) == {"csv": True, "parquet": True}
    assert sources.read_parquet(spark, stages[2]).count() == 3
    (Path(stages[1]) / "_made_from.json").unlink()
    assert ingest({"s1": "other"})["csv"]
    assert json.loads((Path(stages[2]) / "_made_from.json").read_text())["columns"] == ["vault_id", "model", "failure"]


# Totals


def test_totals_of_deliveries_equal_a_full_run(spark, tmp_path):
    uri = str(tmp_path / "totals")
    rows = [(day(d), "A", f"M{d % 2}", v, d % 3 == 0, "1") for d in range(1, 9) for v in (1, 2, None)]
    rows = [(*r[:4], int(r[4]), r[5]) for r in rows] + [("junk", "A", None, 1, 1, "1")]
    parts = [[r for r in rows if r[0] < day(4)], [r for r in rows if day(4) <= r[0] < day(7)], [r for r in rows if r[0] >= day(7)]]
    for number in (0, 2, 1, 1):
        add_to_totals(dated(spark, parts[number]), uri, f"part{number}")
    whole = typed_telemetry(telemetry(spark, rows)).groupBy("vault_id", "model").agg(
        F.sum("failure"), F.count(F.when(F.col("failure") == 1, 1)), F.count("*")
    )
    assert bag(read_totals(spark, uri, ["vault_id", "model"])) == bag(whole)
    first = read_totals(spark, uri, ["day"], datetime.date(2023, 4, 2), datetime.date(2023, 4, 3))
    assert sorted(values(first)) == [(datetime.date(2023, 4, 2), 0, 0, 3), (datetime.date(2023, 4, 3), 3, 3, 3)]


def test_a_corrected_day_leaves_nothing_of_the_old_one(spark, tmp_path):
    uri = str(tmp_path / "totals")
    add_to_totals(dated(spark, [(day(1), "A", "M1", 1, 1, "1"), (day(2), "A", "M1", 1, 1, "1")]), uri, "one")
    add_to_totals(dated(spark, [(day(1), "A", "M2", 5, 0, "1")]), uri, "two")
    assert sorted(values(read_totals(spark, uri, ["vault_id"]))) == [(1, 1, 1, 1), (5, 0, 0, 1)]


# Newest rows


def test_the_state_equals_the_whole_history_in_any_order(spark, tmp_path):
    rows = dated(spark, EDGE_ROWS + [("junk", "G", "M", 1, 1, "1"), ("junk", "H", "M", 1, 0, "1"), (day(5), "I", "M", 1, 0, "1")])
    parts = [rows.where("data = '2023-04-03'"), rows.where("data IS NULL"), rows.where("data < '2023-04-03' OR data > '2023-04-03'")]
    wanted = bag(latest_rows_with_history(rows))
    for number, order in enumerate([(0, 1, 2), (2, 1, 0), (1, 0, 2, 1, 0, 2)]):
        uri = f"{tmp_path}/{number}"
        for step, part in enumerate(order, 1):
            assert merge_newest(parts[part], uri, buckets=4) == step
        assert bag(read_newest(spark, uri)) == wanted


def test_a_later_delivery_of_an_undated_drive(spark, tmp_path):
    uri = str(tmp_path)
    merge_newest(dated(spark, [("junk", "G", "M", 1, 1, "1")]), uri, buckets=2)
    assert values(read_newest(spark, uri)) == []
    merge_newest(dated(spark, [(day(1), "G", "M", 1, 0, "1")]), uri, buckets=2)
    merge_newest(dated(spark, []), uri, buckets=2)
    assert [(r["serial_number"], r["failure"]) for r in read_newest(spark, uri).collect()] == [("G", 1)]


def test_old_states_are_removed_with_their_tables(spark, tmp_path, monkeypatch):
    uri = str(tmp_path / "state")
    assert vacuum_newest(spark, uri) == 0
    for number in range(1, 5):
        merge_newest(dated(spark, [(day(number), "G", "M", 1, 0, str(number))]), uri, buckets=2)
    monkeypatch.setattr(storage, "publish_text", lambda *_: False)
    with pytest.raises(RuntimeError):  # another writer was first, so its state is named by nothing
        merge_newest(dated(spark, [(day(9), "G", "M", 1, 0, "9")]), uri, buckets=2)
    monkeypatch.undo()
    before = values(read_newest(spark, uri))
    assert len(list(Path(uri).glob("state=*"))) == 5
    assert vacuum_newest(spark, uri) == 0  # all young
    assert vacuum_newest(spark, uri, min_age_s=-60) == 3
    names = {name.removeprefix("state=") for name in os.listdir(uri) if name.startswith("state=")}
    assert len(names) == 2
    tables = {t.name for t in spark.catalog.listTables() if t.name.startswith("newest_")}
    assert all(f"newest_{name}" in tables for name in names)
    assert values(read_newest(spark, uri)) == before
    assert merge_newest(dated(spark, [(day(5), "G", "M", 1, 0, "5")]), uri, buckets=2) == 5
    assert vacuum_newest(spark, uri, versions=1, min_age_s=-60) == 2
    assert [r["serial_number"] for r in read_newest(spark, uri).collect()] == ["G"]


def test_the_state_is_not_shuffled(spark, tmp_path, monkeypatch):
    from spindlewatch.operators import newest

    uri = str(tmp_path)
    rows = dated(spark, EDGE_ROWS)
    merge_newest(rows, uri)
    assert "Exchange" not in read_newest(spark, uri)._jdf.queryExecution().executedPlan().toString()
    plans = []
    monkeypatch.setattr(newest, "_publish", lambda df, *_: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merge_newest(rows, uri)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines, scans = plans[0].splitlines(), 0
    for at, line in enumerate(lines):
        if "FileScan parquet" not in line or "newest_" not in line:
            continue
        scans += 1
        depth = len(line) - len(line.lstrip(" :+-"))
        for up in reversed(lines[:at]):  # what the scan flows into, as far as the first join
            indent = len(up) - len(up.lstrip(" :+-"))
            if indent < depth:
                depth = indent
                assert "Exchange" not in up
                if "Join" in up:
                    break
    assert scans == 2


# Copies


def test_copies_change_together_on_two_file_systems(spark, tmp_path, monkeypatch):
    (tmp_path / "mounted").mkdir()
    copies = [f"file:{tmp_path}/here", f"{storage.mount(spark, f'file:{tmp_path}/mounted')}/there"]
    rows = spark.createDataFrame([(1, "a")], "n int, t string")

    def read(copy, version=None):
        folder = published.published_folder(spark, copies[0], copy, version)
        return values(spark.read.schema("n int, t string").option("header", True).csv(folder))

    with pytest.raises(FileNotFoundError):
        read(copies[0])
    assert published.publish_copies(rows, copies, single_file=True) == 1
    assert read(copies[0]) == read(copies[1]) == [(1, "a")]

    seen = []
    committed = storage.committed

    def second_fails(session, uri):
        seen.append(uri)
        return committed(session, uri) and "viewfs" not in uri

    monkeypatch.setattr(storage, "committed", second_fails)
    with pytest.raises(RuntimeError, match="viewfs"):
        published.publish_copies(rows.withColumn("t", F.lit("b")), copies)
    monkeypatch.undo()
    assert len(seen) == 2 and read(copies[0]) == read(copies[1]) == [(1, "a")]
    assert published.publish_copies(rows.withColumn("t", F.lit("c")), copies) == 2
    assert read(copies[0]) == read(copies[1]) == [(1, "c")]
    assert read(copies[1], 1) == [(1, "a")]
    with pytest.raises(ValueError):
        read("elsewhere")


def test_nothing_stays_cached_when_a_copy_fails(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "n int, t string")
    with pytest.raises(Exception):
        published.publish_copies(rows, [str(tmp_path / "a"), "nosuch://x/y"])
    assert not rows.is_cached
    assert published.newest_version(spark, str(tmp_path / "a")) == 0


# Sending


def pipelined(folder, failures=0):
    """Clients that log every call to a file; the first ``failures`` calls of all clients fail."""

    class Client:
        def pipeline(self, transaction):
            assert not transaction
            self.held = []
            return self

        def hset(self, key, mapping):
            if hasattr(self, "held"):
                self.held.append((key, mapping))
            else:
                self.log([(key, mapping)])

        def execute(self):
            failed = os.path.join(folder, "failed")
            done = os.listdir(failed) if os.path.isdir(failed) else []
            if len(done) < failures:
                os.makedirs(failed, exist_ok=True)
                open(os.path.join(failed, uuid.uuid4().hex), "w").close()
                raise ConnectionError("lost")
            self.log(self.held)

        def log(self, sent):
            os.makedirs(os.path.join(folder, "calls"), exist_ok=True)
            with open(os.path.join(folder, "calls", uuid.uuid4().hex), "w") as file:
                json.dump(sent, file)

        def close(self):
            pass

    return Client


def calls(folder):
    return [json.loads(p.read_text()) for p in (Path(folder) / "calls").iterdir()]


def state(folder):
    found = {}
    for call in calls(folder):
        for key, mapping in call:
            found.setdefault(key, {}).update(mapping)
    return found


def test_one_call_a_batch_and_a_marker_at_the_end(spark, tmp_path):
    rows = [(f"k{i // 40}", f"f{i}", None if i == 7 else str(i)) for i in range(100)]
    cells = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "key string, field string, value string")
    sending.send_cells(cells, pipelined(str(tmp_path)), batch=20, marker="done")
    wanted = {}
    for key, field, value in rows:
        if value is not None:
            wanted.setdefault(key, {})[field] = value
    assert state(tmp_path) == wanted | {"done": {"fields": "99", "complete": "1"}}
    assert len(calls(tmp_path)) == 6 + 1
    assert max(sum(len(m) for _, m in call) for call in calls(tmp_path)) == 20


def test_a_failed_call_is_sent_again(spark, tmp_path, monkeypatch):
    cells = spark.createDataFrame([("k", f"f{i}", "v") for i in range(50)], "key string, field string, value string").coalesce(1)
    sending.send_cells(cells, pipelined(str(tmp_path), failures=3), batch=10)
    assert state(tmp_path) == {"k": {f"f{i}": "v" for i in range(50)}}
    assert len(calls(tmp_path)) == 5


def test_no_marker_after_too_many_failures(spark, tmp_path):
    cells = spark.createDataFrame([("k", "f", "v")], "key string, field string, value string")
    with pytest.raises(Exception, match="lost"):
        sending.send_cells(cells, pipelined(str(tmp_path), failures=99), retries=1, marker="done")
    assert not (tmp_path / "calls").exists()
    sending.send_cells(cells, pipelined(str(tmp_path)), marker="done")
    assert state(tmp_path) == {"k": {"f": "v"}, "done": {"fields": "1", "complete": "1"}}


def test_nothing_to_send(spark, tmp_path):
    hashes.write_cells(spark.createDataFrame([], "key string, field string, value string"), pipelined(str(tmp_path)), "done")
    assert state(tmp_path) == {"done": {"fields": "0", "complete": "1"}}
