"""The cell store: manifests, folding, pinned readers, writers that meet."""

from __future__ import annotations

import random
import threading
from pathlib import Path

import pytest
from samples import values

from spindlewatch import storage
from spindlewatch.sinks import hashes, store


def cells(spark, rows):
    return spark.createDataFrame(rows, "key string, field string, value string").coalesce(2)


def stored_rows(uri):
    import pyarrow.parquet as pq

    named = {layer.folder for layer in uri[1].layers}
    files = [p for p in Path(uri[0]).rglob("*.parquet") if any(f"layer={name}" in str(p) for name in named)]
    return sum(pq.read_metadata(p).num_rows for p in files)


def test_twenty_batches_equal_one_table_and_reads_follow_live_cells(spark, tmp_path):
    uri, pick, wanted, sizes = str(tmp_path), random.Random(5), {}, []
    for batch in range(20):
        new = {(f"k{pick.randrange(9)}", f"f{pick.randrange(60)}"): f"{batch}" for _ in range(90)}
        wanted |= new
        assert store.append_batch(cells(spark, [(*k, v) for k, v in new.items()]), uri) == batch + 1
        store.fold(spark, uri)
        sizes.append(len(store.manifest(spark, uri).layers))
    assert {row[:2]: row[2] for row in values(store.read_store(spark, uri))} == wanted
    assert max(sizes) <= 4
    now = store.manifest(spark, uri)
    assert not store.layers_due(now.layers)
    assert stored_rows((uri, now)) <= 2 * len(wanted)
    assert [layer.first for layer in now.layers][0] == 1 and now.layers[-1].last == 20


def layer(size):
    return store.Layer("x", 1, 1, 1, size)


@pytest.mark.parametrize(
    "sizes, due",
    [([], 0), ([9], 0), ([1, 1], 2), ([100, 1], 0), ([100, 1, 1], 2), ([100, 20, 6], 3), ([100, 20, 4], 0), ([100, 10, 10, 5], 4)],
)
def test_layers_are_folded_once_the_later_ones_have_a_quarter_of_them(sizes, due):
    assert len(store.layers_due([layer(size) for size in sizes])) == due


def test_a_reader_keeps_to_its_manifest(spark, tmp_path):
    uri = str(tmp_path)
    store.append_batch(cells(spark, [("a", "x", "1"), ("b", "x", "1")]), uri)
    before = store.read_store(spark, uri)
    store.append_batch(cells(spark, [("a", "x", "2")]), uri)
    assert store.fold(spark, uri)
    assert sorted(values(before)) == [("a", "x", "1"), ("b", "x", "1")]
    assert sorted(values(store.read_store(spark, uri))) == [("a", "x", "2"), ("b", "x", "1")]
    assert sorted(values(store.read_store(spark, uri, version=2))) == [("a", "x", "2"), ("b", "x", "1")]
    assert values(store.read_store(spark, uri, version=1).where("key = 'a'")) == [("a", "x", "1")]
    with pytest.raises(FileNotFoundError):
        store.read_store(spark, uri, version=9)


def test_a_fold_that_dies_loses_nothing(spark, tmp_path, monkeypatch):
    uri = str(tmp_path)
    for value in "12":
        store.append_batch(cells(spark, [("a", "x", value)]), uri)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(storage, "publish_text", killed)
    with pytest.raises(KeyboardInterrupt):
        store.fold(spark, uri)
    monkeypatch.undo()
    assert values(store.read_store(spark, uri)) == [("a", "x", "2")]
    assert len(list(tmp_path.glob("layer=*"))) == 3
    assert store.vacuum(spark, uri) == 0  # as its writer might still be at work
    assert store.vacuum(spark, uri, min_age_s=-60) == 1
    assert store.fold(spark, uri)
    assert values(store.read_store(spark, uri)) == [("a", "x", "2")]


def test_a_fold_gives_up_if_a_layer_was_replaced_meanwhile(spark, tmp_path, monkeypatch):
    uri = str(tmp_path)
    for value in "12":
        store.append_batch(cells(spark, [("a", "x", value)]), uri, int(value))
    write = store._write

    def overtaken(folded, where, buckets):
        monkeypatch.setattr(store, "_write", write)
        store.append_batch(cells(spark, [("a", "x", "again")]), uri, 2)
        return write(folded, where, buckets)

    monkeypatch.setattr(store, "_write", overtaken)
    assert not store.fold(spark, uri)
    assert values(store.read_store(spark, uri)) == [("a", "x", "again")]


def test_batches_that_arrive_during_a_fold_stay(spark, tmp_path, monkeypatch):
    uri = str(tmp_path)
    for value in "12":
        store.append_batch(cells(spark, [("a", "x", value)]), uri)
    write = store._write

    def overtaken(folded, where, buckets):
        monkeypatch.setattr(store, "_write", write)
        store.append_batch(cells(spark, [("a", "x", "3")]), uri)
        return write(folded, where, buckets)

    monkeypatch.setattr(store, "_write", overtaken)
    assert store.fold(spark, uri)
    assert [(at.first, at.last) for at in store.manifest(spark, uri).layers] == [(1, 2), (3, 3)]
    assert values(store.read_store(spark, uri)) == [("a", "x", "3")]


def test_writers_at_once_never_share_a_batch(spark, tmp_path):
    uri, numbers, errors = str(tmp_path), [], []

    def write(name):
        try:
            for _ in range(3):
                numbers.append(store.append_batch(cells(spark, [("k", name, "v")]), uri))
        except Exception as error:  # a thread's own error would be lost
            errors.append(error)

    threads = [threading.Thread(target=write, args=(f"w{i}",)) for i in range(5)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not errors
    assert sorted(numbers) == list(range(1, 16))
    assert store.manifest(spark, uri).version == 15
    assert sorted(values(store.read_store(spark, uri).select("field"))) == [(f"w{i}",) for i in range(5)]


def test_one_name_is_published_once(spark, tmp_path):
    uri = f"{tmp_path}/folder/1.json"
    assert storage.publish_text(spark, uri, "é one")
    assert not storage.publish_text(spark, uri, "two")
    assert storage.read_text(spark, uri) == "é one"
    assert [p.name for p in (tmp_path / "folder").iterdir()] == ["1.json"]


def test_a_folded_batch_cannot_be_run_again(spark, tmp_path):
    uri = str(tmp_path)
    for number in (1, 2):
        store.append_batch(cells(spark, [("a", "x", "1")]), uri, number)
    assert store.fold(spark, uri)
    with pytest.raises(ValueError, match="folded"):
        store.append_batch(cells(spark, [("a", "x", "2")]), uri, 2)
    assert store.append_batch(cells(spark, [("a", "x", "3")]), uri, 3) == 3


def test_one_key_reads_its_bucket_only(spark, tmp_path, monkeypatch):
    uri = str(tmp_path)
    monkeypatch.setattr(store, "BUCKET_BYTES", 1_000)
    rows = [(f"k{i}", "x", "é" * 50) for i in range(400)]
    store.append_batch(cells(spark, rows[:200]), uri)
    store.append_batch(cells(spark, rows[200:]), uri)
    assert store.fold(spark, uri)
    (folded,) = store.manifest(spark, uri).layers
    assert folded.buckets >= 4
    one = store.read_store(spark, uri, "k7")
    assert values(one) == [("k7", "x", "é" * 50)]
    scans = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scans and "bucket" in scans.split("PartitionFilters")[1].split("]")[0]
    assert len(one.inputFiles()) >= 1
    assert sorted(values(store.read_store(spark, uri))) == sorted(rows)


def test_empty_batches_and_missing_stores(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        hashes.read_store(spark, str(tmp_path))
    uri = str(tmp_path / "one")
    assert store.append_batch(cells(spark, []), uri) == 1
    assert values(hashes.read_store(spark, uri)) == []
    store.append_batch(cells(spark, [("a", "x", "1")]), uri)
    store.fold(spark, uri)
    assert values(hashes.read_store(spark, uri)) == [("a", "x", "1")]


def test_batches_of_the_earlier_layout_are_not_passed_over(spark, tmp_path):
    cells(spark, [("a", "x", "1")]).write.parquet(f"{tmp_path}/batch=1")
    for use in (lambda: hashes.read_store(spark, str(tmp_path)), lambda: hashes.append_batch(cells(spark, []), str(tmp_path))):
        with pytest.raises(ValueError, match="without a manifest"):
            use()
