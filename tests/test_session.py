from __future__ import annotations

import pytest

from spindlewatch.session import GIB, MIB, size_session, sizes_for
from spindlewatch.storage import size_of

TIB = 1 << 40


@pytest.mark.parametrize(
    "input_bytes, split, partitions",
    [(0, 128 * MIB, 200), (TIB, 128 * MIB, 1024), (100 * TIB, GIB, 40_000), (10_000 * TIB, GIB, 40_000)],
)
def test_sizes_are_bounded(input_bytes, split, partitions):
    assert list(sizes_for(input_bytes).values()) == [str(split), str(partitions)]


def test_shuffle_blocks_stay_bounded():
    for tebibytes in (1, 10, 50, 100, 200):
        sizes = sizes_for(tebibytes * TIB)
        maps = tebibytes * TIB / int(sizes["spark.sql.files.maxPartitionBytes"])
        assert maps <= 210_000


def test_submitted_settings_stay(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"x" * 10)
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "b").write_bytes(b"x" * 5)
    assert size_of(spark, str(tmp_path)) == 15
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        size_session(spark, str(tmp_path))
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 * MIB)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
