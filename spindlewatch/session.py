"""Session settings the reports are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

from spindlewatch import storage

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    # Hot keys: the row-level joins rely on runtime splitting of skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

MIB = 1 << 20
GIB = 1 << 30


def build_session(app_name: str, **settings: str) -> SparkSession:
    """A session with the defaults above; ``settings`` win, the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def sizes_for(input_bytes: int) -> dict[str, str]:
    """Scan split and shuffle partition settings for an input of this size.

    A shuffle writes one block per pair of map and reduce task, so both counts
    are bounded: larger splits from about 12 TiB on, and at most 40,000 reduce
    tasks. Below that a reduce task gets the narrow rows of 1 GiB of input.
    Small inputs keep 200, which runtime coalescing lowers further.
    """
    split = min(max(input_bytes // 100_000, 128 * MIB), GIB)
    partitions = min(max(-(-input_bytes // GIB), 200), 40_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
    }


def size_session(spark: SparkSession, uri: str) -> None:
    """Apply ``sizes_for`` the data at ``uri``, except to settings given at submission."""
    given = spark.sparkContext.getConf()
    for name, value in sizes_for(storage.size_of(spark, uri)).items():
        if not given.contains(name):
            spark.conf.set(name, value)
