"""The newest rows of every key so far, kept up by merging deliveries.

The state is a table bucketed by key: the newest rows of each key, and whether
it ever failed. A merge reduces the delivery to its own newest rows and facts and
brings only those to the state's buckets; the state is neither shuffled nor
sorted, and the history isn't read again. A version of the state appears whole,
by a manifest that only one of two writers can publish.

A hot key has many rows in the history but few at its newest instant, so buckets
stay even where the history's would not.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch import storage
from spindlewatch.operators.latest import newest_with_facts

VERSIONS = "_versions"
EVER = "_ever_failed"


def merge_newest(
    delivery: DataFrame,
    uri: str,
    key: str = "serial_number",
    instant: str = "data",
    failure: str = "failure",
    buckets: int | None = None,
) -> int:
    """Merge rows into the state at ``uri`` and return the number of its new version.

    Rows of a key at one instant come in one delivery; if they come again, they
    replace those that are there. So the state equals that of all deliveries in
    one table, in whatever order they come, and merging one again changes
    nothing. Rows without a key are dropped. Of a key without a dated row only
    the fact that it failed is kept. There are as many buckets as shuffle
    partitions unless ``buckets`` says otherwise; with fewer, Spark shuffles the state after all.
    """
    spark = delivery.sparkSession
    rows = delivery.where(F.col(key).isNotNull())
    facts = rows.groupBy(F.col(key).alias("_key")).agg(
        F.max(instant).alias("_max"), F.coalesce(F.bool_or(F.col(failure) == 1), F.lit(False)).alias("_failed")
    )
    dated = newest_with_facts(rows, key, instant, {EVER: F.coalesce(F.bool_or(F.col(failure) == 1), F.lit(False))})
    dated = dated.select(*delivery.columns, EVER)
    unknown = [F.col("_key").alias(c) if c == key else F.lit(None).cast(delivery.schema[c].dataType).alias(c) for c in delivery.columns]
    undated = facts.where("_max IS NULL AND _failed").select(*unknown, F.lit(True).alias(EVER))
    version = newest_state(spark, uri)
    whole = dated.unionByName(undated)
    if version:
        old = _state(spark, uri, version, key)
        # Joins by the bucketed column alone, so the state stays where it is.
        met = old.join(facts, F.col(key) == F.col("_key"), "left")
        stays = F.col("_max").isNull() | (F.col(instant) > F.col("_max"))
        known = old.groupBy(F.col(key).alias("_key")).agg(F.max(instant).alias("_max"), F.bool_or(EVER).alias("_failed"))
        fresh = whole.join(known, F.col(key) == F.col("_key"), "left")
        comes = F.col("_key").isNull() | (F.col("_max").isNull() & F.col(instant).isNotNull()) | (F.col(instant) >= F.col("_max"))
        ever = F.col(EVER) | F.coalesce("_failed", F.lit(False))
        both = [part.withColumn(EVER, ever).select(*delivery.columns, EVER) for part in (met.where(stays), fresh.where(comes))]
        whole = both[0].unionByName(both[1])
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _publish(whole, uri, version + 1, key, buckets)


def read_newest(
    spark: SparkSession, uri: str, key: str = "serial_number", instant: str = "data", failure: str = "failure"
) -> DataFrame:
    """Rows at the newest instant of their key, with failure 1 if the key ever failed: a scan, without a shuffle."""
    version = newest_state(spark, uri)
    if not version:
        raise FileNotFoundError(f"no state at {uri}")
    state = _state(spark, uri, version, key).where(F.col(instant).isNotNull())
    return state.withColumn(failure, F.when(F.col(EVER), F.lit(1)).otherwise(F.col(failure))).drop(EVER)


def newest_state(spark: SparkSession, uri: str) -> int:
    """Number of the newest version, 0 if there is none."""
    names = storage.children(spark, f"{uri.rstrip('/')}/{VERSIONS}")
    return max((int(name.removesuffix(".json")) for name in names if name.endswith(".json")), default=0)


def vacuum_newest(spark: SparkSession, uri: str, versions: int = 2, min_age_s: float = 86_400) -> int:
    """Remove states that none of the newest ``versions`` manifests names, with their tables. Returns how many.

    A state younger than ``min_age_s`` stays, as its merge may not have
    published it yet. Manifests stay: a slow merge must find the number of its
    version taken. Readers of a state that is removed fail.
    """
    uri, newest = uri.rstrip("/"), newest_state(spark, uri)
    before = (time.time() - min_age_s) * 1000
    named = {
        f"state={json.loads(storage.read_text(spark, _manifest(uri, version)))['folder']}"
        for version in range(max(1, newest - max(1, versions) + 1), newest + 1)
    }
    gone = [
        name
        for name in storage.children(spark, uri)
        if name.startswith("state=") and name not in named and storage.changed_at(spark, f"{uri}/{name}") <= before
    ]
    for name in gone:
        spark.sql(f"DROP TABLE IF EXISTS newest_{name.removeprefix('state=')}")
        storage.remove(spark, f"{uri}/{name}")
    return len(gone)


def _publish(rows: DataFrame, uri: str, version: int, key: str, buckets: int) -> int:
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    # One task for each bucket: it is at most one file, and a bucketed scan reads it in one task.
    placed = rows.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).sortBy(key).option("path", _folder(uri, folder)).saveAsTable(f"newest_{folder}")
    known = json.dumps({"folder": folder, "schema": schema, "buckets": buckets})
    if not storage.publish_text(spark, _manifest(uri, version), known):
        raise RuntimeError(f"version {version} of {uri} was published by another writer; merge again")
    return version


def _state(spark: SparkSession, uri: str, version: int, key: str) -> DataFrame:
    known = json.loads(storage.read_text(spark, _manifest(uri, version)))
    name = f"newest_{known['folder']}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({known['schema']}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {known['buckets']} BUCKETS LOCATION '{_folder(uri, known['folder'])}'"
    )
    return spark.table(name)


def _folder(uri: str, folder: str) -> str:
    return f"{uri.rstrip('/')}/state={folder}"


def _manifest(uri: str, version: int) -> str:
    return f"{uri.rstrip('/')}/{VERSIONS}/{version:012d}.json"
