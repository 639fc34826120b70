"""Copies of a result on several file systems that change together.

Every copy of a version is written to a folder of its own first. Then one
manifest, at the first copy, names the new version, and that is what all readers
go by: no reader finds one copy new and another one old. If a copy can't be
written, no manifest is, and all readers stay with the old version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from spindlewatch import storage

VERSIONS = "_versions"
ATTEMPTS = 100


def publish_copies(df: DataFrame, uris: Sequence[str], single_file: bool = False) -> int:
    """Write CSV with a header to a new version below every URI and publish it. Returns the version's number.

    The result is computed once. The first URI is the lead, which holds the manifests.
    """
    if not uris:
        raise ValueError("no URI to write to")
    spark, folder = df.sparkSession, f"version={uuid.uuid4().hex}"
    keep = len(uris) > 1 and not df.is_cached
    if keep:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for uri in uris:
            part = df.coalesce(1) if single_file else df
            part.write.option("header", True).csv(f"{uri.rstrip('/')}/{folder}")
    finally:
        if keep:
            df.unpersist()
    missing = [uri for uri in uris if not storage.committed(spark, f"{uri.rstrip('/')}/{folder}")]
    if missing:
        raise RuntimeError(f"copies without a commit marker: {missing}")
    text = json.dumps({"folder": folder, "copies": list(uris)})
    for _ in range(ATTEMPTS):
        number = newest_version(spark, uris[0]) + 1
        if storage.publish_text(spark, _manifest(uris[0], number), text):
            return number
    raise RuntimeError(f"{uris[0]} changed {ATTEMPTS} times while a version was published")


def newest_version(spark: SparkSession, lead: str) -> int:
    """Number of the newest version, 0 if there is none."""
    names = storage.children(spark, f"{lead.rstrip('/')}/{VERSIONS}")
    return max((int(name.removesuffix(".json")) for name in names if name.endswith(".json")), default=0)


def published_folder(spark: SparkSession, lead: str, copy: str | None = None, version: int | None = None) -> str:
    """Folder of a version in a copy: the newest one of the lead's own, unless others are asked for."""
    number = newest_version(spark, lead) if version is None else version
    if not number:
        raise FileNotFoundError(f"nothing is published at {lead}")
    known = json.loads(storage.read_text(spark, _manifest(lead, number)))
    if copy is not None and copy not in known["copies"]:
        raise ValueError(f"version {number} of {lead} has no copy at {copy}")
    return f"{(copy or lead).rstrip('/')}/{known['folder']}"


def _manifest(lead: str, number: int) -> str:
    return f"{lead.rstrip('/')}/{VERSIONS}/{number:012d}.json"
