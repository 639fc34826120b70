"""Stored cells: batches as layers of one table, folded as they grow.

Every batch is written once, to a folder of its own, and never changed. A
manifest names the layers that make up the store, with the batches each one
holds; the next version of it appears whole, by a rename that no other writer
can have made, so two writers never take one version or one batch number.

Folding writes the current cells of some layers as one new layer, by buckets of
the key's hash, and swaps it for them in the next manifest. A layer is folded
with the later ones once they have a quarter of its bytes. So each layer stays
larger than four times all later ones together, and what is read stays below
4/3 of the live cells, however many batches there were; cells are never deleted,
so there are no markers to keep. A fold that dies leaves a folder that no
manifest names. A reader keeps to the manifest it started with.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch import storage
from spindlewatch.schema import CELLS

MANIFESTS = "_manifests"
RATIO = 4
BUCKET_BYTES = 128 << 20
ATTEMPTS = 100
LAYER_FIELDS = "key string, field string, value string, layer string, bucket int"


@dataclass(frozen=True)
class Layer:
    """A folder of cells of the batches ``first`` to ``last``, dealt over ``buckets``."""

    folder: str
    first: int
    last: int
    buckets: int
    size: int


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    layers: tuple[Layer, ...] = ()


def manifest(spark: SparkSession, uri: str, version: int | None = None) -> Manifest:
    """The newest manifest of the store at ``uri``, or an earlier version that was not removed yet."""
    found = [int(name.removesuffix(".json")) for name in storage.children(spark, f"{uri}/{MANIFESTS}") if name.endswith(".json")]
    if version is None:
        version = max(found, default=0)
    elif version not in found:
        raise FileNotFoundError(f"no version {version} of {uri}")
    if not version:
        if any(name.startswith("batch=") for name in storage.children(spark, uri)):
            raise ValueError(f"{uri} holds batches without a manifest; append them to a new store")
        return Manifest()
    text = storage.read_text(spark, _manifest_uri(uri, version))
    return Manifest(version, tuple(Layer(**layer) for layer in json.loads(text)["layers"]))


def current_cells(batches: DataFrame) -> DataFrame:
    """Cells after all batches: the last batch that set a field wins, other fields stay.

    Takes cells with a ``batch`` number. Grouping by key and field spreads even
    a single hash over all tasks, and running a batch again changes nothing.
    """
    newest = F.max_by("value", F.struct("batch", "value"))
    return batches.groupBy("key", "field").agg(newest.alias("value"))


def append_batch(cells: DataFrame, uri: str, batch: int | None = None) -> int:
    """Store one batch of cells in the store at ``uri`` and return its number.

    Without a number the batch follows the largest one stored, so nothing is
    lost; a rerun under an explicit number replaces that batch, unless it was
    folded with others by then, which is an error.
    """
    spark, uri = cells.sparkSession, uri.rstrip("/")
    written = _write(cells, uri, 1)

    def added(now: Manifest) -> list[Layer]:
        number = max((layer.last for layer in now.layers), default=0) + 1 if batch is None else batch
        if any(layer.first <= number <= layer.last and layer.first < layer.last for layer in now.layers):
            raise ValueError(f"batch {number} of {uri} is folded with others and can't be replaced")
        others = [layer for layer in now.layers if layer.last != number]
        return [*others, Layer(written, number, number, 1, storage.size_of(spark, _layer_uri(uri, written)))]

    layers = _commit(spark, uri, added)
    return next(layer.last for layer in layers if layer.folder == written)


def fold(spark: SparkSession, uri: str, ratio: int = RATIO) -> bool:
    """Fold the layers that are due. Returns whether the store changed.

    Batches that arrive meanwhile stay layers of their own. If another writer
    replaced or folded one of the same layers first, this fold is given up.
    """
    uri = uri.rstrip("/")
    now = manifest(spark, uri)
    due = layers_due(now.layers, ratio)
    if not due:
        return False
    size = sum(layer.size for layer in due)
    buckets = 1 << max(0, -(-size // BUCKET_BYTES) - 1).bit_length()
    written = _write(current_cells(_layer_cells(spark, uri, due)), uri, buckets)
    whole = Layer(written, due[0].first, due[-1].last, buckets, storage.size_of(spark, _layer_uri(uri, written)))

    def swapped(newest: Manifest) -> list[Layer] | None:
        if not set(due) <= set(newest.layers):
            return None
        return [layer for layer in newest.layers if layer not in due] + [whole]

    return _commit(spark, uri, swapped) is not None


def layers_due(layers: Sequence[Layer], ratio: int = RATIO) -> list[Layer]:
    """The layers from the first one that is at most ``ratio`` times as large as all later ones; none if there is no such layer."""
    for i, layer in enumerate(layers[:-1]):
        if layer.size <= ratio * sum(later.size for later in layers[i + 1 :]):
            return list(layers[i:])
    return []


def read_store(spark: SparkSession, uri: str, key: str | None = None, version: int | None = None) -> DataFrame:
    """Current cells of the store at ``uri``, or of all stores directly below it.

    The manifest is read now, so what is appended or folded later doesn't show.
    With ``key`` only that hash is returned, and only its bucket of each layer is read.
    """
    uri = uri.rstrip("/")
    if storage.exists(spark, f"{uri}/{MANIFESTS}"):
        stores = [uri]
    else:
        below = [f"{uri}/{name}" for name in storage.children(spark, uri)]
        stores = [store for store in below if storage.exists(spark, f"{store}/{MANIFESTS}")]
    if not stores:
        manifest(spark, uri)
        raise FileNotFoundError(f"no cell store at {uri}")
    cells = None
    for store in stores:
        found = _layer_cells(spark, store, manifest(spark, store, version).layers, key)
        cells = found if cells is None else cells.unionByName(found)
    return current_cells(cells)


def vacuum(spark: SparkSession, uri: str, versions: int = 10, min_age_s: float = 86_400) -> int:
    """Remove all but the newest ``versions`` manifests, and layers that none of them names. Returns the layers removed.

    A layer younger than ``min_age_s`` stays, as its writer may not have
    published it yet. Readers of versions that are removed may fail.
    """
    uri = uri.rstrip("/")
    newest = manifest(spark, uri).version
    before = time.time() * 1000 - min_age_s * 1000
    for version in range(newest - versions, 0, -1):
        if not storage.exists(spark, _manifest_uri(uri, version)):
            break
        storage.remove(spark, _manifest_uri(uri, version))
    named = set()
    for version in range(max(1, newest - versions + 1), newest + 1):
        named |= {f"layer={layer.folder}" for layer in manifest(spark, uri, version).layers}
    gone = [
        name
        for name in storage.children(spark, uri)
        if name.startswith("layer=") and name not in named and storage.changed_at(spark, f"{uri}/{name}") <= before
    ]
    for name in gone:
        storage.remove(spark, f"{uri}/{name}")
    return len(gone)


def _commit(spark: SparkSession, uri: str, change) -> list[Layer] | None:
    """Publish the next manifest with what ``change`` makes of the newest one; again if another writer was first.

    ``change`` may give up by returning None, and then nothing is published.
    """
    for _ in range(ATTEMPTS):
        newest = manifest(spark, uri)
        layers = change(newest)
        if layers is None:
            return None
        layers.sort(key=lambda layer: layer.last)
        text = json.dumps({"layers": [asdict(layer) for layer in layers]}, indent=1)
        if storage.publish_text(spark, _manifest_uri(uri, newest.version + 1), text):
            return layers
    raise RuntimeError(f"{uri} changed {ATTEMPTS} times while a manifest was written")


def _write(cells: DataFrame, uri: str, buckets: int) -> str:
    """Write a layer of cells; returns its folder's name. A bucket of any size is written by as many tasks as it needs."""
    name = uuid.uuid4().hex
    dealt = cells.select(*CELLS.fieldNames(), _bucket(F.col("key"), F.lit(buckets)).alias("bucket"))
    if buckets > 1:
        dealt = dealt.hint("rebalance", "bucket")
    dealt.sortWithinPartitions("bucket", "key").write.partitionBy("bucket").parquet(_layer_uri(uri, name))
    return name


def _layer_cells(spark: SparkSession, uri: str, layers: Sequence[Layer], key: str | None = None) -> DataFrame:
    """Cells of the layers with the last ``batch`` of their layer."""
    paths = [_layer_uri(uri, layer.folder) for layer in layers]
    read = spark.read.schema(LAYER_FIELDS).option("basePath", uri).parquet(*paths)
    if key is not None:
        buckets = _by_layer(layers, "buckets")
        read = read.where((F.col("bucket") == _bucket(F.lit(key), buckets)) & (F.col("key") == key))
    return read.select(*CELLS.fieldNames(), _by_layer(layers, "last").alias("batch"))


def _by_layer(layers: Sequence[Layer], name: str) -> Column:
    entries = [F.lit(x) for layer in layers for x in (layer.folder, getattr(layer, name))]
    return F.element_at(F.create_map(*entries), F.col("layer"))


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets).cast("int")


def _layer_uri(uri: str, folder: str) -> str:
    return f"{uri}/layer={folder}"


def _manifest_uri(uri: str, version: int) -> str:
    return f"{uri}/{MANIFESTS}/{version:012d}.json"
