"""Pieces that several operators share: tables, folds, kept intermediate tables, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch.storage import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared checkpoint folder and read back.

    This cuts the lineage: a lost executor costs no more than the tasks it ran,
    and a table that several plans read is computed once.
    """
    uri = scratch_folder(df.sparkSession, name)
    df.write.parquet(uri)
    return df.sparkSession.read.schema(df.schema).parquet(uri)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id falls in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(folds)), F.lit(0)).cast("int")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; null is empty."""
    return [value or b"" for value in batch.column(column).cast(pa.binary()).to_pylist()]


def small(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, one row at least, which bounds a task's memory."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        for low, high in slices(sizes, most):
            yield batch.slice(low, high - low)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges [from, to) of consecutive items with at most ``most`` in sum, one item at least."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def plain_uri(uri: str) -> str:
    """``file:/x`` as ``file:///x``, and a bare path as well, which is the form that all file systems take."""
    if uri.startswith("/"):
        return f"file://{uri}"
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b): the smallest node that each linked node reaches.

    Alternates large stars and small stars: every node hands its neighbours to
    the smallest node it knows, until nothing changes. A step is an aggregate
    of minima, combined before its shuffle, and an equi join that run-time skew
    handling can split, so no neighbour list is ever gathered. The number of
    steps grows with the logarithm of the longest chain.
    """
    edges = keep(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # The node itself stays linked with its minimum through its larger neighbours.
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = keep(small.where("u <> v").distinct(), "stars")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = now
