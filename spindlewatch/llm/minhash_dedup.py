"""Near duplicates by MinHash with tensored banding.

Two small collections of hashed row groups replace many independent bands: each
text gets ``half_keys`` keys from collection A and as many from collection B, and
every pair (one of A, one of B) is a table key. 2 * 16 * 4 minima give 256 tables
of 8 rows, which independent bands would need 2,048 minima for. A pair of texts
meets in some table if it agrees on any key of A and any key of B. That fails for
one pair in 70,000 at similarity 0.85 and for one in 2,400 at 0.8.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.common import components, keep, query, slices, small, table, texts_of
from spindlewatch.llm.hashing import Words, mix, sequences

SLICE_BYTES = 1 << 20


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted 64-bit hashes of each text's distinct word shingles.

    A-Z are lower-cased. A text with fewer words than ``size`` has its whole
    word sequence as its only shingle, one without words has none.
    """
    out: list[np.ndarray] = []
    for low, high in slices([len(t) for t in texts], SLICE_BYTES):
        words = Words(texts[low:high], lower=True)
        hashed = words.hashes()
        runs = sequences(hashed, size)
        for first, count in zip(words.first, words.count):
            if count >= size:
                out.append(np.unique(runs[first : first + count - size + 1]))
            else:
                whole = sequences(hashed[first : first + count], int(count))[:1] if count else hashed[:0]
                out.append(mix(whole + np.uint64(count)) if count else whole)
    return out


def half_keys(sets: list[np.ndarray], keys: int, rows: int, seeds: np.ndarray) -> np.ndarray:
    """Keys of both collections, A then B, of each non-empty set; each hashes ``rows`` minima and its own number."""
    parts = []
    for low, high in slices([len(s) for s in sets], 1 << 15):  # stays in the processor's cache
        shingles = np.concatenate(sets[low:high])
        first = np.cumsum([0, *(len(s) for s in sets[low : high - 1])])
        minima = np.empty((high - low, len(seeds)), np.uint64)
        for i, seed in enumerate(seeds):
            # Odd multiples permute 64-bit values; the shingle hashes are mixed already.
            minima[:, i] = np.minimum.reduceat(shingles * seed ^ (seed >> np.uint64(17)), first)
        grouped = minima.reshape(high - low, 2 * keys, rows)
        hashed = np.broadcast_to(np.arange(2 * keys, dtype=np.uint64), grouped.shape[:2])
        for row in range(rows):
            hashed = mix(hashed * np.uint64(3) + grouped[:, :, row])
        parts.append(hashed)
    return np.concatenate(parts) if parts else np.zeros((0, 2 * keys), np.uint64)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    percent: int = 85,
    keys: int = 16,
    rows: int = 4,
) -> DataFrame:
    """One row per row of ``docs``: ``id_column``, ``n_shingles``, ``component_id``, ``kept``.

    Texts are linked if the Jaccard similarity of their shingle sets is at least
    ``percent`` / 100; ``component_id`` is the smallest id that links reach.

    1. A pass over the texts gives set size, digest and half keys of each. Texts
       with equal sets are one class from here on, with its smallest id.
    2. Half keys that only one class has can't form a shared table key and are
       dropped, so most texts form no table key at all.
    3. Shingles that only one class in the tables has are private to it, the
       rest are its core. Two texts share no more than the smaller core, which
       rules out, without looking at pairs, classes with many words of their own.
    4. In each table every class is compared on the full sets with the class
       that has the fewest private shingles. Classes that the links found so far
       leave in different components but in one table are then compared pair by
       pair, so no candidate link is lost and a group of copies isn't expanded.

    Null or empty texts and texts without words have no shingles and are their
    own component. Rows with a null id are returned with a null component and
    ``kept`` true; they take part in nothing. A row repeated with its id is
    returned as often.
    """
    spark = docs.sparkSession
    rows_in = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    sketched = keep(rows_in.mapInArrow(_sketcher(shingle, keys, rows), "id long, n long, digest binary, half array<long>"), "sketches")
    classes = keep(
        sketched.where("id is not null and n > 0")
        .groupBy("digest")
        .agg(F.min(F.struct("id", "n", "half")).alias("c"), F.count("*").alias("copies"))
        .select("digest", "c.*"),
        "classes",
    )
    single = classes.select("id", F.posexplode("half").alias("no", "half"))
    # Tables of keys are kept, because Spark splits a hot key of a join only if no aggregate shares its stage.
    shared = keep(single.groupBy("half").agg(F.count("*").alias("texts")).where("texts > 1").select("half"), "shared")
    place = F.struct("no", "half")
    sides = single.join(shared, "half").groupBy("id").agg(
        F.collect_list(F.when(F.col("no") < keys, place)).alias("in_a"),
        F.collect_list(F.when(F.col("no") >= keys, place)).alias("in_b"),
    )
    crossed = sides.select("id", F.explode("in_a").alias("x"), "in_b").select("id", "x", F.explode("in_b").alias("y"))
    members = keep(
        crossed.select(F.xxhash64("x.half", "y.half").alias("bucket"), "id", F.col("x.no").alias("i"), F.col("y.no").alias("j")),
        "members",
    )

    several = members.groupBy("bucket").agg(F.count("*").alias("texts")).where("texts > 1").select("bucket")
    tables = keep(members.join(keep(several, "several"), "bucket"), "tables")
    sets = keep(
        rows_in.join(tables.select("id").distinct(), "id")
        .dropDuplicates(["id"])
        .mapInArrow(_shingler(shingle), "id long, shingles array<long>"),
        "sets",
    )
    private = (
        sets.select("id", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("texts"), F.min("id").alias("id"))
        .where("texts = 1")
        .groupBy("id")
        .agg(F.count("*").cast("int").alias("private"))
    )
    size = F.size("shingles")
    facts = keep(
        sets.select("id", size.alias("n")).join(private, "id", "left").select("id", "n", (F.col("n") - F.coalesce("private", F.lit(0))).alias("core")),
        "facts",
    )
    sized = keep(tables.join(facts, "id"), "sized")
    least = keep(sized.groupBy("bucket").agg(F.min("n").alias("least")), "least")
    # The best partner there can be has the size of the core, or the least size in the table.
    able = F.col("core") * 100 >= (F.col("n") + F.greatest("core", "least") - F.col("core")) * percent
    fit = keep(sized.join(least, "bucket").where(able).select("bucket", "i", "j", "id", "n", "core"), "fit")
    hubs = keep(
        fit.groupBy("bucket")
        .agg(F.min(F.struct((F.col("n") - F.col("core")).alias("private"), "id", "n", "core")).alias("h"), F.count("*").alias("texts"))
        .where("texts > 1")
        .select("bucket", F.col("h.id").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.core").alias("hub_core")),
        "hubs",
    )
    starred = fit.join(hubs, "bucket").where("id <> hub").where(_may_link("n", "core", "hub_n", "hub_core", percent))
    first = keep(starred.select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct(), "first")
    links = keep(_linked(first, sets, percent), "near")
    found = keep(components(links), "found")

    labelled = keep(
        fit.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")),
        "labelled",
    )
    mixed = keep(
        labelled.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("bucket"),
        "mixed",
    )
    split = keep(labelled.join(mixed, "bucket").join(classes.select("id", "half"), "id"), "split")
    left = split.select("bucket", "i", "j", F.col("id").alias("a"), "component", "n", "core", "half")
    right = split.select(
        "bucket",
        F.col("id").alias("b"),
        F.col("component").alias("other"),
        F.col("n").alias("n_b"),
        F.col("core").alias("core_b"),
        F.col("half").alias("half_b"),
    )
    apart = (F.col("a") < F.col("b")) & (F.col("component") != F.col("other")) & _may_link("n", "core", "n_b", "core_b", percent)
    # A pair comes from the first of its tables only.
    earlier_a = F.expr("exists(zip_with(slice(half, 1, i), slice(half_b, 1, i), (x, y) -> x = y), e -> e)")
    earlier_b = F.expr(
        f"exists(zip_with(slice(half, {keys + 1}, j - {keys}), slice(half_b, {keys + 1}, j - {keys}), (x, y) -> x = y), e -> e)"
    )
    second = left.join(right, "bucket").where(apart & ~earlier_a & ~earlier_b).select("a", "b").join(first, ["a", "b"], "left_anti")
    joined = keep(components(links.unionByName(_linked(second, sets, percent))), "components")

    named = (
        classes.select("digest", "id")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select("digest", F.coalesce("component", "id").alias("component"))
    )
    return (
        sketched.select("id", "n", "digest")
        .join(named, "digest", "left")
        .select(
            F.col("id").alias(id_column),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
            (F.col("id").isNull() | (F.col("id") == F.coalesce("component", "id"))).alias("kept"),
        )
    )


def _sketcher(shingle: int, keys: int, rows: int):
    def run(batches):
        seeds = np.random.default_rng(11).integers(1, 1 << 63, 2 * keys * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in small(batches):
            found = shingle_sets(texts_of(batch), shingle)
            sizes = [len(s) for s in found]
            digests = [hashlib.blake2b(s, digest_size=16).digest() for s in found]
            own = iter(half_keys([s for s in found if len(s)], keys, rows, seeds).view(np.int64))
            halves = [next(own) if n else np.zeros(0, np.int64) for n in sizes]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(halves, pa.list_(pa.int64())),
                ],
                ["id", "n", "digest", "half"],
            )

    return run


def _shingler(shingle: int):
    def run(batches):
        for batch in small(batches):
            found = [s.view(np.int64) for s in shingle_sets(texts_of(batch), shingle)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.int64()))], ["id", "shingles"])

    return run


def _may_link(n: str, core: str, other_n: str, other_core: str, percent: int) -> Column:
    """False only for pairs that can't be links: what both may share is in the core of either."""
    most = F.least(core, other_core)
    return most * 100 >= (F.col(n) + F.col(other_n) - most) * percent


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("in_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("in_b"))
    both = F.size(F.array_intersect("in_a", "in_b"))
    union = F.size("in_a") + F.size("in_b") - both
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= union * percent).select("a", "b")


@query
def op5_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))
