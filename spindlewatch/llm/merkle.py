"""Merkle manifest of a dataset: a tree of digests per group, and a tree over the groups.

A level of an aligned block of ``BLOCK`` nodes is one string of concatenated hex
digests, kept as its ASCII bytes. Substrings of ``ARITY`` digests, hashed, make
the level above it, and what stands left and right of a node in its run are its
siblings. The top digests of the blocks are the nodes of the next, ``BLOCK``
times smaller table, until every group has one node. The groups' top digests go
through the same steps. Only built-in functions are used.

Places come from a range partitioned table, so no group, however large, is
sorted or numbered by one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import keep, query, table

ARITY = 3
DEPTH = 4  # levels above the nodes of a full block
BLOCK = ARITY**DEPTH
HEX = 64  # characters of a digest
SIBLINGS = "array<struct<before:binary,after:binary>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated bytes, as bytes, which are cut without decoding."""
    return F.sha2(F.concat(*[part.cast("binary") for part in parts]), 256).cast("binary")


def framed(value: Column) -> Column:
    """``-`` for null, else the count of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[framed(value) for value in values])


def parents(level: Column) -> Column:
    """The level above: one digest for every run of ``ARITY`` digests, the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.octet_length(level) - 1) / (ARITY * HEX)).cast("int"))
    hashed = F.transform(runs, lambda run: F.sha2(F.substring(level, run * (ARITY * HEX) + 1, F.lit(ARITY * HEX)), 256))
    return F.array_join(hashed, "").cast("binary")


def siblings(levels: Column, place: Column) -> Column:
    """What stands beside the node ``place`` of the lowest level, and beside its ancestors, below the top of the block."""

    def beside(level: Column, height: Column) -> Column:
        node = F.floor(place / F.element_at(F.array(*[F.lit(ARITY**h) for h in range(DEPTH + 1)]), height + 1)).cast("int")
        within = node % ARITY
        return F.struct(
            F.substring(level, (node - within) * HEX + 1, within * HEX).alias("before"),
            F.substring(level, (node + 1) * HEX + 1, (ARITY - 1 - within) * HEX).alias("after"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), beside)


def folded(start: Column, path: Column) -> Column:
    """The top digest from a node and all that stands beside its path, lowest first."""
    return F.aggregate(path, start, lambda node, side: digest(side["before"], node, side["after"]))


def numbered(nodes: DataFrame, *tie_break: str) -> DataFrame:
    """``pos``, the place from 0 in the order of the tie breaks within ``grp``, and ``n``, the size of the group.

    The table is range partitioned and sorted, so a row's place is its row
    number in its partition plus the sizes of the partitions before. The scan
    partition is the last key, which splits rows that are equal in all others.
    """
    order = [F.col("grp"), *[F.col(name) for name in tie_break], F.col("_scan")]
    ranged = nodes.withColumn("_scan", F.spark_partition_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    # Counts up within a partition and has the partition's number in its upper bits.
    placed = keep(ranged.drop("_scan").withColumn("_row", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_row", 33)
    runs = placed.groupBy(F.col("grp").alias("_grp"), part.alias("_part")).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_n")
    )
    upto = Window.partitionBy("_grp").orderBy("_part")
    sized = runs.select(
        "_grp",
        "_part",
        (F.sum("_n").over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n") - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("_grp")).alias("n"),
    )
    same = F.col("grp").eqNullSafe(F.col("_grp")) & (part == F.col("_part"))
    return placed.join(sized, same).withColumn("pos", F.col("_row") + F.col("_shift")).drop("_row", "_shift", "_grp", "_part")


def blocks(nodes: DataFrame) -> DataFrame:
    """One row per aligned block of ``nodes`` (grp, pos, n, node, tag): grp, n, block, tags, levels.

    ``levels`` holds the strings from the nodes up to the block's top digest. A
    block of a group with several blocks has all ``DEPTH`` levels above the
    nodes, as its group goes on; the only block of a group ends at one node.
    """
    members = F.array_sort(F.collect_list(F.struct("pos", "node", "tag")))
    grouped = nodes.groupBy("grp", "n", F.floor(F.col("pos") / BLOCK).alias("block")).agg(members.alias("m"))
    heights = F.lit(DEPTH)
    for height in reversed(range(DEPTH)):
        heights = F.when(F.col("n") <= ARITY**height, height).otherwise(heights)
    lowest = F.array_join(F.transform("m", lambda x: x["node"].cast("string")), "").cast("binary")
    grown = F.aggregate(
        F.slice(F.array(*[F.lit(h) for h in range(1, DEPTH + 1)]), F.lit(1), F.col("height")),
        F.array("lowest"),
        lambda levels, _: F.array_append(levels, parents(F.element_at(levels, -1))),
    )
    named = grouped.select("grp", "n", "block", F.transform("m", lambda x: x["tag"]).alias("tags"), lowest.alias("lowest"), heights.alias("height"))
    return named.select("grp", "n", "block", "tags", grown.alias("levels"))


def opened(tree: DataFrame, tag_to: str, *also: str) -> DataFrame:
    """The nodes of blocks again, each with the siblings up to the top of its block; other columns of a block by name."""
    each = F.transform(
        "tags",
        lambda tag, i: F.struct(
            tag.alias(tag_to),
            F.substring(F.col("levels")[0], i * HEX + 1, F.lit(HEX)).alias("node"),
            siblings(F.col("levels"), i).alias("beside"),
            (F.col("block") * BLOCK + i).alias("pos"),
            *[F.col(name) for name in also],
        ),
    )
    return tree.select("grp", F.explode(each).alias("x")).select("grp", "x.*")


@dataclass
class Trees:
    """Block tables from the nodes upwards, and each group's top digest."""

    levels: list[DataFrame]
    tops: DataFrame  # grp, top

    def paths(self, ends: DataFrame) -> DataFrame:
        """(grp, block, path) of the lowest blocks; ``ends`` has the path above each group's top digest (grp, path)."""
        known = ends.select("grp", F.lit(0).cast("long").alias("block"), "path")
        for tree in reversed(self.levels[1:]):
            above = known.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "path")
            here = tree.join(above, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block")))
            below = opened(here, "tag", "path")
            known = keep(below.select("grp", F.col("pos").alias("block"), F.concat("beside", "path").alias("path")), "paths")
        return known


def grow(nodes: DataFrame) -> Trees:
    """All levels over ``nodes`` (grp, pos, n, node, tag). The number of block tables is the logarithm of the largest group."""
    levels = []
    while True:
        levels.append(keep(blocks(nodes), "blocks"))
        top = levels[-1].select(
            "grp", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).alias("n"), F.element_at("levels", -1).alias("node")
        )
        if (top.agg(F.max("n")).first()[0] or 1) == 1:
            return Trees(levels, top.select("grp", F.col("node").alias("top")))
        nodes = top.withColumn("tag", F.lit(0))


def manifest(
    docs: DataFrame,
    id_column: str = "doc_id",
    group_column: str = "source",
    value_columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    tampered: dict[str, Column] | None = None,
    touched: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs``: its leaf, its group's ``subroot``, the ``root``, and its proof checked against the root.

    Columns: ``id_column``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (digest
    of all siblings from the leaf to the root), ``folded_root`` and ``verified``. Rows
    for which ``touched`` holds are folded from the leaf of their ``tampered`` values.

    Leaves follow each other by id, null first; rows with one id by their leaf
    digest, so repeated rows are nodes of their own side by side. A null group
    is a group and comes first. Null values are part of a leaf like any other.
    An empty table has no rows and no root. Columns that are not named are not
    looked at, and names that are used inside can't clash with them.
    """
    values = [F.col(name) for name in value_columns]
    changed = [(tampered or {}).get(name, F.col(name)) for name in value_columns]
    spoilt = F.when(F.coalesce(touched, F.lit(False)), leaf(*changed)) if touched is not None else F.lit(None).cast("binary")
    leaves = docs.select(
        F.col(group_column).alias("grp"), F.col(id_column).alias("id"), leaf(*values).alias("node"), spoilt.alias("spoilt")
    )
    # Kept, as a range partitioned table is read twice, and the texts should be read once.
    placed = numbered(keep(leaves, "leaves"), "id", "node").select("grp", "pos", "n", "node", F.struct("id", "spoilt").alias("tag"))
    rows = grow(placed)

    # The groups are the nodes of one more tree. Its group is a constant.
    tops = rows.tops.select(F.col("grp").alias("label"), F.col("top").alias("node"))
    numbered_tops = numbered(tops.withColumn("grp", F.lit(0)), "label")
    over = grow(numbered_tops.select("grp", "pos", "n", "node", F.struct("label").alias("tag")))
    last = over.tops.first()
    root = F.lit(bytes(last["top"]).decode() if last else "").cast("binary")
    lowest = over.paths(over.tops.select("grp", F.array().cast(SIBLINGS).alias("path")))
    above = lowest.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "path")
    by_label = opened(over.levels[0].join(above, (F.col("grp") == F.col("_grp")) & (F.col("block") == F.col("_block"))), "tag", "path")
    ends = keep(by_label.select("tag.label", F.col("node").alias("subroot"), F.concat("beside", "path").alias("path")), "subroots")

    paths = rows.paths(ends.select(F.col("label").alias("grp"), "path"))
    above = paths.select(F.col("grp").alias("_grp"), F.col("block").alias("_block"), "path")
    named = rows.levels[0].join(above, F.col("grp").eqNullSafe(F.col("_grp")) & (F.col("block") == F.col("_block")))
    named = named.drop("_grp", "_block").join(
        ends.select(F.col("label").alias("_grp"), "subroot"), F.col("grp").eqNullSafe(F.col("_grp"))
    )
    whole = opened(named, "tag", "path", "subroot").select(
        "tag", "node", "subroot", F.concat("beside", "path").alias("path"), root.alias("root")
    )
    around = F.flatten(F.transform("path", lambda side: F.array(side["before"].cast("string"), side["after"].cast("string"))))
    return whole.select(
        F.col("tag.id").alias(id_column),
        F.col("node").cast("string").alias("leaf"),
        F.col("subroot").cast("string").alias("subroot"),
        F.col("root").cast("string").alias("root"),
        F.sha2(F.array_join(around, "").cast("binary"), 256).alias("proof_sha256"),
        folded(F.coalesce("tag.spoilt", "node"), F.col("path")).cast("string").alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op12_merkle_manifest(spark, sf_dir):
    """Rows with an even checksum of their id are checked as if the line feeds of their text were lost."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(
        table(spark, sf_dir, "documents"), tampered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, touched=even
    )
