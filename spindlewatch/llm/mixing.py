"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Token counts of (source, language, topic) cells are raked until their totals by
source, by language and by topic meet their targets. Documents are then drawn
with a probability of their cell, scaled so that the expected number of tokens
is a given share of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import keep, query, table

DIMENSIONS = ("source_cell", "lang_cell", "topic_cell")
# Targets are proportional to these powers of the token counts: 0 is the same share for all, 1 leaves them.
POWERS = {"source_cell": 0.5, "lang_cell": 0.7, "topic_cell": 0.8}
ROUNDS = 8
TOKEN_SHARE = 0.6
SEED = "mix-1"
BROADCAST_CELLS = 100_000  # most cells that are broadcast to the documents; more are joined by a shuffle


def n_tokens(text: str = "text") -> Column:
    """Words of the whole text: runs of bytes other than space and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: str = "text") -> Column:
    """A topic by form: tables, marked-up symbols, shouting, lists of lines or prose."""
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda kept: F.length(F.translate(text, kept, "")) / size
    return (
        F.when(F.col(text).isNull() | (F.length(text) == 0), "empty")
        .when(share("|") < 0.98, "table")
        .when(share("#$%&*{}<>=;@") < 0.95, "symbols")
        .when(share("ABCDEFGHIJKLMNOPQRSTUVWXYZ") < 0.7, "shouting")
        .when(share("\n") < 0.98, "lines")
        .otherwise("prose")
    )


def rake(cells: DataFrame, powers: dict[str, float] = POWERS, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` with ``tokens`` and, in ``weight``, the raked token counts; their sum is that of ``tokens``.

    A cell table has a row for each combination of values that occurs: it grows
    with the number of sources and not with that of documents, so windows over it
    are small. Cells without tokens keep weight 0.
    """
    everything = Window.partitionBy(F.lit(0))
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for name in powers:
        out = out.withColumn(f"m_{name}", F.sum(F.col("tokens").cast("double")).over(Window.partitionBy(name)))
        first = F.row_number().over(Window.partitionBy(name).orderBy(*DIMENSIONS)) == 1
        out = out.withColumn(f"f_{name}", F.when(first & (F.col(f"m_{name}") > 0), F.pow(f"m_{name}", F.lit(powers[name]))).otherwise(0.0))
    total = F.sum(F.col("tokens").cast("double")).over(everything)
    out = out.select("*", total.alias("total"), *[F.sum(f"f_{n}").over(everything).alias(f"s_{n}") for n in powers])
    out = out.withColumns({f"t_{n}": F.when(F.col(f"m_{n}") > 0, F.pow(f"m_{n}", F.lit(powers[n])) * F.col("total") / F.col(f"s_{n}")).otherwise(0.0) for n in powers})
    for _ in range(rounds):
        for name in powers:
            now = F.sum("weight").over(Window.partitionBy(name))
            out = out.withColumn("weight", F.when(F.col("weight") > 0, F.col("weight") * F.col(f"t_{name}") / now).otherwise(0.0))
    return out.select(*cells.columns, "weight")


def targets_of(cells: DataFrame, shares: dict[str, dict[str, float]]) -> DataFrame:
    """(dimension, value, target): tokens each value should have, from shares of one per dimension.

    A value of the cells that no share names has the share 0. Values that the
    cells don't have are listed too, as they can't be met.
    """
    total = cells.agg(F.sum("tokens").cast("double").alias("total"))
    rows = [(name, value, float(share)) for name, own in shares.items() for value, share in own.items()]
    for name, own in shares.items():
        if name not in DIMENSIONS or min(own.values(), default=0) < 0 or abs(sum(own.values()) - 1) > 1e-6:
            raise ValueError(f"shares of {name} have to be of a known dimension, not negative, and add up to 1")
    given = cells.sparkSession.createDataFrame(rows, "dimension string, value string, share double")
    found = None
    for name in shares:
        values = cells.groupBy(F.lit(name).alias("dimension"), F.col(name).alias("value")).agg(F.sum("tokens").alias("tokens"))
        found = values if found is None else found.unionByName(values)
    met = found.join(given, ["dimension", "value"], "full")
    known = met.withColumn("total", F.lit(total.first()["total"] or 0.0))
    return known.select("dimension", "value", (F.coalesce("share", F.lit(0.0)) * F.col("total")).alias("target"), F.coalesce("tokens", F.lit(0)).alias("tokens"))


def rake_to(
    cells: DataFrame, shares: dict[str, dict[str, float]], tolerance: float = 1e-3, most: int = 400
) -> tuple[DataFrame, DataFrame, float]:
    """Rakes ``cells`` to target shares of tokens by dimension and value until all are met within ``tolerance``.

    Returns the cells with ``weight``, a report (dimension, value, target,
    reached, error, possible), and the largest error. Errors are shares of all
    tokens. ``possible`` is false for a value with a target but without tokens;
    targets can also contradict each other, and then the error stays above the
    tolerance after ``most`` rounds. Nothing is raised: the caller decides by the error.
    """
    if not shares:
        raise ValueError("no targets")
    targets = keep(targets_of(cells, shares), "targets")
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    done, error, before = 0, float("inf"), float("inf")
    while True:
        report = _report(out, targets, shares)
        before, error = error, report.agg(F.max("error")).first()[0] or 0.0
        if error <= tolerance or done >= most or (done >= 64 and before - error < 1e-9):
            return out, report, float(error)
        for _ in range(8):
            for name in shares:
                own = targets.where(F.col("dimension") == name).select(F.col("value").alias("_value"), "target")
                now = F.sum("weight").over(Window.partitionBy(name))
                met = out.join(own, F.col(name) == F.col("_value"), "left")
                scaled = F.when(F.col("weight") > 0, F.col("weight") * F.col("target") / now).otherwise(0.0)
                out = met.withColumn("weight", scaled).select(*cells.columns, "weight")
        done += 8
        out = keep(out, "raked")


def _report(cells: DataFrame, targets: DataFrame, shares: dict[str, dict[str, float]]) -> DataFrame:
    reached = None
    for name in shares:
        values = cells.groupBy(F.lit(name).alias("dimension"), F.col(name).alias("value")).agg(F.sum("weight").alias("reached"))
        reached = values if reached is None else reached.unionByName(values)
    total = targets.groupBy("dimension").agg(F.sum("tokens").alias("_total"))
    joined = targets.join(reached, ["dimension", "value"], "left").join(total, "dimension")
    off = F.abs(F.coalesce("reached", F.lit(0.0)) - F.col("target")) / F.greatest(F.col("_total"), F.lit(1))
    possible = (F.col("target") == 0) | (F.col("tokens") > 0)
    return joined.select("dimension", "value", "target", F.coalesce("reached", F.lit(0.0)).alias("reached"), off.alias("error"), possible.alias("possible"))


def probabilities(raked: DataFrame, share: float = TOKEN_SHARE) -> DataFrame:
    """``raked`` with ``probability``: min(1, c * weight / tokens), c such that the expected tokens are that share.

    Cells are taken in falling order of weight per token; those that come before
    the rest can fill the budget are kept whole. Cells without tokens are kept.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("ratio"), *DIMENSIONS)
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    known = raked.withColumn("ratio", ratio).select(
        "*",
        F.coalesce(F.sum("tokens").over(upto), F.lit(0)).alias("before"),
        F.coalesce(F.sum("weight").over(upto), F.lit(0.0)).alias("w_before"),
        F.sum("tokens").over(everything).alias("all_tokens"),
        F.sum("weight").over(everything).alias("all_weight"),
    )
    left = F.col("all_weight") - F.col("w_before")
    scale = F.when(left > 0, (F.lit(share) * F.col("all_tokens") - F.col("before")) / left)
    # The first cell whose own probability would not pass 1 sets the scale.
    scaled = known.withColumn("scale", scale).withColumn("c", F.max(F.when(F.col("scale") * F.col("ratio") <= 1, F.col("scale"))).over(everything))
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("c") * F.col("ratio")))
    return scaled.select(*raked.columns, F.when(F.col("tokens") > 0, F.coalesce(bounded, F.lit(1.0))).otherwise(1.0).alias("probability"))


def draw(id_column: str = "doc_id", seed: str = SEED) -> Column:
    """A number in [0, 1) of the id and the seed, the same wherever it is computed."""
    text = F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(":" + seed))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mixed(docs: DataFrame, shares: dict[str, dict[str, float]] | None = None, tolerance: float = 1e-3) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the cell, ``n_tokens``, ``probability`` and ``kept``.

    Without ``shares`` the targets are ``POWERS`` of the table's own totals, raked
    ``ROUNDS`` times. With them, tokens are raked to those shares by dimension and
    value, and shares that can't be met within the tolerance are an error. Null sources and languages are cells of their own, named by empty text.
    Texts without words have no weight and are kept. Repeated rows and repeated
    ids are drawn alike. An empty table gives an empty result.
    """
    # The cell columns have names of their own, whatever else ``docs`` holds.
    # Kept, a few bytes a row, so that texts are measured once for both the cells and the draw.
    rows = keep(docs.select("doc_id", *_cell(), n_tokens().alias("n_tokens")), "measured")
    drawn = draw() < F.col("probability")
    return _with_probability(rows, shares, tolerance).select("doc_id", *DIMENSIONS, "n_tokens", "probability", drawn.alias("kept"))


def sample(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``mixed`` keeps, with their columns."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", *_cell(), n_tokens().alias("n_tokens"))
    return _with_probability(rows).where(draw() < F.col("probability")).select("row.*")


def _cell() -> list[Column]:
    known = [F.coalesce(name, F.lit("")).alias(f"{name}_cell") for name in ("source", "lang")]
    return [*known, topic().alias("topic_cell")]


def _with_probability(rows: DataFrame, shares: dict[str, dict[str, float]] | None = None, tolerance: float = 1e-3) -> DataFrame:
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))
    if shares is None:
        raked = rake(cells)
    else:
        raked, report, error = rake_to(keep(cells, "token-cells"), shares, tolerance)
        if error > tolerance:
            worst = report.orderBy(F.desc("error"), "dimension", "value").first()
            raise ValueError(f"target missed by {error:.4f} of all tokens: {worst}")
    chances = keep(probabilities(raked).select(*DIMENSIONS, F.round("probability", 6).alias("probability")), "cells")
    few = chances.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    return rows.join(F.broadcast(chances) if few else chances, list(DIMENSIONS))


@query
def op1_source_mixing(spark, sf_dir):
    return mixed(table(spark, sf_dir, "documents"))
