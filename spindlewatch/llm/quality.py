"""Quality by kernel ridge regression: random Fourier features of document statistics.

Cosines of random projections approximate a Gaussian kernel. Every partition adds
up its normal equations, a tree of sums joins them, and one small system gives
the ridge weights. Isotonic regression on the labelled rows' scores, which are
counted in bins, turns them into probabilities.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindlewatch.llm.calibration import calibrated, isotonic
from spindlewatch.llm.common import fold, keep, query, slices, small, table, texts_of
from spindlewatch.llm.hashing import Words

FEATURES = 256
RIDGE = 1e-3
WIDTH = 3.0  # of the Gaussian kernel, in standard deviations of a statistic
BINS = 2_000
_CLASSES = (
    [(48, 57)],  # digits
    [(65, 90)],  # upper case
    [(97, 122)],  # lower case
    [(128, 255)],  # other than ASCII
    [(33, 47), (58, 64), (91, 96), (123, 126)],  # punctuation
    [(10, 10)],
    [(32, 32)],
    [(124, 124)],  # bars
    [(44, 44), (46, 46)],  # comma and full stop
    [(33, 33), (63, 63)],
    [(35, 38), (42, 42), (64, 64)],  # symbols
    [(0, 9), (11, 31), (127, 127)],
)
_OF_CLASS = np.array([[any(a <= b <= z for a, z in spans) for b in range(256)] for spans in _CLASSES])
STATISTICS = len(_CLASSES) + 9


def statistics_of(texts: list[bytes]) -> np.ndarray:
    """A row of statistics for each whole text; zeros for an empty one."""
    parts = [np.zeros((0, STATISTICS))]
    for low, high in slices([len(t) for t in texts], 1 << 20):
        own = texts[low:high]
        out = np.zeros((high - low, STATISTICS))
        words = Words(own)
        hashed = words.hashes()
        lengths = words.end - words.start
        for row, text in enumerate(own):
            data = np.frombuffer(text, np.uint8)
            if not len(data):
                continue
            counts = np.bincount(data, minlength=256)
            shares = counts / len(data)
            first, n = words.first[row], int(words.count[row])
            w, sizes = hashed[first : first + n], lengths[first : first + n]
            lines = text.split(b"\n")
            out[row, : len(_CLASSES)] = _OF_CLASS @ shares
            seen = shares[shares > 0]
            out[row, len(_CLASSES) :] = (
                np.log1p(n),
                np.log1p(len(data)),
                sizes.mean() if n else 0,
                sizes.std() if n else 0,
                len(np.unique(w)) / n if n else 0,
                (w[1:] == w[:-1]).mean() if n > 1 else 0,
                len(set(lines)) / len(lines),
                np.log1p(len(data) / len(lines)),
                -(seen * np.log2(seen)).sum(),
            )
        parts.append(out)
    return np.concatenate(parts)


class FourierMap:
    def __init__(self, mean: np.ndarray, deviation: np.ndarray, seed: int = 5):
        random = np.random.default_rng(seed)
        self.mean, self.scale = mean, 1 / np.where(deviation > 1e-9, deviation, 1)
        self.directions = random.normal(size=(STATISTICS, FEATURES)) / WIDTH
        self.phases = random.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, statistics: np.ndarray) -> np.ndarray:
        scaled = np.clip((statistics - self.mean) * self.scale, -6, 6)
        waves = np.sqrt(2 / FEATURES) * np.cos(scaled @ self.directions + self.phases)
        return np.hstack([waves, np.ones((len(waves), 1))])


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` as (id, score), a row for a row; id, language and source are not inputs.

    All labelled rows outside fold 0 of 5 are learnt from. Null and empty texts
    have statistics of 0 and are scored like any text. Without labelled rows
    every score is 0. Labels of one id that differ count as 1.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    measured = keep(rows.mapInArrow(_measure, "id long, x array<double>"), "statistics")
    known = labels.where("doc_id is not null and quality in (0, 1)").where(fold("doc_id", 5) != 0)
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max("quality").cast("double").alias("y"))
    learnt = keep(measured.join(known, "id").select("x", "y"), "learnt")
    moments = learnt.select(
        F.count("*").alias("n"),
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(STATISTICS)],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(STATISTICS)],
    ).first()
    if not moments.n:
        return measured.select("id", F.lit(0.0).alias("score"))
    fourier = FourierMap(np.array(moments[1 : STATISTICS + 1]), np.array(moments[STATISTICS + 1 :]))

    def sums(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = fourier(_matrix(batch, "x"))
            y = batch.column("y").to_numpy()
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = learnt.mapInArrow(sums, "sums binary").rdd.map(lambda r: np.frombuffer(r.sums).reshape(FEATURES + 1, FEATURES + 2))
    equations = parts.treeReduce(np.add, depth=3)
    system = equations[:, :-1] + RIDGE * moments.n * np.diag(np.append(np.ones(FEATURES), 0)) / FEATURES
    weights = np.linalg.solve(system, equations[:, -1])

    def raw(batches):
        for batch in batches:
            value = fourier(_matrix(batch, "x")) @ weights
            yield pa.RecordBatch.from_arrays([pa.array(value), batch.column("y")], ["raw", "y"])

    place = F.floor((F.greatest(F.lit(-0.5), F.least(F.lit(1.5), F.col("raw"))) + 0.5) * (BINS / 2))
    bins = (
        learnt.mapInArrow(raw, "raw double, y double")
        .groupBy(place.alias("bin"))
        .agg(F.avg("raw").alias("x"), F.avg("y").alias("y"), F.count("*").alias("n"))
        .collect()  # BINS + 1 rows at most
    )
    knots = isotonic(*(np.array([b[c] for b in bins], float) for c in ("x", "y", "n")))

    def score(batches):
        for batch in batches:
            value = calibrated(fourier(_matrix(batch, "x")) @ weights, knots)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(value)], ["id", "score"])

    return measured.mapInArrow(score, "id long, score double")


def _measure(batches):
    kind = pa.list_(pa.float64())
    for batch in small(batches):
        found = statistics_of(texts_of(batch))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(list(found), kind)], ["id", "x"])


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


@query
def op6_quality_fourier(spark, sf_dir):
    scored = score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        F.col("id").alias("doc_id"),
        (fold("id", 5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )
