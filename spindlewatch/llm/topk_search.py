"""Exact top-k inner products by a dual-tree search over cover trees.

Queries and data are dealt to lots, and every pair of lots is searched with a
cover tree of each. A pair of nodes is skipped if the inner product of their
centres, widened by both covering radii, stays below the worst k-th score that
any query of the node has so far. In many dimensions few points lie near each
other; a node then gets a bounded number of children and keeps its far points as
a bucket under its own radius, which changes the cost and not the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindlewatch.llm.common import keep, query, table

QUERY_LOT = 4_096
DATA_LOT = 16_384
LEAF = 256
CHILDREN = 24
SHRINK = 1.3  # a child's points lie within the node's radius divided by this


class CoverTree:
    """A node: ``center``, ``radius`` (largest distance of its points), ``points`` and ``children``."""

    def __init__(self, vectors: np.ndarray, points: np.ndarray, center: int, leaf: int):
        self.vectors, self.points, self.center = vectors, points, vectors[center]
        distance = np.sqrt(((vectors[points] - self.center) ** 2).sum(axis=1))
        self.radius = float(distance.max(initial=0.0))
        self.norm = float(np.sqrt((self.center**2).sum()))
        self.children: list[CoverTree] = []
        if len(points) <= leaf or self.radius == 0:
            return
        # The node's own centre comes first, then uncovered points, apart by the covering distance.
        covering, rest, heads = self.radius / SHRINK, points, []
        head = center
        while len(rest) and len(heads) < CHILDREN:
            near = np.sqrt(((vectors[rest] - vectors[head]) ** 2).sum(axis=1)) <= covering
            heads.append((head, rest[near]))
            rest = rest[~near]
            if len(rest):
                head = int(rest[0])
        groups = [(h, g) for h, g in heads if len(g)]
        if sum(len(g) for _, g in groups[1:]) + len(rest) == 0 and len(groups[0][1]) == len(points):
            return
        self.children = [CoverTree(vectors, g, h, leaf) for h, g in groups]
        for at in range(0, len(rest), 4 * leaf):
            bucket = CoverTree.__new__(CoverTree)
            bucket.vectors, bucket.points, bucket.center, bucket.norm = vectors, rest[at : at + 4 * leaf], self.center, self.norm
            bucket.radius = float(np.sqrt(((vectors[bucket.points] - self.center) ** 2).sum(axis=1)).max())
            bucket.children = []
            self.children.append(bucket)


class DualSearch:
    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int):
        self.q, self.q_ids, self.d, self.d_ids, self.k = queries, query_ids, data, data_ids, k
        self.best: list[list[tuple[float, int]]] = [[] for _ in query_ids]
        self.worst = np.full(len(query_ids), -np.inf)
        self.pairs = self.pruned = 0
        if len(queries) and len(data):
            self.visit(CoverTree(queries, np.arange(len(queries)), 0, 64), CoverTree(data, np.arange(len(data)), 0, LEAF))

    def bound(self, q: CoverTree, d: CoverTree) -> float:
        """No inner product of a point of each is larger; the margin covers rounding."""
        most = float(q.center @ d.center) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
        return most + 1e-9 * (1 + abs(most))

    def visit(self, q: CoverTree, d: CoverTree) -> None:
        self.pairs += 1
        # Equal scores go to the smaller id, so only what stays below is skipped.
        if self.bound(q, d) < self.worst[q.points].min():
            self.pruned += 1
            return
        if not q.children and not d.children:
            self.compare(q.points, d.points)
        elif d.children and (not q.children or d.radius >= q.radius):
            for child in sorted(d.children, key=lambda c: -self.bound(q, c)):
                self.visit(q, child)
        else:
            for child in q.children:
                self.visit(child, d)

    def compare(self, queries: np.ndarray, points: np.ndarray) -> None:
        scores = self.q[queries] @ self.d[points].T
        ids = self.d_ids[points]
        scores[self.q_ids[queries][:, None] == ids[None, :]] = -np.inf
        open_ = np.flatnonzero((scores >= self.worst[queries][:, None]).any(axis=1))
        for row in open_:
            q = queries[row]
            own = scores[row]
            hits = np.flatnonzero((own >= self.worst[q]) & (own > -np.inf))
            if len(hits) > 4 * self.k:
                hits = hits[own[hits] >= np.partition(own[hits], -self.k)[-self.k]]
            best = sorted(self.best[q] + [(-float(own[h]), int(ids[h])) for h in hits])[: self.k]
            self.best[q] = best
            if len(best) == self.k:
                self.worst[q] = -best[-1][0]


def top_k(vectors: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", every: int = 50, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best partners of each row whose id is divisible by ``every``.

    Components x become floor(scale * x); the score is their inner product,
    ties go to the smaller id. A row is not its own partner. Null vectors, those
    with a null or non-finite component and rows without an id take no part; a
    repeated id counts once. Vectors of different lengths are not compared. A
    query with fewer than k partners gets them all.
    """
    fine = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(vector_column, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    rows = keep(
        vectors.where(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull() & fine)
        .select(F.col(id_column).cast("long").alias("id"), whole.alias("v"))
        .dropDuplicates(["id"]),
        "vectors",
    )
    asked = F.pmod("id", F.lit(every)) == 0
    total, questions = rows.agg(F.count("*"), F.count_if(asked)).first()
    q_lots, d_lots = max(1, -(-questions // QUERY_LOT)), max(1, -(-total // DATA_LOT))
    lot = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dim = F.size("v").alias("dim")
    q = rows.where(asked).select("id", "v", dim, lot(q_lots).cast("int").alias("q_lot"), spread(d_lots).alias("d_lot"))
    d = rows.select("id", "v", dim, spread(q_lots).alias("q_lot"), lot(d_lots).cast("int").alias("d_lot"))
    keys = ["dim", "q_lot", "d_lot"]
    found = q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(k: int):
    def run(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(d) and len(q["v"].iloc[0]):
            q, d = q.sort_values("id"), d.sort_values("id")
            ids = q["id"].to_numpy()
            search = DualSearch(np.stack(q["v"]), ids, np.stack(d["v"]), d["id"].to_numpy(), k)
            out = [(int(i), n, -s) for i, best in zip(ids, search.best) for s, n in best]
        elif len(q) and len(d):  # vectors without components: every score is 0
            ids = sorted(d["id"])[: k + 1]
            out = [(int(i), n, 0) for i in q["id"] for n in [x for x in ids if x != i][:k]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    return run


@query
def op2_exact_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"))
