"""Approximate nearest neighbours by largest inner product, over a hierarchical k-means tree.

The tree is fitted to a sample (``SAMPLE`` vectors); every vector goes down it to a
leaf. A query opens nodes best first: a priority queue gives the node whose centre has the largest inner
product with it, until it has visited as many leaves as calibration found necessary. Calibration
widens the visits until queries of the sample find the asked share of their exact neighbours.

Leaves are the unit of work: the vectors of a leaf meet the queries that visit it. A
leaf larger than a block is cut into blocks, and so are its queries, so a leaf may hold any share of all rows. Every block hands
back each query's nearest; scores are inner products of the original vectors in double precision.

Vectors that are null, without elements, zero or with null or non-finite elements take no part, nor do rows without id; vectors of
different lengths do not meet. Rows that repeat an id with an equal vector are one; an id with several vectors is a query, and is
found, with each of them. A query does not find its own id. Ties go to the smaller id. No queries or no vectors give no rows.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.projection_forest import is_vector
from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: Vectors the tree is fitted to, children of a node, vectors of a leaf aimed at, the fewest of the sample in a split node.
SAMPLE, BRANCHES, LEAF, FEWEST = 16_384, 8, 2048, 64
#: Vectors, and queries, that meet in one task.
BLOCK, QUERIES = 4000, 4000
#: The recall that calibration asks for, and the queries it is measured with.
RECALL, CALIBRATED = 0.97, 300


@dataclass
class Tree:
    """Nodes in order of making, the root first: their centres, their children, and the number of each leaf."""

    centres: list = field(default_factory=list)
    children: list = field(default_factory=list)
    leaf: list = field(default_factory=list)
    leaves: int = 0
    visits: int = 0

    def place(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of every row: from the root always to the child with the nearest centre."""
        out, waiting = np.zeros(len(rows), dtype=np.int64), [(0, np.arange(len(rows)))]
        while waiting:
            node, held = waiting.pop()
            if not self.children[node]:
                out[held] = self.leaf[node]
            elif len(held):
                below = np.array(self.children[node])
                nearest = distances(rows[held], np.array([self.centres[c] for c in below])).argmin(axis=1)
                waiting += [(int(c), held[nearest == k]) for k, c in enumerate(below)]
        return out

    def visited(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves in best-bin-first order."""
        out, queue = [], [(0.0, 0)]
        while queue and len(out) < most:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(self.leaf[node])
            for child in self.children[node]:
                heapq.heappush(queue, (-float(query @ self.centres[child]), child))
        return out


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres * centres).sum(axis=1) - 2 * rows @ centres.T


def k_means(rows: np.ndarray, k: int, rng: np.random.Generator, turns: int = 12) -> np.ndarray:
    centres = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(turns):
        nearest = distances(rows, centres).argmin(axis=1)
        many = np.bincount(nearest, minlength=k)
        sums = np.stack([np.bincount(nearest, rows[:, d], k) for d in range(rows.shape[1])], axis=1)
        centres = np.where(many[:, None] > 0, sums / np.maximum(many, 1)[:, None], centres)
    return centres


def grow(sample: np.ndarray, total: int, nearest: int, recall: float = RECALL, seed: int = 3) -> Tree:
    """A tree of the sample for ``total`` vectors, with the visits at which the sample's queries reach the recall."""
    rng, tree = np.random.default_rng(seed), Tree()
    tree.centres.append(sample.mean(axis=0))
    waiting = [(0, np.arange(len(sample)))]
    tree.children.append([])
    tree.leaf.append(0)
    while waiting:
        node, held = waiting.pop()
        parts = []
        if len(held) >= FEWEST and len(held) * total > LEAF * len(sample):
            centres = k_means(sample[held], BRANCHES, rng)
            side = distances(sample[held], centres).argmin(axis=1)
            parts = [(c, held[side == k]) for k, c in enumerate(centres) if (side == k).any()]
        if len(parts) < 2:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
            continue
        for centre, part in parts:
            tree.children[node].append(len(tree.centres))
            waiting.append((len(tree.centres), part))
            tree.centres.append(centre)
            tree.children.append([])
            tree.leaf.append(-1)
    at = tree.place(sample)
    asked = rng.choice(len(sample), min(CALIBRATED, len(sample)), replace=False)
    exact = sample[asked] @ sample.T
    exact[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-exact, axis=1, kind="stable")[:, :max(1, min(nearest, len(sample) - 1))]
    turn = np.zeros((len(asked), tree.leaves), dtype=np.int64)
    for i, q in enumerate(asked):
        order = tree.visited(sample[q], tree.leaves)
        turn[i, order] = np.arange(1, len(order) + 1)
    needed = turn[np.arange(len(asked))[:, None], at[best]]
    tree.visits = int(np.quantile(needed, recall, method="higher"))  # so many visits find that share
    return tree


def _matrix(vectors, rows: np.ndarray, dim: int) -> np.ndarray:
    return vectors.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim).astype(np.float64)


def _members(trees: dict[int, Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            size, leaf = np.diff(vectors.offsets.to_numpy()), np.zeros(len(batch), dtype=np.int64)
            for dim in np.unique(size):
                if int(dim) in trees:
                    rows = np.flatnonzero(size == dim)
                    leaf[rows] = trees[int(dim)].place(_matrix(vectors, rows, dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size.astype(np.int32)), pa.array(leaf)],
                                             ["id", "vector", "dim", "leaf"])

    return run


def _visits(trees: dict[int, Tree]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                row, leaf, dims = [], [], []
                for i, vector in enumerate(part.column("vector").to_pylist()):
                    tree = trees.get(len(vector))
                    seen = tree.visited(np.array(vector), tree.visits) if tree else [0]
                    row += [i] * len(seen)
                    leaf += seen
                    dims += [len(vector)] * len(seen)
                told = part.take(pa.array(row, pa.int64()))
                yield pa.RecordBatch.from_arrays([*told.columns, pa.array(dims, pa.int32()), pa.array(leaf, pa.int64())],
                                                 ["id", "vector", "dim", "leaf"])

    return run


def _nearest(k: int):
    def run(queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        told = []
        if len(queries) and len(members):
            ids = members["id"].to_numpy()
            rows = np.array(members["vector"].tolist(), dtype=np.float64)
            for a in range(0, len(queries), 512):
                asked = queries["id"].to_numpy()[a:a + 512]
                points = np.array(queries["vector"].tolist()[a:a + 512], dtype=np.float64)
                rough = points @ rows.T
                rough[asked[:, None] == ids[None]] = -np.inf
                least = np.partition(rough, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(asked), -np.inf)
                slack = 1e-9 * (np.abs(points).max(axis=1) * np.abs(rows).max() * rows.shape[1])
                for q, query, point, row, low in zip(range(a, a + 512), asked, points, rough, least - slack):
                    found = np.flatnonzero((row >= low) & (ids != query))
                    scores = (rows[found] * point).sum(axis=1)  # equal vectors get equal scores
                    order = np.lexsort((ids[found], -scores))[:k]
                    told.append((query, queries["query"].iloc[q], (-scores[order]).tolist(), ids[found][order].tolist()))
        return pd.DataFrame(told, columns=["id", "query", "less", "found"])

    return run


def search(rows: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): the ``k`` nearest found of every row that ``queries`` picks, over all rows."""
    spark = rows.sparkSession
    points = rows.where(F.col(key).isNotNull() & is_vector(vector)).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("asked"))
    points = written(points.distinct(), scratch_dir(spark, "points"))
    sample: dict[int, list] = {}
    for r in points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect():
        sample.setdefault(len(r[0]), []).append(r[0])
    total = points.count()
    share = total / max(1, sum(map(len, sample.values())))
    trees = {dim: grow(np.array(vs), int(len(vs) * share), k) for dim, vs in sample.items()}

    members = written(points.select("id", "vector").mapInArrow(
        _members(trees), "id long, vector array<double>, dim int, leaf long"), scratch_dir(spark, "members"))
    visits = written(points.where("asked").select("id", "vector").mapInArrow(
        _visits(trees), "id long, vector array<double>, dim int, leaf long"), scratch_dir(spark, "visits"))
    place = ["dim", "leaf"]
    # a row per leaf: never more than the sample has vectors, so they can be broadcast
    size = members.groupBy(*place).agg(F.ceil(F.count("*") / BLOCK).alias("blocks")).join(
        visits.groupBy(*place).agg(F.ceil(F.count("*") / QUERIES).alias("parts")), place)
    size = F.broadcast(written(size, scratch_dir(spark, "leaf-sizes")))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    mark = F.xxhash64("vector")
    asked = visits.join(size, place).withColumn("query", mark).withColumn("part", F.pmod(mark, "parts")).withColumn(
        "block", upto("blocks")).select("id", "query", "vector", *place, "block", "part")
    held = members.join(size, place).withColumn("block", F.pmod(F.xxhash64("id"), "blocks")).withColumn(
        "part", upto("parts")).select("id", "vector", *place, "block", "part")
    group = [*place, "block", "part"]
    near = asked.groupBy(*group).cogroup(held.groupBy(*group)).applyInPandas(
        _nearest(k), "id long, query long, less array<double>, found array<long>")
    best = near.groupBy("id", "query").agg(F.flatten(F.collect_list(F.arrays_zip("less", "found"))).alias("all"))
    best = best.select("id", F.posexplode(F.slice(F.array_sort("all"), 1, k)).alias("rank", "one"))
    return best.select(F.col("id").alias("query_id"), (F.col("rank") + 1).cast("int").alias("rank"),
                       F.col("one.found").alias(key), (-F.col("one.less")).alias("score"))
