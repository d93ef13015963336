"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits the unit vectors by random directions, each node near the median of its part; vectors
within a margin of a split go to both sides. Trees are added until two vectors right at the threshold share a leaf
of some tree almost surely, which is measured on the sample the trees are fitted to (``SAMPLE`` vectors; every
vector is put into the leaves). Within a leaf all vectors of one label are compared in double precision.

A pair that shares several leaves counts in the first of them only. Equal vectors of a label are one
class and are compared once. A leaf larger than a block is cut into blocks and every two blocks are compared,
so a label or a cluster of any size is compared whole, and tasks hand back counts and the links that
connect, not all pairs.

Vectors that are null, zero, without elements or with null or non-finite elements, and vectors without label, link with nothing; so
do vectors of different lengths with each other. A row without id has no component and is kept. Rows that
repeat an id with an equal vector and label are one vector; each input row gives one output row.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.components import components
from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: Vectors that trees are fitted to, vectors of a leaf aimed at, vectors compared in one task at most.
SAMPLE, LEAF, BLOCK = 16_384, 512, 1500
#: The chance to miss a pair at the threshold, and the part of a pair's usual distance that spills over a split.
MISSED, SPILL = 1e-6, 0.5
#: Trees at most before larger leaves are taken, and vectors of the sample that a leaf needs for its share to be measured.
TREES, MEASURED = 64, 4


def is_vector(vector: str) -> Column:
    """True for vectors with a direction: some element is not zero, none is null, infinite or not a number."""
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector)
    return F.coalesce(F.forall(v, usable) & F.exists(v, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Each row by its length, in double precision; scaled first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


@dataclass
class Tree:
    """A direction per level, and the split of every node, numbered from 1 as in a heap."""

    directions: np.ndarray
    splits: np.ndarray
    margin: float

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf that a row falls or spills into."""
        row, node = np.arange(len(rows)), np.ones(len(rows), dtype=np.int64)
        for direction in self.directions:
            beyond = (rows @ direction)[row] - self.splits[node]
            low, high = beyond < self.margin, beyond >= -self.margin
            row = np.concatenate([row[low], row[high]])
            node = np.concatenate([2 * node[low], 2 * node[high] + 1])
        return row, node


def plant(sample: np.ndarray, depth: int, margin: float, rng: np.random.Generator) -> Tree:
    directions = rng.normal(size=(depth, sample.shape[1]))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    splits, node = np.zeros(1 << depth), np.ones(len(sample), dtype=np.int64)
    for level, direction in enumerate(directions):
        along = sample @ direction
        order = np.lexsort((along, node))
        begin = np.searchsorted(node[order], np.arange(1 << level, 2 << level))
        end = np.append(begin[1:], len(node))
        middle = order[np.minimum((begin + end) // 2, len(node) - 1)]
        splits[1 << level:2 << level] = np.where(end > begin, along[middle], 0)
        node = 2 * node + (along >= splits[node])
    return Tree(directions, splits, margin)


def forest(sample: np.ndarray, depth: int, threshold: float, seed: int = 5) -> list[Tree]:
    """Trees until a pair at the threshold is missed by all of them with a chance below MISSED.

    A tree is no deeper than its sample has vectors to measure the chance with. If TREES trees do not reach it, trees of
    one level less, whose leaves are larger and compared as exactly, are tried; those of no level have one leaf, which misses nothing.
    """
    depth = min(depth, max(0, (len(sample) // MEASURED).bit_length() - 1))
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    if depth == 0 or dim < 2:
        return [Tree(np.zeros((0, dim)), np.zeros(1), 0.0)]
    margin = SPILL * np.sqrt((2 - 2 * threshold) / dim)
    ones = sample[rng.integers(0, len(sample), 2000)]
    side = rng.normal(size=ones.shape)
    side -= (side * ones).sum(axis=1, keepdims=True) * ones
    others = threshold * ones + np.sqrt(1 - threshold**2) * units(side)
    trees, missed = [], 1.0
    while missed > MISSED and len(trees) < TREES:
        tree = plant(sample, depth, margin, rng)
        met = np.zeros(len(ones), dtype=bool)
        pairs = [np.stack(tree.leaves(x)) for x in (ones, others)]
        keys = [row * (2 << depth) + leaf for row, leaf in pairs]
        met[pairs[0][0][np.isin(keys[0], keys[1])]] = True
        missed *= max(1 - met.mean(), 1e-3)
        trees.append(tree)
    return trees if missed <= MISSED else forest(sample, depth - 1, threshold, seed)


def _routes(grown: dict[int, list[Tree]]):
    """Rows to one row per leaf: with the leaf, and with all leaves of the vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 2048):
                part = batch.slice(a, 2048)
                vectors = part.column("vector")
                size = np.diff(vectors.offsets.to_numpy())
                for dim in np.unique(size):
                    rows = np.flatnonzero(size == dim)
                    flat = vectors.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), dim)
                    unit = units(flat.astype(np.float64))
                    found = [np.stack(tree.leaves(unit)) for tree in grown.get(int(dim), [])] or [
                        np.stack([np.arange(len(rows)), np.ones(len(rows), dtype=np.int64)])]
                    row = np.concatenate([r for r, _ in found])
                    leaf = np.concatenate([leaf + (t << 40) for t, (_, leaf) in enumerate(found)])
                    order = np.lexsort((leaf, row))
                    row, leaf = row[order], leaf[order]
                    at = np.searchsorted(row, np.arange(len(rows) + 1)).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(at), pa.array(leaf))
                    told = part.take(pa.array(rows[row]))
                    yield pa.RecordBatch.from_arrays(
                        [*told.columns, pa.array(leaf), lists.take(pa.array(row))], [*part.schema.names, "leaf", "leaves"])

    return run


def met_before(leaves: list[np.ndarray], leaf: int) -> np.ndarray:
    """For every two vectors, whether they have a leaf in common that comes before ``leaf``."""
    size = [len(x) for x in leaves]
    every, place = np.unique(np.concatenate(leaves), return_inverse=True)
    held = np.zeros((len(leaves), len(every)), dtype=np.float32)
    held[np.repeat(np.arange(len(leaves)), size), place] = 1
    held = held[:, every < leaf]
    return held @ held.T > 0


def _compare(threshold: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", kind="stable").reset_index(drop=True)
        ids, own, many = (group[c].to_numpy() for c in ("id", "own", "many"))
        leaf, leaves = group["leaf"].iloc[0], group["leaves"].tolist()
        unit = units(np.array(group["vector"].tolist(), dtype=np.float64))
        p, q = group["p"].iloc[0], group["q"].iloc[0]
        near = np.zeros((len(ids), len(ids)), dtype=bool)
        for a in range(0, len(ids), 256):
            near[a:a + 256] = unit[a:a + 256] @ unit.T >= threshold
        near &= near.T
        near[np.arange(len(ids)), np.arange(len(ids))] = False
        if p != q:
            near &= own[:, None] != own[None, :]
        counts, links = (near & ~met_before(leaves, leaf)) @ many, []
        new = near.any(axis=1)
        while new.any():  # a link from each reached vector to those it reaches first
            queue = [int(np.flatnonzero(new)[0])]
            new[queue[0]] = False
            while queue:
                one = queue.pop()
                reached = np.flatnonzero(near[one] & new)
                new[reached] = False
                links += [(ids[one], ids[j]) for j in reached]
                queue += reached.tolist()
        told = [(ids[i], None, counts[i]) for i in np.flatnonzero(counts)] + [(a, b, 0) for a, b in links]
        return pd.DataFrame(told, columns=["a", "b", "n"]).astype({"a": "int64", "b": "Int64", "n": "int64"})

    return run


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = 0.93) -> DataFrame:
    """(key, n_links, component_id, kept) per row; linked are vectors of one label with a cosine of at least ``threshold``."""
    spark = rows.sparkSession
    slim = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"),
                       F.col(label).alias("label"))
    some = slim.where(F.col("id").isNotNull() & F.col("label").isNotNull() & is_vector("vector")).distinct()
    classes = written(some.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count("*").alias("many")),
                      scratch_dir(spark, "vector-classes"))
    copies = written(some.join(classes.select("label", "vector", F.col("id").alias("of"), "many"), ["label", "vector"])
                     .select("id", "of", "many"), scratch_dir(spark, "vector-copies"))

    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    depth = max(0, int(np.ceil(np.log2(max(largest, 1) / LEAF))))
    sample = [r[0] for r in classes.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").collect()]
    by_size: dict[int, list] = {}
    for v in sample:
        by_size.setdefault(len(v), []).append(v)
    grown = {dim: forest(units(np.array(vs)), depth, threshold) for dim, vs in by_size.items()}

    kind = classes.schema["label"].dataType.simpleString()
    routed = classes.select("label", "id", "many", "vector").mapInArrow(
        _routes(grown), f"label {kind}, id long, many long, vector array<double>, leaf long, leaves array<long>")
    place = ["label", "dim", "leaf"]
    routed = routed.withColumn("dim", F.size("vector"))
    large = written(routed.groupBy(*place).count().where(f"count > {BLOCK}").select(
        *[F.col(c).alias(f"_{c}") for c in place], F.ceil(F.col("count") / BLOCK).alias("blocks")),
        scratch_dir(spark, "large-leaves"))
    own = F.pmod(F.xxhash64("id"), F.coalesce("blocks", F.lit(1)))
    sided = routed.join(large, [F.col(c) == F.col(f"_{c}") for c in place], "left").withColumn("own", own)
    blocks = F.sequence(F.lit(0).cast("long"), F.coalesce("blocks", F.lit(1)) - 1)
    sided = sided.withColumn("other", F.explode(blocks)).select(
        *place, "id", "many", "vector", "leaves", "own", F.least("own", "other").alias("p"),
        F.greatest("own", "other").alias("q"))
    found = written(sided.groupBy(*place, "p", "q").applyInPandas(_compare(threshold), "a long, b long, n long"),
                    scratch_dir(spark, "vector-links"))

    links = found.where("b IS NOT NULL").select("a", "b").unionByName(
        copies.where("id <> of").select(F.col("of").alias("a"), F.col("id").alias("b")))
    reached = components(links)
    linked = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    counts = copies.join(linked, F.col("of") == F.col("a"), "left").groupBy(F.col("id").alias("_counted")).agg(
        F.sum(F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"))
    out = slim.select("id").join(counts, F.col("id") == F.col("_counted"), "left").join(
        reached.select(F.col("id").alias("_reached"), "component"), F.col("id") == F.col("_reached"), "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
