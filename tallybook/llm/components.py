"""Connected components of a graph given as pairs, by contraction.

Tasks first reduce the pairs they hold to a forest, each tree a star around its smallest id. While there are more pairs than one
task may hold, rounds follow: every node joins the neighbour (or itself) that comes first in a random order, the
pairs are drawn between the joined nodes, and tasks reduce them again. A constant part of the nodes goes each round, chains
included, so rounds grow with the logarithm of the nodes. A bounded number of pairs is then finished by one task.
Rounds are written tables: nothing is collected, nothing is replayed from the start.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: Pairs that one task holds, 16 bytes each.
HELD_PAIRS = 1_000_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(id, smallest id it is connected with) for all ids of the pairs."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(ids)))
    for one, other in zip(ends[:len(a)].tolist(), ends[len(a):].tolist()):
        while parent[one] != one:
            parent[one] = one = parent[parent[one]]
        while parent[other] != other:
            parent[other] = other = parent[parent[other]]
        if one < other:
            parent[other] = one
        else:
            parent[one] = other
    for i, above in enumerate(parent):  # ids are in order, so a parent is done before its children
        parent[i] = parent[above]
    return ids, ids[np.array(parent, dtype=np.int64)] if len(ids) else ids


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stars of a task's pairs, made of a bounded number of pairs at a time, and their roots as pairs with themselves."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a, b = (np.concatenate([held, batch.column(i).to_numpy()]) for i, held in enumerate((a, b)))
        if len(a) > 2 * HELD_PAIRS:
            ids, roots = forest(a, b)
            a, b = ids, roots
            if len(a) > HELD_PAIRS:  # no fewer than so many nodes: handed on
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a, b = a[:0], b[:0]
    if len(a):
        a, b = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(pairs: DataFrame) -> DataFrame:
    """(id, component) for every id in pairs (a, b): the smallest id that can be reached. Nulls and loops are no pairs."""
    spark = pairs.sparkSession
    real = pairs.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    pairs = written(real.mapInArrow(_reduce, "a long, b long"), scratch_dir(spark, "pairs"))
    nodes, turn = None, 0
    while (n := pairs.count()) > HELD_PAIRS:
        ends = pairs.where("a <> b").select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(
            pairs.select(F.col("b").alias("id"), F.col("a").alias("other")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("order"), F.col(c).alias("id"))  # noqa: B023, E731
        joined = ends.groupBy("id").agg(F.min(rank("other")).alias("first")).select(
            "id", F.least(rank("id"), "first")["id"].alias("root"))
        joined = written(joined, scratch_dir(spark, "roots"))
        moved = pairs.where("a <> b")
        for end in "ab":
            root = joined.select(F.col("id").alias(end), F.col("root").alias(f"_{end}"))
            moved = moved.join(root, end)
        between = moved.where("_a <> _b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        spread = between.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // HELD_PAIRS)), "a")
        pairs = written(spread.mapInArrow(_reduce, "a long, b long"), scratch_dir(spark, "pairs"))
        if nodes is None:
            nodes = joined
        else:
            later = joined.select(F.col("id").alias("root"), F.col("root").alias("next"))
            nodes = nodes.join(later, "root", "left").select("id", F.coalesce("next", "root").alias("root"))
        nodes = written(nodes, scratch_dir(spark, "nodes"))
        turn += 1
    last = pairs.coalesce(1).mapInArrow(_reduce, "a long, b long")  # a bounded number of pairs
    if nodes is None:
        return written(last.select(F.col("a").alias("id"), F.col("b").alias("component")), scratch_dir(spark, "components"))
    last = written(last, scratch_dir(spark, "roots")).select(F.col("a").alias("root"), F.col("b").alias("next"))
    nodes = written(nodes.join(last, "root", "left").select("id", F.coalesce("next", "root").alias("root")), scratch_dir(spark, "nodes"))
    smallest = nodes.groupBy("root").agg(F.min("id").alias("component"))
    return written(nodes.join(smallest, "root").select("id", "component"), scratch_dir(spark, "components"))
