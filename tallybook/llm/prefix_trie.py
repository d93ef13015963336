"""A trie of conversation prefixes from sorted matrices of turn ids.

A turn's id is 128 bits of a digest of role and text, so a conversation is a row of ids. Conversations are sharded by range of
their id sequences (ties by conversation id), so a group of copies, however large, is dealt over several shards. Then:

1. A shard is read in blocks of a bounded number of turns. A block's ids form a matrix, padded with zeros, which is looked
   at some columns at a time, so one long conversation does not widen the rows of all others. ``lexsort`` orders the rows; per
   column a mask tells where the id differs from the row before, and OR-ing the masks from the left marks where nodes start.
2. With the length of the prefix that each row shares with the one before it and the one after it, everything asked about a node
   is a sum or minimum over its rows, which ``reduceat`` takes at every depth.
3. Nodes on the path of a block's first or last row may go on in the blocks beside it. They are handed on in part, with the digest of
   their prefix, and grouped by it. What a block could not know, the prefix shared across its edge, is handed
   on as corrections: within a shard by its task, between shards by a table of one row per shard. The conversations that end
   at such a node come in runs in the order of their ids and are streamed into one digest.

Ids are compared instead of texts: two different turns meet with a chance of 2**-127. Turns of a conversation stand in one row, 16 bytes
each.

Turns are ordered by number, a missing number first; turns of one number by role and by digest; repeated rows are turns of their own. Null
roles and texts are empty. Rows without a conversation id belong to none and are left out. An empty table has no conversations and
no nodes, not even a root. Columns beside the four that are read are not looked at.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: Conversations per family, and how many leading turns at most a conversation takes from the first of its family.
FAMILY, HEAD = 20, 3
#: Turns of a shard and of a block, columns looked at together, and ending conversations in one row handed on.
SHARD_TURNS, BLOCK_TURNS, COLUMNS, ENDS = 1_000_000, 200_000, 16, 50_000

NODES = T.StructType([
    T.StructField("kind", T.StringType()),  # whole: a node; part: of a node on an edge; ends: conversations of it; edge: of a shard
    *(T.StructField(n, T.LongType()) for n in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens")),
    T.StructField("ends_sha256", T.StringType()), T.StructField("prefix", T.BinaryType()),
    T.StructField("parent_prefix", T.BinaryType()), T.StructField("place", T.LongType()),
    *(T.StructField(n, T.BinaryType()) for n in ("ends", "first", "first_words", "last"))])
COUNTS = ("n_convs", "n_children", "n_leaves", "saved_tokens")
NOTHING = hashlib.sha256().hexdigest()


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, words): every conversation with the head of its family's first, as ids and word counts of its turns."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat_ws(" ", F.octet_length(role), F.concat(role, text)))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), (F.col("conv_id") - F.col("conv_id") % FAMILY).cast("long").alias("family"),
        F.struct("turn", role.alias("role"), digest.alias("id"),
                 F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).alias("words")).alias("turn"))
    # one shuffle: a family's conversations lie together, so the head is found where they are
    whole = turns.repartition("family").groupBy("family", "conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, HEAD))).over(Window.partitionBy("family"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    own = F.slice("turns", taken + 1, F.size("turns"))
    both = whole.withColumn("head", head).select("conv_id", F.concat(
        F.coalesce(F.slice("head", 1, taken), F.slice("turns", 1, 0)), own).alias("turns"))
    return both.select("conv_id", F.unhex(F.array_join(F.col("turns.id"), "")).alias("ids"), F.col("turns.words").alias("words"))


class Block:
    """Conversations as rows of a padded matrix, sorted, and what follows from neighbours in that order."""

    def __init__(self, convs: np.ndarray, ids: np.ndarray, lengths: np.ndarray, words: np.ndarray):
        """``ids`` (two 64-bit numbers per turn) and ``words`` hold the turns of all rows one after the other."""
        self.ids, self.words = ids, words
        self.order(convs, lengths)
        self.shared()

    def columns(self, rows: np.ndarray, first: int) -> np.ndarray:
        """The ids of some columns of the matrix, zeros where a row has no turn; real ids are never zero."""
        place = np.arange(first, first + COLUMNS)
        there = place < self.lengths[rows, None]
        at = np.where(there, self.at[rows, None] + place, 0)
        return np.where(there[:, :, None], self.ids[at] if len(self.ids) else np.zeros((*at.shape, 2), np.uint64), np.uint64(0))

    def order(self, convs: np.ndarray, lengths: np.ndarray) -> None:
        """Rows by their ids, a prefix before what it begins, and by conversation."""
        self.lengths, self.at = lengths, np.cumsum(lengths) - lengths
        order = np.argsort(convs, kind="stable")
        longest = int(lengths.max(initial=0))
        for first in range((longest - 1) // COLUMNS * COLUMNS if longest else -1, -1, -COLUMNS):  # the last columns first
            longer = lengths[order] > first
            rows = order[longer]
            keys = self.columns(rows, first).reshape(len(rows), -1)
            order = np.concatenate([order[~longer], rows[np.lexsort(keys.T[::-1])]])
        self.convs, self.lengths, self.at = convs[order], lengths[order], self.at[order]

    def shared(self) -> None:
        """``before``: the turns that each row has in common with the row before it, none for the first."""
        n = len(self.convs)
        self.before = np.zeros(n, dtype=np.int64)
        changed = np.zeros(n, dtype=bool)
        changed[:1] = True
        for first in range(0, int(self.lengths.max(initial=0)), COLUMNS):
            rows = np.flatnonzero(self.lengths > first)
            some = self.columns(rows, first)
            # the row before has no turn here if it is not among these rows
            differs = np.ones((len(rows), COLUMNS), dtype=bool)
            beside = np.flatnonzero(np.diff(rows) == 1) + 1
            differs[beside] = (some[beside] != some[beside - 1]).any(axis=2)
            differs[:, 0] |= changed[rows]
            starts = np.logical_or.accumulate(differs, axis=1)  # a node starts at every depth from here on
            same = ~starts & (np.arange(first, first + COLUMNS) < self.lengths[rows, None])
            self.before[rows] += same.sum(axis=1)
            ended = np.ones(n, dtype=bool)  # rows without turns here differ from whatever follows
            ended[rows] = starts[:, -1]
            changed = ended
        total = np.concatenate([[0], np.cumsum(self.words)])
        self.upto = total  # words before each turn, over all rows
        self.shared_words = total[self.at + self.before] - total[self.at]

    def path(self, row: int) -> list[bytes]:
        """The digests of the prefixes of a row, from the root's on."""
        out, turn = [b""], self.row(row)
        for i in range(0, len(turn), 16):
            out.append(hashlib.md5(out[-1] + turn[i:i + 16]).digest())
        return out

    def row(self, row: int) -> bytes:
        return self.ids[self.at[row]:self.at[row] + self.lengths[row]].tobytes()

    def row_words(self, row: int) -> np.ndarray:
        return self.words[self.at[row]:self.at[row] + self.lengths[row]]

    def nodes(self, place: int) -> Iterator[tuple[int, dict[str, object], list[dict[str, object]]]]:
        """Per depth: columns of the nodes in order, and rows of the conversations ending at those on an edge."""
        n = len(self.convs)
        after = np.append(self.before[1:], -1)
        leaf = after < self.lengths
        paths = self.path(0), self.path(n - 1)
        parents = None
        for depth in range(int(self.lengths.max(initial=0)) + 1):
            rows = np.flatnonzero(self.lengths >= depth)
            begins = self.before[rows] < depth
            begins[0] |= rows[0] == 0
            at = np.flatnonzero(begins)
            first = rows[at]
            conv = np.minimum.reduceat(self.convs[rows], at)
            words = np.zeros(len(rows), np.int64)
            goes_on = ~begins & (self.before[rows] >= max(depth, 1))
            mine, turn = rows[goes_on], max(depth - 1, 0)
            words[goes_on] = self.shared_words[mine] - (self.upto[self.at[mine] + turn] - self.upto[self.at[mine]])
            child = (self.before[rows] <= depth) & (self.lengths[rows] > depth)
            edge = np.zeros(len(at), dtype=bool)
            edge[0] = rows[0] == 0
            edge[-1] |= rows[-1] == n - 1
            # the prefix of the parent, if that is on an edge; the parents are the nodes of the depth before
            if parents is None:
                above, known = np.full(len(at), None), np.full(len(at), None)
            else:
                node = np.searchsorted(parents["first"], first, side="right") - 1
                above, known = parents["prefix"][node], np.where(parents["edge"][node], None, parents["conv_id"][node])
            prefix = np.full(len(at), None)
            if rows[-1] == n - 1:
                prefix[-1] = paths[1][depth]
            if rows[0] == 0:
                prefix[0] = paths[0][depth]
            ends = self.lengths[rows] == depth
            ended = np.add.reduceat(ends.astype(np.int64), at)
            digests, runs = np.full(len(at), NOTHING, dtype=object), []
            for i in np.flatnonzero(ended):
                of = self.convs[first[i]:first[i] + ended[i]]
                if not edge[i]:
                    digests[i] = hashlib.sha256(",".join(map(str, of.tolist())).encode()).hexdigest()
                else:
                    runs += [{"depth": depth, "prefix": prefix[i], "place": place + int(first[i]) + k,
                              "ends": ",".join(map(str, of[k:k + ENDS].tolist())).encode()} for k in range(0, len(of), ENDS)]
            parents = {"first": first, "conv_id": conv, "edge": edge, "prefix": prefix}
            yield depth, {
                "edge": edge, "conv_id": conv, "parent_conv_id": known, "n_convs": np.diff(np.append(at, len(rows))),
                "n_children": np.add.reduceat(child.astype(np.int64), at), "n_leaves": np.add.reduceat(leaf[rows].astype(np.int64), at),
                "saved_tokens": np.add.reduceat(words, at), "ends_sha256": digests, "prefix": prefix, "parent_prefix": above}, runs


def correction(last: bytes, first: bytes, first_words: np.ndarray) -> Iterator[dict[str, object]]:
    """What two neighbouring rows of different blocks, each taken for the outermost, counted wrongly per shared node."""
    one, other = (np.frombuffer(r, np.uint64).reshape(-1, 2) for r in (last, first))
    most = min(len(one), len(other))
    differs = np.flatnonzero((one[:most] != other[:most]).any(axis=1))
    shared = int(differs[0]) if len(differs) else most
    upto = np.concatenate([[0], np.cumsum(first_words)])
    prefix, begun = b"", shared == len(one)
    for depth in range(shared + 1):
        yield {"depth": depth, "prefix": prefix, "n_convs": 0, "n_children": -1 if depth < shared else 0,
               "n_leaves": -1 if begun else 0, "saved_tokens": int(upto[shared] - upto[max(depth - 1, 0)])}
        prefix = hashlib.md5(prefix + first[16 * depth:16 * depth + 16]).digest()


def _batch(columns: dict[str, object], n: int) -> pa.RecordBatch:
    """Rows of the shards' table; columns not given are null."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                       for f in ARROW_NODES], schema=ARROW_NODES)


def _listed(kind: str, rows: list[dict[str, object]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": kind, **row} for row in rows], schema=ARROW_NODES)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The sorted rows of a shard in blocks of a bounded number of turns."""
    held, size = [], 0

    def block() -> Block:
        rows = pa.Table.from_batches(held).combine_chunks()
        raw = rows.column("ids").combine_chunks().cast(pa.large_binary())
        ids = np.frombuffer(b"".join(raw.to_pylist()), ">u8").astype(np.uint64).reshape(-1, 2)
        words = rows.column("words").combine_chunks()
        lengths = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return Block(rows.column("conv_id").to_numpy(), ids, lengths, words.flatten().to_numpy(zero_copy_only=False).astype(np.int64))

    for batch in batches:
        weight = np.cumsum(batch.column("words").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        first = 0
        while first < len(batch):
            done = weight[first - 1] if first else 0
            last = max(int(np.searchsorted(weight, done + BLOCK_TURNS - size, side="right")), first + (not held))
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(weight[last - 1] - done)
            if last < len(batch):
                yield block()
                held, size = [], 0
            first = last
    if held:
        yield block()


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, those on edges of blocks in part, and the shard's own edges."""
    shard, done, edge = TaskContext.get().partitionId() << 40, 0, None
    for block in _blocks(batches):
        for at, nodes, runs in block.nodes(shard + done):
            on = nodes.pop("edge")
            depth = np.full(len(on), at, dtype=np.int64)
            for kind, rows, left_out in (("whole", ~on, "prefix"), ("part", on, "ends_sha256")):
                if rows.any():
                    some = {k: v[rows] for k, v in {**nodes, "depth": depth}.items() if k != left_out}
                    n = int(rows.sum())
                    yield _batch({"kind": [kind] * n, **some}, n)
            if runs:
                yield _listed("ends", runs)
        first, words, last = block.row(0), block.row_words(0), block.row(len(block.convs) - 1)
        if edge is None:
            edge = {"place": shard, "first": first, "first_words": words.astype("<i8").tobytes()}
        else:
            yield _listed("part", list(correction(edge["last"], first, words)))
        edge["last"] = last
        done += len(block.convs)
    if edge:
        yield _listed("edge", [edge])


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield _listed("part", list(correction(row["last"], row["first"], np.frombuffer(row["first_words"], "<i8"))))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ids, sorted by node and place: one digest per node, taken run by run."""
    now, digest, made = None, None, []
    for batch in batches:
        for prefix, ends in zip(batch.column("prefix").to_pylist(), batch.column("ends").to_pylist()):
            if prefix == now:
                digest.update(b",")
            else:
                if now is not None:
                    made.append((now, digest.hexdigest()))
                now, digest = prefix, hashlib.sha256()
            digest.update(ends)
    if now is not None:
        made.append((now, digest.hexdigest()))
    if made:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (pa.binary(), pa.string()))],
                                         ["prefix", "ends_sha256"])


def trie(sequences: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) per node of ``rebuilt`` rows."""
    spark = sequences.sparkSession
    rows = written(sequences, scratch_dir(spark, "conversations"))
    turns = rows.agg(F.sum(F.size("words").cast("long") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    sharded = rows.repartitionByRange(shards, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    found = written(sharded.mapInArrow(_shard, NODES), scratch_dir(spark, "trie-shards"))

    # one row per shard, so a window over all of them is as small as the number of shards
    beside = Window.orderBy("place")
    pairs = found.where("kind = 'edge'").select(
        "last", F.lead("first").over(beside).alias("first"), F.lead("first_words").over(beside).alias("first_words"))
    across = pairs.where("first IS NOT NULL").mapInArrow(_corrections, NODES)
    parts = found.where("kind = 'part'").unionByName(across)
    sums = parts.groupBy("prefix").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
                                       F.max("parent_prefix").alias("parent_prefix"), *(F.sum(c).alias(c) for c in COUNTS))
    ends = found.where("kind = 'ends'").select("prefix", "place", "ends").repartition("prefix").sortWithinPartitions(
        "prefix", "place").mapInArrow(_digests, "prefix binary, ends_sha256 string")
    edges = written(sums.join(ends, "prefix", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))),
                    scratch_dir(spark, "trie-edges"))

    shown = ["conv_id", "depth", "parent_conv_id", *COUNTS, "ends_sha256"]
    whole = found.where("kind = 'whole'")
    asking = whole.where("parent_prefix IS NOT NULL").drop("parent_conv_id")
    parents = edges.select(F.col("prefix").alias("_prefix"), F.col("conv_id").alias("parent_conv_id"))
    asking = asking.select("parent_prefix", *(c for c in shown if c != "parent_conv_id")).unionByName(
        edges.select("parent_prefix", *(c for c in shown if c != "parent_conv_id")))
    answered = asking.join(parents, F.col("parent_prefix") == F.col("_prefix"), "left")
    return whole.where("parent_prefix IS NULL").select(*shown).unionByName(answered.select(*shown))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations, one row each."""
    return trie(rebuilt(conversations))


def _arrow(kind: T.DataType) -> pa.DataType:
    return {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[kind.simpleString()]


ARROW_NODES = pa.schema([(f.name, _arrow(f.dataType)) for f in NODES])
