"""Fill-in-the-middle transformation by secondary sort.

Every text is cut into units (a run of ASCII letters, or any other character), and at two units that a hash of its id chooses
into prefix, middle and suffix. Then:

1. Chunks of units are emitted as pieces keyed by document and position in the output; markers go with the chunk they precede.
2. Pieces are dealt by document and sorted within the partitions by document and position. Each partition is one stream, in
   which an incremental digest takes the output piece by piece: no text is put together in memory.
3. The same stream is read as a reader of the output would: from the form and the markers found in it, also where one
   lies across pieces, it tells which part every piece belongs to. The pieces get their place in the restored text, the
   partition is sorted again, and a second digest takes the restored text.

All pieces of a document stay in one partition, so the second sort moves nothing. Partitions are as many as their bytes ask
for. A document is a row; it is keyed by where the row lies, so rows that repeat an id are documents of their own.

A null text is empty and so plain. A null id counts as empty text in the hash. Columns of any name beside the two that are read
are not looked at. An empty table gives no rows.
"""

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import slices, text_bytes

# The markers before prefix, suffix and middle, and the order of the parts by form.
MARKERS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle"), "plain": ("text",)}
RESTORED = ("text", "prefix", "middle", "suffix")
#: Units in a chunk, bytes of text in a partition, and pieces per Arrow batch handed back.
UNITS, PARTITION_BYTES, ROWS_PER_BATCH = 4096, 64 << 20, 2048
#: Places of pieces: the part's number is above these bits, the piece's below.
PART_BITS = 40

#: Columns of pieces; those after ``piece`` are filled in a document's first.
TOLD = [("form", pa.string()), ("n", pa.int64()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
PLACED = [("row", pa.int64()), ("place", pa.int64()), ("piece", pa.binary())]
OUTPUT, RESTORED_DIGEST = ("output_sha256", pa.string()), ("restored_sha256", pa.string())


def choice(doc_id) -> tuple[int, int, int, int]:
    """The four numbers that a document's id gives."""
    told = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(told[i:i + 4]) for i in (0, 4, 8, 12))


def unit_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The byte at which each unit begins, of texts one after the other."""
    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    begins[offsets[:-1][np.diff(offsets) > 0]] = True  # a text's first letter, whatever the text before it ends with
    return np.flatnonzero(begins)


def parts_of(doc_id, whole: bytes, n: int, rotated: int = 20, kept: int = 90) -> tuple[str, int, int]:
    """(form, units of the prefix, units up to the end of the middle) of one text."""
    h1, h2, h3, h4 = choice(doc_id)
    if not whole or any(marker in whole for marker in MARKERS.values()) or h3 % 100 >= kept:
        return "plain", 0, n
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    return "spm" if h4 % 100 < rotated else "psm", first, second


def _cut(batches: Iterator[pa.RecordBatch], key: str, text: str) -> Iterator[pa.RecordBatch]:
    """The pieces of every row of a task, in the order of the output."""
    row, made = TaskContext.get().partitionId() << 33, []
    for batch in batches:
        schema = pa.schema([*PLACED, ("id", batch.schema.field(key).type), *TOLD])
        for some in slices(batch, text):
            data, offsets = text_bytes(some.column(text))
            starts = unit_starts(data, offsets)
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            upto = np.searchsorted(starts, offsets)
            for doc_id, a, b, i, j in zip(some.column(key).to_pylist(), offsets.tolist(), offsets[1:].tolist(),
                                          upto.tolist(), upto[1:].tolist()):
                whole, n = data[a:b].tobytes(), j - i
                at = np.append(starts[i:j], b) - a
                form, first, second = parts_of(doc_id, whole, n)
                spans = {"text": (0, n), "prefix": (0, first), "middle": (first, second), "suffix": (second, n)}
                ends = [int(chars[a + at[u]]) for u in (0, first, second)]
                told = (doc_id, form, n, *((None, None) if form == "plain" else (ends[1] - ends[0], ends[2] - ends[1])))
                place = 0
                for part in ORDERS[form]:
                    u, v = spans[part]
                    for w in range(u, max(v, u + 1), UNITS):
                        piece = (MARKERS.get(part, b"") if w == u else b"") + whole[at[w]:at[min(w + UNITS, v)]]
                        made.append((row, place, piece, *(told if place == 0 else (None,) * 5)))
                        place += 1
                row += 1
                if len(made) >= ROWS_PER_BATCH:
                    yield _batch(made, schema)
                    made = []
        if made:  # the type of the ids is the batch's
            yield _batch(made, schema)
            made = []


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Reader:
    """Reads an output piece by piece and tells which part each run of bytes belongs to."""

    def __init__(self, form: str):
        self.expected = list(ORDERS[form])
        self.part = self.expected.pop(0) if form == "plain" else None
        self.held = b""

    def __call__(self, piece: bytes, last: bool = False) -> Iterator[tuple[str, bytes]]:
        """(part, bytes) of what is certain; bytes that may begin a marker are held back until the next piece."""
        data = self.held + piece
        while self.expected and (at := data.find(MARKERS[self.expected[0]])) >= 0:
            if self.part and at:
                yield self.part, data[:at]
            self.part, data = self.expected.pop(0), data[at + 3:]
        keep = 2 if self.expected and not last else 0
        upto = max(len(data) - keep, 0)
        self.held = data[upto:]
        if self.part and upto:
            yield self.part, data[:upto]


class Assembly:
    """The digest of one output as its pieces come, and the pieces in the places of the restored text."""

    def __init__(self, row: int, told: list):
        self.row, self.told, self.number = row, told, 0
        self.digest, self.reader = hashlib.sha256(), Reader(told[1])

    def add(self, piece: bytes, last: bool = False) -> Iterator[tuple]:
        self.digest.update(piece)
        for part, run in self.reader(piece, last):
            yield self.row, (RESTORED.index(part) << PART_BITS) + self.number, run, *(None,) * 6
            self.number += 1

    def end(self) -> Iterator[tuple]:
        yield from self.add(b"", last=True)
        yield self.row, -1, b"", *self.told, self.digest.hexdigest()  # comes before all pieces


class Restoration:
    """The digest of one restored text as its pieces come."""

    def __init__(self, row: int, told: list):
        self.told, self.digest = told, hashlib.sha256()

    def add(self, piece: bytes) -> Iterator[tuple]:
        self.digest.update(piece)
        return iter(())

    def end(self) -> Iterator[tuple]:
        yield *self.told, self.digest.hexdigest()


def _stream(batches: Iterator[pa.RecordBatch], made_of: type, columns: list) -> Iterator[pa.RecordBatch]:
    """Sorted pieces, document after document, each handed to an object of its own; rows they make, in batches."""
    one, made, schema = None, [], None
    for batch in batches:
        schema = pa.schema([(n, batch.schema.field("id").type if n == "id" else kind) for n, kind in columns])
        for row, _, piece, *told in zip(*(column.to_pylist() for column in batch.columns)):
            if one is None or row != one[0]:
                if one:
                    made.extend(one[1].end())
                one = row, made_of(row, told)
            made.extend(one[1].add(piece))
            if len(made) >= ROWS_PER_BATCH:
                yield _batch(made, schema)
                made = []
    if one:
        made.extend(one[1].end())
        yield _batch(made, schema)


def partitions(docs: DataFrame, text: str) -> int:
    """As many partitions as the texts fill, and no fewer than the session's shuffles have."""
    held = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-held // PARTITION_BYTES))


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) per row."""
    id_column = ("id", None)
    kinds = {pa.int64(): T.LongType(), pa.binary(): T.BinaryType(), pa.string(): T.StringType()}

    def fields(columns: list) -> T.StructType:
        return T.StructType([T.StructField(n, docs.schema[key].dataType if n == "id" else kinds[kind]) for n, kind in columns])

    cut = [*PLACED, id_column, *TOLD]
    digested, done = [*cut, OUTPUT], [id_column, *TOLD, OUTPUT, RESTORED_DIGEST]
    pieces = docs.select(key, text).mapInArrow(partial(_cut, key=key, text=text), fields(cut))
    sorted_pieces = pieces.repartition(partitions(docs, text), "row").sortWithinPartitions("row", "place")
    outputs = sorted_pieces.mapInArrow(partial(_stream, made_of=Assembly, columns=digested), fields(digested))
    restored = outputs.sortWithinPartitions("row", "place").mapInArrow(
        partial(_stream, made_of=Restoration, columns=done), fields(done))
    return restored.select(F.col("id").alias(key), "n", "form", "prefix_chars", "middle_chars", OUTPUT[0], RESTORED_DIGEST[0])
