"""Packing by power-of-two decomposition: every document is cut into pieces whose lengths are powers of two.

A document of n tokens gives n // longest pieces of the longest length and one
piece for each binary digit of the rest, longest first. A piece is a sequence of
its own, so no sequence crosses documents and none is padded. Sequences of equal
length form a bucket, from which batches are drawn: the pieces are written where their
document lies and then dealt by ranges of length, document and place, so the sequences of
a bucket have ids one after the other, and a bucket with most rows is many ranges.

Null and empty texts give one piece, the closing token. Repeated rows are packed
each for itself. Null ids are kept. Columns beside the two that are read are not
looked at. An empty table gives no pieces.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.byte_bpe import Encoder
from tallybook.llm.common import slices, text_bytes
from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: Pieces per Arrow batch handed back.
ROWS_PER_BATCH = 4096


def binary_lengths(n: int, longest: int) -> list[int]:
    """Lengths of the pieces of n tokens, in order; ``longest`` is a power of two."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 2, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, load: Callable[[], object], key: str = "doc_id", text: str = "text",
         longest: int = 1024, closing: int = 0) -> DataFrame:
    """(key, start, length, ids, doc_tokens, ids_crc32, sequence_id, offset) per piece, shortest bucket first.

    ``load`` makes the tokenizer inside a task; ids are little-endian unsigned 32-bit. A
    sequence id is a range's number and a count in the range's order, which has no ties
    but between equal rows, so it is the same when a lost task runs again.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    names = [key, "start", "length", "ids", "doc_tokens"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load())
        for batch in batches:
            for part in slices(batch, text):
                ids, upto = encoder(*text_bytes(part.column(text)))
                row, made = [], []
                for k, (i, j) in enumerate(zip(upto.tolist(), upto[1:].tolist())):
                    whole = np.append(ids[i:j], np.uint32(closing)).astype("<u4").tobytes()
                    start, n = 0, j - i + 1
                    for length in binary_lengths(n, longest):
                        row.append(k)
                        made.append((start, length, whole[4 * start:4 * (start + length)], n))
                        start += length
                for a in range(0, len(row), ROWS_PER_BATCH):
                    columns = zip(*made[a:a + ROWS_PER_BATCH])
                    keys = part.column(key).take(pa.array(row[a:a + ROWS_PER_BATCH]))
                    yield pa.RecordBatch.from_arrays([keys, *(pa.array(c, t) for c, t in zip(columns, types))], names)

    schema = T.StructType([docs.schema[key], *(T.StructField(n, k) for n, k in zip(names[1:], (
        T.LongType(), T.LongType(), T.BinaryType(), T.LongType())))])
    spark = docs.sparkSession
    pieces = written(docs.select(key, text).mapInArrow(run, schema), scratch_dir(spark, "pieces"))
    order = ["length", key, "start", "doc_tokens", "ids"]
    bucketed = pieces.repartitionByRange(*order[:3]).sortWithinPartitions(*order)
    return bucketed.select("*", F.crc32("ids").alias("ids_crc32"), F.monotonically_increasing_id().alias("sequence_id"),
                           F.lit(0).cast("long").alias("offset"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length: a batch is drawn from one folder and needs no padding."""
    pieces.write.partitionBy("length").parquet(path)
