"""Helpers that several operators share: words of whole texts as 64-bit hashes, over Arrow batches, and packed integers."""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F

# The bytes that separate words (space and 0x09 to 0x0D), and the constants of the hash.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
PLAIN = np.arange(256, dtype=np.uint64)
LOWER = PLAIN.copy()
LOWER[0x41:0x5B] += 32
BASE = 0x9E3779B97F4A7C15 | 3
INVERSE = pow(BASE, -1, 2**64)
#: Bytes of text hashed at a time; only working memory depends on it.
WINDOW = 1 << 20


def unused(columns: list[str], name: str) -> str:
    """The name, or with underscores before it if a column has it already."""
    while name.lower() in {c.lower() for c in columns}:
        name = f"_{name}"
    return name


def crc_fold(key: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts one after the other, and where each begins (one place more than texts); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 4 << 20):
    """The batch in runs of whole rows of about ``most_bytes`` of text; a longer text is a run of its own."""
    _, offsets = text_bytes(batch.column(column))
    first = 0
    while first < len(batch):
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, side="right")) - 1
        last = min(max(last, first + 1), len(batch))
        yield batch.slice(first, last - first)
        first = last


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, seen through ``table``; spans are in order and do not overlap.

    Equal spans have equal hashes; two different ones meet with a chance of
    about 2**-64.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    up, down, i = powers(BASE, WINDOW), powers(INVERSE, WINDOW), 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + WINDOW, side="right")), i + 1)
        a, b = int(starts[i]), int(ends[j - 1])
        if b - a > WINDOW:  # one span longer than the window
            h = 0
            for k in range(a, b, WINDOW):
                part = table[data[k:min(k + WINDOW, b)]] + np.uint64(1)
                h += int((part * up[:len(part)]).sum(dtype=np.uint64)) * pow(BASE, k - a, 2**64)
            out[i] = h % 2**64
        else:
            total = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum((table[data[a:b]] + np.uint64(1)) * up[:b - a], out=total[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            out[i:j] = (total[e] - total[s]) * down[s]
        i = j
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(BASE))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of every text in order: hash, length in bytes, and per text the number of its first word.

    A word is a run of bytes other than the separators, with A to Z in lower case.
    """
    inside = np.zeros(len(data) + 2, dtype=bool)  # with one place before and after
    inside[1:-1] = ~SPACES[data]
    new_text = np.zeros(len(data) + 1, dtype=bool)
    new_text[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | new_text))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | new_text))
    return span_hashes(data, starts, ends, LOWER), ends - starts, np.searchsorted(starts, offsets)


def pack(values: np.ndarray) -> bytes:
    """Integers as compressed bytes: like bytes of all values stand together, in blocks of their own, which makes small values cheap."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    packer = zstandard.ZstdCompressor(level=1).compressobj(size=values.nbytes)
    blocks = [part for plane in planes for part in (packer.compress(plane.tobytes()), packer.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK))]
    return b"".join([*blocks, packer.flush()])


def unpack(data: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)
