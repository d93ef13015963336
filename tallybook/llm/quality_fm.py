"""A quality classifier: a factorisation machine over hashed words, statistics of the text's structure, and its size.

score = sigmoid(b + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairs are never formed: their sum is
half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so a text is scored in time linear in its words.

The model is trained on a bounded sample of the labelled rows (``most``, the ones
with the smallest hash of their id) and is of fixed size; every row is scored, from its whole text, where it lies.

A null or empty text has no words and is scored by its statistics alone. Null ids
and repeated rows are scored like all others; a null id has no label. Labels that
are null are not learnt from, and repeated labels count each time. With no labels
at all every score is 0.5. Only the id and the text are read, so other columns cannot matter.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import PLAIN, crc_fold, mix, slices, span_hashes, text_bytes, word_hashes

#: Bits of a hashed word, factors of a feature, labelled rows to learn from at most.
WORD_BITS, FACTORS, MOST = 16, 8, 4000
FOLDS = 5


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


_CLASSES = (
    _class(bytes(range(0x41, 0x5B))), _class(bytes(range(0x61, 0x7B))), _class(b"0123456789"), _class(b".,;:'\"?()-"),
    _class(b"!"), _class(b"#$%&*+/<=>@\\^_`{|}~[]"), _class(b" \t"), _class(b"\n\r"), _class(bytes(range(0x80, 0x100))))
STATISTICS = len(_CLASSES) + 9


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, word bucket, value) of every distinct word of each text, and a row of statistics per text."""
    n = len(offsets) - 1
    words, lengths, first = word_hashes(data, offsets)
    text = np.repeat(np.arange(n), np.diff(first))
    _, one, count = np.unique(mix(words + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True,
                              return_counts=True)
    row, bucket = text[one], (words[one] >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    value = np.log1p(count)
    value = value / np.sqrt(np.bincount(row, value**2, n))[row]

    size = np.diff(offsets)
    sums = [np.diff(np.concatenate([[0], np.cumsum(c[data], dtype=np.int64)])[offsets]) for c in _CLASSES]
    shares = [s / np.maximum(size, 1) for s in sums]
    n_words, distinct = np.diff(first), np.bincount(row, minlength=n)
    letters = np.bincount(text, lengths, n) / np.maximum(n_words, 1)
    spread = np.sqrt(np.maximum(np.bincount(text, lengths.astype(float)**2, n) / np.maximum(n_words, 1) - letters**2, 0))
    most = np.zeros(n)
    np.maximum.at(most, row, count)
    double = np.zeros(len(words), dtype=bool)
    double[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    lines, again = _lines(data, offsets)
    statistics = np.stack([
        *shares, np.log1p(size), np.log1p(n_words), letters, spread, distinct / np.maximum(n_words, 1),
        most / np.maximum(n_words, 1), lines / np.maximum(n_words, 1), again / np.maximum(lines, 1),
        np.bincount(text, double, n) / np.maximum(n_words, 1)], axis=1)
    return row, bucket, value, statistics


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines with any text per text, and how many of them came before in it."""
    n = len(offsets) - 1
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets[:-1]] = True
    cut[1:][data == 0x0A] = True
    starts = np.flatnonzero(cut[:len(data)])
    ends = np.append(starts[1:], len(data))
    kept = ends - starts > 1
    starts, ends = starts[kept], ends[kept]
    text = np.searchsorted(offsets, starts, side="right") - 1
    ends = ends - (data[ends - 1] == 0x0A) if len(ends) else ends
    hashes = span_hashes(data, starts, ends, PLAIN)
    _, one = np.unique(mix(hashes + text.astype(np.uint64)), return_index=True)
    lines = np.bincount(text, minlength=n)
    return lines, lines - np.bincount(text[one], minlength=n)


@dataclass
class Machine:
    """A trained machine. Features are the word buckets and then the statistics, made even by mean and spread."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    def features(self, found) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        row, bucket, value, statistics = found
        n = len(statistics)
        even = np.clip((statistics - self.mean) / self.spread, -4, 4) / 2
        more = np.repeat(np.arange(n), STATISTICS)
        places = np.tile(np.arange(STATISTICS) + (1 << WORD_BITS), n)
        return (np.concatenate([row, more]), np.concatenate([bucket, places]), np.concatenate([value, even.ravel()]), n)

    def margin(self, row: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The value before the sigmoid of each row, and its sums of factors."""
        out = self.bias + np.bincount(row, self.weights[feature] * value, n)
        sums = np.empty((n, FACTORS))
        for f in range(FACTORS):
            part = self.factors[feature, f] * value
            sums[:, f] = np.bincount(row, part, n)
            out += (sums[:, f]**2 - np.bincount(row, part**2, n)) / 2
        return out, sums

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        margin, _ = self.margin(*self.features(text_features(data, offsets)))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def train(rows: list[tuple], rounds: int = 8, batch: int = 64, rate: float = 0.05, decay: float = 1e-4,
          seed: int = 11) -> Machine:
    """Fit to (bucket, value, statistics, label) rows by mini-batches with steps that shrink per feature."""
    rng, size = np.random.default_rng(seed), (1 << WORD_BITS) + STATISTICS
    machine = Machine(0.0, np.zeros(size), rng.normal(0, 0.01, (size, FACTORS)), np.zeros(STATISTICS), np.ones(STATISTICS))
    if not rows:
        machine.factors[:] = 0
        return machine
    statistics = np.array([r[2] for r in rows], dtype=float)
    machine.mean, machine.spread = statistics.mean(axis=0), statistics.std(axis=0) + 1e-6
    labels = np.array([r[3] for r in rows], dtype=float)
    share = np.clip(labels.mean(), 0.01, 0.99)
    machine.bias = float(np.log(share / (1 - share)))
    seen = [np.full(size, 1e-6), np.full((size, FACTORS), 1e-6)]
    for _ in range(rounds):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), batch):
            part = order[a:a + batch]
            words = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            row, feature, value, n = machine.features((
                words, np.concatenate([np.asarray(rows[i][0], dtype=np.int64) for i in part]),
                np.concatenate([np.asarray(rows[i][1], dtype=float) for i in part]), statistics[part]))
            margin, sums = machine.margin(row, feature, value, n)
            wrong = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[part]) / n
            machine.bias -= rate * float(wrong.sum())
            used, at = np.unique(feature, return_inverse=True)
            push = wrong[row] * value
            step = np.bincount(at, push, len(used)) + decay * machine.weights[used]
            seen[0][used] += step**2
            machine.weights[used] -= rate * step / np.sqrt(seen[0][used])
            for f in range(FACTORS):
                pull = push * (sums[row, f] - machine.factors[feature, f] * value)
                step = np.bincount(at, pull, len(used)) + decay * machine.factors[used, f]
                seen[1][used, f] += step**2
                machine.factors[used, f] -= rate * step / np.sqrt(seen[1][used, f])
    return machine


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        folds: int = FOLDS, held_out: int = 0, most: int = MOST) -> Machine:
    """The machine learnt from at most ``most`` labelled rows outside the held-out fold."""
    chosen = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (crc_fold(key, folds) != held_out))
              .select(F.col(key).alias("_labelled"), F.col(label).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_labelled"), "_labelled", "_label").limit(most))
    marked = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(
        F.broadcast(chosen), F.col("_key") == F.col("_labelled"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, bucket, value, statistics = text_features(*text_bytes(part.column("text")))
                order = np.argsort(row, kind="stable")
                cuts = np.searchsorted(row[order], np.arange(1, len(part)))
                split = lambda x: [v.tobytes() for v in np.split(x[order], cuts)]
                yield pa.RecordBatch.from_arrays([
                    part.column("_key"), part.column("_label"), pa.array(split(bucket.astype(np.int32)), pa.binary()),
                    pa.array(split(value.astype(np.float32)), pa.binary()),
                    pa.array([s.tobytes() for s in statistics], pa.binary())],
                    ["_key", "_label", "bucket", "value", "statistics"])

    kind = marked.schema["_key"].dataType.simpleString()
    found = marked.select("_key", "_label", "text").mapInArrow(
        run, f"_key {kind}, _label int, bucket binary, value binary, statistics binary")
    rows = sorted(found.collect(), key=lambda r: (r[0], r[1], r[2]))
    return train([(np.frombuffer(r.bucket, np.int32), np.frombuffer(r.value, np.float32),
                   np.frombuffer(r.statistics), r["_label"]) for r in rows])


def score(docs: DataFrame, machine: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """The rows with the score of their whole text as one more column."""
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = pa.array(machine.score(*text_bytes(part.column(text))), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, made], schema.fieldNames())

    return docs.mapInArrow(run, schema)
