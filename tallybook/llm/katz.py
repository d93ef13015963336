"""A Katz backoff language model of n-grams up to ``order`` words: counted over the training documents, scored over all.

P(w | h) = d(c) c(h, w) / c(h)      if h and w were seen together, with Good-Turing discounts d for counts up to ``SMALL``,
         = a(h) P(w | h')            if not, h' being h without its first word; a(h) gives the words not seen after h
                                     exactly what the discounts left over;
P(w)     = d(c) c(w) / N             for words seen, and the rest of the mass for the unknown word, so that it recurses to a constant.

Every document begins with a start mark, which is only a history, and ends with an
end token. A history does not reach before the mark: the first words have shorter ones. After a history that was never
seen w has P(w | h'). If nothing seen after a history is discounted, one more is counted for it, so that something is left.
Each length of n-grams has discounts of its own.

How it runs: documents are gathered into chunks, each a list of its distinct words and a
stream of their places in it, in a table bucketed by chunk. Chunks ask for the counts of their distinct words, then of their
distinct pairs, and so on to ``order``, in packed requests; what is asked carries what the
chunk counted, so the answers are the sums over all. Words are dealt to groups by hash, n-grams by their history. Each group
numbers what it saw, and from then on a word or an n-gram that is a history goes by its number: sorted numbers of a dense
range take a few bits each. The words of histories that are hot (``hot`` times an even share of all
tokens) are dealt by the n-gram, and only their few sums go to every task. A chunk that has everything that was seen after a
history makes that history's sums itself; the others are told, and only what they divide by if all words that the chunk has
after the history were seen there, so that none needs its weight. Sums are whole numbers, of counts and of the counts of the
n-grams without their first word: the chances of these have one divisor for a history, which the chunk knows. An n-gram is asked
for if both shorter ones in it were seen; the answers of one length give the chances that the weights of the next need. The
counts of each length stay as a table under ``path``, partitioned by kind, a row a group: the hashes and counts of words, of
which the k-th has number (k + 1) * groups + group, and the numbers of histories and words, and the counts, of n-grams,
numbered likewise.

A null text counts as empty and has the end token only. Null ids are learnt from. Each row counts, so repeated rows
count again, and each input row gives one output row. Words are 64-bit hashes; two words meet with a chance of about 2**-64. Without
training rows the unknown word has the whole mass and every score is 0. Only the id and the text are read.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import crc_fold, mix, pack, slices, text_bytes, unpack, word_hashes
from tallybook.operators.load import written
from tallybook.scratch import scratch_dir

#: Counts up to this are discounted; bytes of text in a chunk.
SMALL, CHUNK = 5, 16 << 20
#: Packed bytes of all chunks to a group of requests, and groups at most, as each chunk sends a row to each group.
GROUP_BYTES, GROUPS = 16 << 20, 1 << 16
END = np.uint64(1)
#: Numbers of the start mark, which no word has, and of what was not seen.
START, UNSEEN = 0, np.iinfo(np.int64).max
TIMES = np.arange(1, SMALL + 1)

ANSWERS = "kind string, bucket int, chunk long, numbers array<binary>, sums array<double>"
_TYPES = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("chunk", pa.int64()),
                    ("numbers", pa.list_(pa.binary())), ("sums", pa.list_(pa.float64()))])


def discounts(seen: np.ndarray) -> np.ndarray:
    """d(c) for c from 0 to SMALL by Good-Turing as Katz has it; ``seen[c - 1]`` is how many were seen c times.

    Where the counts are too few for it, a lower limit is taken, and last half a count is taken off each.
    """
    out = np.ones(SMALL + 1)
    for most in range(SMALL, 0, -1):
        n = np.asarray(seen[:most + 1], dtype=float)
        if (n > 0).all():
            c = np.arange(1, most + 1)
            over = (most + 1) * n[most] / n[0]
            d = ((c + 1) * n[1:] / n[:-1] / c - over) / (1 - over) if over < 1 else np.zeros(1)
            if ((d > 0) & (d < 1)).all():
                out[1:most + 1] = d
                return out
    out[1:] = 1 - 0.5 / np.arange(1, SMALL + 1)
    return out


def spectrum(counts: np.ndarray) -> list[float]:
    return np.bincount(np.minimum(counts, SMALL + 2), minlength=SMALL + 3)[1:SMALL + 2].astype(float).tolist()


@dataclass
class Unigrams:
    """What scoring needs of single words: tokens and distinct words of training, and the discounts."""

    tokens: int
    words: int
    discount: np.ndarray
    seen: np.ndarray

    def __post_init__(self):
        c = np.arange(1, SMALL + 1)
        self.left = float((self.seen[:SMALL] * c * (1 - self.discount[1:])).sum())
        self.all = self.tokens
        if self.left <= 0:
            self.left, self.all = 1.0, self.tokens + 1
        self.unknown = self.left / self.all

    def chance(self, counts: np.ndarray) -> np.ndarray:
        seen = self.discount[np.minimum(counts, SMALL)] * counts
        seen[counts > SMALL] = counts[counts > SMALL]
        return np.where(counts > 0, seen / self.all, self.unknown)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, made = TaskContext.get().partitionId(), 0
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            words, _, first = word_hashes(data, offsets)
            held.append((part.column("id"), part.column("held"), words, np.diff(first)))
            size += len(data)
            if size >= CHUNK:
                yield _chunk((task << 24) + made, held)
                held, size, made = [], 0, made + 1
    if held:
        yield _chunk((task << 24) + made, held)


def _chunk(number: int, held: list) -> pa.RecordBatch:
    ids, out = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
    sizes = np.concatenate([h[3] for h in held]) + 1
    tokens = np.full(int(sizes.sum()), END)
    inner = np.ones(len(tokens), dtype=bool)
    inner[np.cumsum(sizes) - 1] = False
    tokens[inner] = np.concatenate([h[2] for h in held])
    words, stream, many = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.argsort(-many, kind="stable")  # frequent words get small numbers, which pack well
    place = np.empty(len(words), dtype=np.int32)
    place[order] = np.arange(len(words))
    stream = place[stream]
    trained = np.repeat(~out.to_numpy(zero_copy_only=False).astype(bool), sizes)
    counts = np.bincount(stream[trained], minlength=len(words))
    lists = pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([out.to_pylist()], pa.list_(pa.bool_()))
    packed = [pa.array([pack(x)], pa.binary()) for x in (
        sizes.astype(np.int32), words[order], stream, counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays([pa.array([number]), *lists, *packed],
                                      ["chunk", "ids", "held", "sizes", "words", "stream", "counts"])


def _word_requests(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, words, counts in zip(*(batch.column(c).to_pylist() for c in ("chunk", "words", "counts"))):
                words, counts = unpack(words, np.uint64), unpack(counts, np.int64)
                for bucket, at in _dealt(_word_bucket(words, buckets), buckets):
                    yield _row(None, bucket, chunk, [pack(words[at]), pack(counts[at])])

    return run


def _word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(buckets)).astype(np.int64)


def _dealt(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in order) for every bucket that something falls into."""
    order = np.argsort(bucket.astype(np.uint16), kind="stable")  # 16 bits are sorted by their digits
    cuts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, order[cuts[b]:cuts[b + 1]]


def distinct(values: np.ndarray) -> np.ndarray:
    """Each of the sorted values once."""
    first = np.ones(len(values), dtype=bool)
    first[1:] = values[1:] != values[:-1]
    return values[first]


def numbered(place: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Numbers of what stands at these places, from 0, of a bucket."""
    return (place + 1) * buckets + bucket


def next_bucket(numbers: np.ndarray, buckets: int) -> np.ndarray:
    """Where the n-grams with these histories are counted: a bucket's histories are dealt round."""
    return numbers // buckets % buckets


def pack_numbers(numbers: np.ndarray, buckets: int) -> bytes:
    """Sorted numbers that have one next bucket, without gaps for those of the others."""
    return pack_steps(numbers // buckets // buckets * buckets + numbers % buckets)


def unpack_numbers(data: bytes, bucket: int, buckets: int) -> np.ndarray:
    dense = unpack_steps(data)
    return (dense // buckets * buckets + bucket) * buckets + dense % buckets


def pack_steps(numbers: np.ndarray) -> bytes:
    return pack(np.diff(numbers, prepend=np.int64(0)))


def unpack_steps(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.int64))


def pack_lists(numbers: np.ndarray, owner: np.ndarray) -> bytes:
    """A sorted list of numbers for each owner, one after the other, as steps within the lists."""
    steps = numbers.copy()
    steps[1:] -= np.where(owner[1:] == owner[:-1], numbers[:-1], 0)
    return pack(steps)


def unpack_lists(data: bytes, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(unpack(data, np.int64))])
    return total[1:] - np.repeat(total[np.cumsum(sizes) - sizes], sizes)


def _row(kind, bucket, chunk, numbers, sums=()) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": kind, "bucket": bucket, "chunk": chunk, "numbers": numbers,
                                        "sums": list(sums)}], schema=_TYPES)


def _count_words(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        """The sums of one bucket: a table of words, how many were seen how often, and an answer to every chunk."""
        rows = table.select(["bucket", "chunk", "numbers"]).to_pylist()
        bucket = rows[0]["bucket"]
        asked = [unpack(r["numbers"][0], np.uint64) for r in rows]
        words, at = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(at, np.concatenate([unpack(r["numbers"][1], np.int64) for r in rows]), len(words))
        counts = np.rint(counts).astype(np.int64)
        order = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]  # frequent words get small numbers
        number = np.full(len(words), UNSEEN)
        number[order] = numbered(np.arange(len(order)), bucket, buckets)
        out = [_row("words", bucket, None, [pack(words[order]), pack(counts[order])]),
               _row("spectrum", bucket, None, [], [float(counts.sum()), float(len(order)), *spectrum(counts)])]
        cuts = np.cumsum([0, *map(len, asked)])
        for r, a, b in zip(rows, cuts, cuts[1:]):
            mine = counts[at[a:b]]
            out.append(_row("answers", bucket, r["chunk"], [pack(mine), pack(number[at[a:b]][mine > 0] // buckets)]))
        return pa.Table.from_batches(out)

    return run


@dataclass
class Level:
    """The distinct n-grams of one length in a chunk, by number: which one ends at each token (-1: it would begin before the
    start mark), their numbers, training counts, log10 chances, and what the counts of their history are divided by."""

    of: np.ndarray
    number: np.ndarray
    count: np.ndarray
    chance: np.ndarray
    divisor: np.ndarray

    def by_number(self) -> "Level":
        order = np.argsort(self.number)
        place = np.empty(len(order) + 1, dtype=np.int32)
        place[order], place[-1] = np.arange(len(order)), -1
        return Level(place[self.of], *(x[order] for x in (self.number, self.count, self.chance, self.divisor)))


class Chunk:
    """A chunk with the answers that it got so far."""

    def __init__(self, chunk: dict, told: dict[str, dict[int, list[bytes]]], buckets: int, starts: int, single: Unigrams):
        self.sizes = unpack(chunk["sizes"], np.int32).astype(np.int64)
        self.held = np.array(chunk["held"], dtype=bool)
        self.first = np.cumsum(self.sizes) - self.sizes
        words = unpack(chunk["words"], np.uint64)
        count, number = np.zeros(len(words) + 1, dtype=np.int64), np.full(len(words) + 1, UNSEEN)
        for bucket, at in _dealt(_word_bucket(words, buckets), buckets):
            found = told["words"][bucket]
            count[at] = unpack(found[0], np.int64)
            number[at[count[at] > 0]] = unpack(found[1], np.int64) * buckets + bucket
        count[-1], number[-1] = starts, START
        self.lowest = Level(unpack(chunk["stream"], np.int32), number, count, np.log10(single.chance(count)),
                            np.full(len(count), float(single.all))).by_number()


class Grams:
    """The distinct n-grams of a chunk that are one word longer than those of ``below``, and how they are dealt to buckets.

    Histories are n-grams of ``below`` and so are the n-grams without their first word (``low``).
    Asked are those whose two shorter ones were both seen in training.
    """

    def __init__(self, chunk: Chunk, below: Level, hot: float, buckets: int):
        self.below, self.pairs, words = below, below is chunk.lowest, chunk.lowest
        before = np.empty_like(below.of)
        before[1:] = below.of[:-1]
        before[chunk.first] = 0 if self.pairs else -1  # the start mark has the smallest number
        self.valid = before >= 0
        keys = before[self.valid].astype(np.int64) << 32 | words.of[self.valid]
        del before
        keys, of = np.unique(keys, return_inverse=True)
        self.of = np.full(len(words.of), -1, dtype=np.int32)
        self.of[self.valid] = of
        self.history, self.word = (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32)
        self.low = np.empty(len(keys), dtype=np.int32)
        self.low[of] = below.of[self.valid]
        asked = (below.count[self.history] > 0) & (below.count[self.low] > 0)
        self.asked = np.flatnonzero(asked)
        self.weighed = np.zeros(len(below.count), dtype=bool)  # histories with a word here that was not seen after them
        self.weighed[self.history[~asked]] = True
        self.hot = below.count > hot
        if self.pairs:
            self.hot[0] = True
        h = self.history[self.asked]
        self.bucket, at = next_bucket(below.number[h], buckets), np.flatnonzero(self.hot[h])
        gram = mix(below.number[h[at]].view(np.uint64)) + words.number[self.word[self.asked[at]]].view(np.uint64)
        self.bucket[at] = (mix(gram) % np.uint64(buckets)).astype(np.int64)
        alone = distinct(self.history)
        self.single = alone[(below.count[alone] > 0) & ~self.hot[alone]]  # histories whose sums are asked

    def requests(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, asked n-grams, histories whose sums are asked and their hot histories), all by number, as the answers are."""
        none = np.zeros(0, dtype=np.int64)
        grams, singles = (dict(_dealt(b, buckets)) for b in (self.bucket, next_bucket(self.below.number[self.single], buckets)))
        for bucket in sorted({*grams, *singles}):
            asked = self.asked[grams.get(bucket, none)]
            hot = self.history[asked]
            hot = distinct(hot[self.hot[hot]])
            yield bucket, asked, np.sort(np.concatenate([self.single[singles.get(bucket, none)], hot]))

    def scored(self, back: dict[int, list[bytes]], buckets: int, discount: np.ndarray, low_discount: np.ndarray,
               hot_sums: dict[int, np.ndarray]) -> Level:
        """These n-grams with their counts and chances, from the answers."""
        below, times, number = self.below, np.zeros(len(self.history), dtype=np.int64), np.full(len(self.history), UNSEEN)
        total, left, low = np.zeros((3, len(below.count)))
        told = self.hot.copy()
        for bucket, asked, histories in self.requests(buckets):
            found, mine = back[bucket], histories[~self.hot[histories]]
            times[asked] = unpack(found[0], np.int64)
            if found[1]:
                number[asked[times[asked] > 0]] = unpack_steps(found[1]) * buckets + bucket
            partly = mine[np.unpackbits(unpack(found[2], np.uint8), count=len(mine)).astype(bool)]
            told[partly] = True
            self.weighed[self.history[asked[times[asked] == 0]]] = True
            whole, light = partly[self.weighed[partly]], partly[~self.weighed[partly]]
            sums = np.column_stack([unpack(x, np.int64) for x in found[5:]])
            total[whole], left[whole], low[whole] = worth(sums, discount, low_discount)
            total[light], least = unpack(found[3], np.int64), unpack(found[4], np.int64)
            left[light] = np.where(least <= SMALL, 1 - discount[np.minimum(least, SMALL)], 0)  # more than nothing, or nothing
        mine = np.flatnonzero((times > 0) & ~told[self.history])  # nothing else was seen after these histories
        owner, n = self.history[mine], len(total)
        total += np.bincount(owner, times[mine], n)
        left += np.bincount(owner, times[mine] - taken(times[mine], discount), n)
        low += np.bincount(owner, taken(below.count[self.low[mine]], low_discount), n)
        for i in np.flatnonzero(self.hot):
            sums = hot_sums.get(int(below.number[i]), np.zeros(2 * SMALL + 2))
            total[i], left[i], low[i] = (x[0] for x in worth(sums[None], discount, low_discount))
        low_divisor = np.ones(n)
        low_divisor[self.history] = below.divisor[self.low]  # the same for all words after a history
        divisor, weight = backoff(total, left, low / low_divisor)
        divisor = divisor[self.history]
        chance = below.chance[self.low] + np.where(below.count[self.history] > 0, np.log10(weight[self.history]), 0)
        seen = times > 0
        chance[seen] = np.log10(taken(times[seen], discount)) - np.log10(divisor[seen])
        return Level(self.of, number, times, chance, divisor)


def tally(owner: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """For each of n owners: how many counts are 1 .. SMALL, and the sum of the larger ones."""
    at = owner * (SMALL + 1) + np.minimum(counts, SMALL + 1) - 1
    return np.bincount(at, np.where(counts <= SMALL, 1, counts), n * (SMALL + 1)).astype(np.int64).reshape(n, SMALL + 1)


def worth(sums: np.ndarray, discount: np.ndarray, low_discount: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all counts, what discounts take off them, what is left of the counts below) from tallies of both."""
    counts, low = sums[:, :SMALL + 1], sums[:, SMALL + 1:]
    return (counts[:, :SMALL] @ TIMES + counts[:, SMALL], counts[:, :SMALL] @ (TIMES * (1 - discount[1:])),
            low[:, :SMALL] @ (TIMES * low_discount[1:]) + low[:, SMALL])


def taken(counts: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """What is left of counts after their discounts."""
    return np.where(counts <= SMALL, discount[np.minimum(counts, SMALL)], 1) * counts


@dataclass
class Known:
    """What all tasks need of the lengths counted so far: of each its discounts and the sums of its hot histories."""

    buckets: int
    starts: int
    single: Unigrams
    hot: float
    discount: list[np.ndarray]
    hot_sums: list[dict[int, np.ndarray]]

    def levels(self, chunk: dict, answers: list[dict]) -> tuple[Chunk, list[Level]]:
        """The chunk's n-grams of every length that has been answered, shortest first."""
        told: dict[str, dict[int, list[bytes]]] = {}
        for r in answers:
            told.setdefault(r["kind"], {})[r["bucket"]] = r["numbers"]
        whole = Chunk(chunk, told, self.buckets, self.starts, self.single)
        out, low_discount = [whole.lowest], self.single.discount
        for n, (discount, hot_sums) in enumerate(zip(self.discount, self.hot_sums), 2):
            grams = Grams(whole, out[-1], self.hot, self.buckets)
            out.append(grams.scored(told.get(_kind(n), {}), self.buckets, discount, low_discount, hot_sums).by_number())
            low_discount = discount
        return whole, out


def _kind(n: int) -> str:
    return {1: "words", 2: "pairs"}.get(n, f"grams_{n}")


def _gram_requests(known: Known):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out, told = [], answers.to_pylist()
        for chunk in chunks.to_pylist():
            whole, levels = known.levels(chunk, told)
            below, words = levels[-1], whole.lowest.number
            del levels
            grams = Grams(whole, below, known.hot, known.buckets)
            trained = np.repeat(~whole.held, whole.sizes) & grams.valid
            times = np.bincount(grams.of[trained], minlength=len(grams.history))
            for bucket, asked, histories in grams.requests(known.buckets):
                owner, hot = np.searchsorted(histories, grams.history[asked]), grams.hot[histories]
                number = below.number[histories]
                low = distinct(np.sort(grams.low[asked])) if grams.pairs else grams.low[asked]  # that of a pair is its word
                out.append(_row(None, bucket, chunk["chunk"], [
                    pack_numbers(number[~hot], known.buckets), pack_steps(number[hot]), pack(np.packbits(hot)),
                    pack(np.packbits(grams.weighed[histories])),
                    pack(np.bincount(owner, minlength=len(histories))), pack_lists(words[grams.word[asked]], owner),
                    pack(below.count[low]), pack(times[asked].astype(np.int64))]))
        return pa.Table.from_batches(out, schema=_TYPES)

    return run


def _asked(numbers: list[bytes], bucket: int, buckets: int, pairs: bool) -> tuple[np.ndarray, ...]:
    """(histories, whether they are hot, whether weighed, the place of each n-gram's history, its word, its count without the
    first word, its count)"""
    cold, warm = unpack_numbers(numbers[0], bucket, buckets), unpack_steps(numbers[1])
    hot, weighed = (np.unpackbits(unpack(x, np.uint8), count=len(cold) + len(warm)).astype(bool) for x in numbers[2:4])
    histories = np.empty(len(hot), dtype=np.int64)
    histories[~hot], histories[hot] = cold, warm
    sizes = unpack(numbers[4], np.int64)
    words, low = unpack_lists(numbers[5], sizes), unpack(numbers[6], np.int64)
    if pairs:
        low = low[np.unique(words, return_inverse=True)[1]]
    return histories, hot, weighed, np.repeat(np.arange(len(hot)), sizes), words, low, unpack(numbers[7], np.int64)


def _count_grams(n: int, buckets: int, last: bool):
    """Counts of n-grams; the ``last`` are no histories and need no numbers."""

    def run(table: pa.Table) -> pa.Table:
        """The sums of one bucket's n-grams and of its histories."""
        rows = table.select(["bucket", "chunk", "numbers"]).to_pylist()
        bucket = rows[0]["bucket"]
        parts = [_asked(r.pop("numbers"), bucket, buckets, n == 2) for r in rows]
        join = lambda i: np.concatenate([p[i] for p in parts])
        histories, place = np.unique(join(0), return_inverse=True)
        cuts = np.cumsum([0, *(len(p[0]) for p in parts)])
        words = join(4)
        bits = int(words.max(initial=0)).bit_length()
        keys = np.concatenate([place[a + p[3]] for a, p in zip(cuts, parts)]) << bits | words
        del words
        keys, of = np.unique(keys, return_inverse=True)
        low = np.empty(len(keys), dtype=np.int64)
        low[of] = join(5)
        counts = np.rint(np.bincount(of, join(6), len(keys))).astype(np.int64)
        seen = counts > 0
        local = np.cumsum(seen)  # numbers without the bucket
        owner, words = (keys >> bits)[seen], (keys & (1 << bits) - 1)[seen]
        sums = np.hstack([tally(owner, counts[seen], len(histories)), tally(owner, low[seen], len(histories))])
        total = np.bincount(owner, counts[seen], len(histories)).astype(np.int64)
        least = np.argmax(sums[:, :SMALL + 1] > 0, axis=1) + 1  # of the counts after a history, SMALL + 1 for larger ones
        hot = np.zeros(len(histories), dtype=bool)
        hot[place[join(1)]] = True
        out = [_row(_kind(n), bucket, None, [pack_steps(histories[owner]), pack_lists(words, owner), pack(counts[seen])]),
               _row("spectrum", bucket, None, [], spectrum(counts)),
               _row("hot", bucket, None, [pack(histories[hot])], sums[hot].ravel().astype(float))]
        a = 0
        for r, part, start in zip(rows, parts, cuts):
            b = a + len(part[6])
            mine, times, cold, weighed = place[start:start + len(part[0])], counts[of[a:b]], ~part[1], part[2]
            partly = np.bincount(part[3], times, len(mine)) < total[mine]
            weighed[part[3][times == 0]] = True
            light = mine[partly & cold & ~weighed]
            out.append(_row("answers", bucket, r["chunk"], [
                pack(times), b"" if last else pack_steps(local[of[a:b]][times > 0]), pack(np.packbits(partly[cold])),
                pack(total[light]), pack(least[light]), *map(pack, sums[mine[partly & cold & weighed]].T)]))
            a = b
        return pa.Table.from_batches(out, schema=_TYPES)

    return run


def backoff(total: np.ndarray, left: np.ndarray, mass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor, weight) per history: what counts are divided by, and a(h), which makes the chances of all words one.

    Given are all counts, what discounts take off them, and the chances without the first word of the words that were seen.
    """
    none = left <= 0
    left, total = np.where(none, 1.0, left), np.where(none, total + 1, total)
    return total, left / total / (1 - mass)


def _scores(known: Known):
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
    single = known.single

    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        out, told = [], answers.to_pylist()
        for chunk in chunks.to_pylist():
            whole, levels = known.levels(chunk, told)
            value = levels[0].chance[levels[0].of]
            for level in levels[1:]:
                reached = level.of >= 0
                value[reached] = level.chance[level.of[reached]]
            n, text = len(whole.sizes), np.repeat(np.arange(len(whole.sizes)), whole.sizes)
            count = whole.lowest.count[whole.lowest.of]
            base = np.log10((count + 1) / (single.tokens + single.words + 1))
            columns = [pa.array(chunk["ids"], pa.int64()), pa.array(whole.held), pa.array(whole.sizes),
                       pa.array(np.bincount(text, count > 0, n).astype(np.int64)),
                       pa.array(np.full(n, single.tokens)), pa.array(np.bincount(text, base, n)),
                       pa.array(np.bincount(text, value, n))]
            out.append(pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types)], names))
        return pa.Table.from_batches(out, schema=pa.schema(list(zip(names, types))))

    return run


def train_and_score(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2,
                    hot: float = 0.25, order: int = 2) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) per row; the counts stay under ``path``."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"),
                       (crc_fold(key, folds) == held_out).alias("held"))
    name = f"katz_chunks_{uuid.uuid4().hex}"
    chunks = slim.mapInArrow(_chunks, "chunk long, ids array<long>, held array<boolean>, sizes binary, words binary, "
                                      "stream binary, counts binary")
    chunks.write.bucketBy(partitions, "chunk").option("compression", "none").option("path", f"{path}/chunks").saveAsTable(name)
    try:
        out = _scored(spark, spark.table(name), slim, path, partitions, hot, order)
    finally:
        spark.sql(f"DROP TABLE {name}")
    return out.withColumnRenamed("id", key)


def _scored(spark: SparkSession, chunks: DataFrame, slim: DataFrame, path: str, partitions: int, hot: float,
            order: int) -> DataFrame:
    """The scores of all chunks, written. A group is handled whole in a task, so the number of groups grows with the bytes asked."""
    asked_bytes = chunks.agg(F.sum(F.octet_length("words") + F.octet_length("counts") + F.octet_length("stream"))).first()[0]
    buckets = max(2 * partitions, min(GROUPS, int(asked_bytes or 0) // GROUP_BYTES))

    asked = chunks.select("chunk", "words", "counts").mapInArrow(_word_requests(buckets), ANSWERS)
    words = _stored(asked.groupBy("bucket").applyInArrow(_count_words(buckets), ANSWERS), f"{path}/words")
    told = [r[0] for r in _spectrum(words, SMALL + 3)]
    single = Unigrams(int(told[0]), int(told[1]), discounts(np.array(told[2:])), np.array(told[2:]))
    most = single.tokens / (2 * partitions) * hot
    known = Known(buckets, slim.where("NOT held").count(), single, most, [], [])

    answers = _told(words, 1)
    stream = chunks.select("chunk", "ids", "held", "sizes", "words", "stream")
    for n in range(2, order + 1):
        asked = stream.drop("ids").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_gram_requests(known), ANSWERS)
        grams = _stored(asked.groupBy("bucket").applyInArrow(_count_grams(n, buckets, n == order), ANSWERS), f"{path}/{_kind(n)}")
        discount = discounts(np.array([r[0] for r in _spectrum(grams, SMALL + 1)]))
        # hot histories: at most 2 * partitions / hot n-grams and the start mark, so their sums fit every task
        hot_sums: dict[int, np.ndarray] = {}
        for r in grams.where("kind = 'hot' AND size(sums) > 0").select("numbers", "sums").toLocalIterator():
            mine = np.array(r["sums"]).reshape(-1, 2 * SMALL + 2)
            for history, sums in zip(unpack(bytes(r["numbers"][0]), np.int64).tolist(), mine):
                hot_sums[history] = hot_sums.get(history, 0) + sums
        known = Known(buckets, known.starts, single, most, [*known.discount, discount], [*known.hot_sums, hot_sums])
        answers = answers.unionByName(_told(grams, n))

    scores = stream.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _scores(known),
        "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return written(scores, scratch_dir(spark, "katz-scores"))


def _told(rows: DataFrame, n: int) -> DataFrame:
    return rows.where("kind = 'answers'").select("bucket", "chunk", "numbers").withColumn("kind", F.lit(_kind(n)))


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """The sums of all buckets as a table with a folder per kind; its numbers are packed already."""
    rows.write.partitionBy("kind").option("compression", "none").parquet(path)
    return rows.sparkSession.read.schema(ANSWERS).parquet(path)


def _spectrum(rows: DataFrame, n: int) -> list:
    some = rows.where("kind = 'spectrum'").select(F.posexplode("sums").alias("at", "sum"))
    found = {r["at"]: r["sum"] for r in some.groupBy("at").agg(F.sum("sum").alias("sum")).collect()}
    return [(found.get(i, 0.0),) for i in range(n)]
