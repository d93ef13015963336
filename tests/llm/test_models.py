"""The quality classifier and the language model."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import katz, quality_fm
from tallybook.llm.common import crc_fold
from tallybook.llm.queries import QUERIES


def test_the_pair_sum_is_that_of_all_pairs():
    rng = np.random.default_rng(3)
    size = (1 << quality_fm.WORD_BITS) + quality_fm.STATISTICS
    machine = quality_fm.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, quality_fm.FACTORS)), np.zeros(1), np.ones(1))
    feature, value = rng.integers(0, size, 9), rng.normal(size=9)
    plain = 0.3 + sum(machine.weights[f] * v for f, v in zip(feature, value)) + sum(
        machine.factors[feature[i]] @ machine.factors[feature[j]] * value[i] * value[j] for i in range(9) for j in range(i))
    margin, _ = machine.margin(np.zeros(9, dtype=int), feature, value, 1)
    assert margin[0] == pytest.approx(plain)


def test_held_out_quality(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op3_fm_quality"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.predicted == r.quality for r in held)
    assert right >= 0.95 * len(held)
    low, high = ([r.score for r in held if r.quality == q] for q in (0, 1))
    assert sum(a < b for a in low for b in high) >= 0.97 * len(low) * len(high)


def test_quality_of_odd_rows(spark):
    rows = [(i, "a plain text of words " * (i % 5 + 1) if i % 2 else "SHOUT!! " * 20) for i in range(60)]
    odd = [(None, "no id"), (100, None), (101, ""), (102, "x" * 200_000), (1, rows[1][1]), (103, "\n\n\n"), (104, "é ü")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows + odd], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1), (None, 0), (3, None)], "doc_id long, quality int")
    machine = quality_fm.fit(docs, labels)
    found = quality_fm.score(docs.drop("score"), machine).collect()
    assert len(found) == len(rows + odd) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.score for r in found}
    assert all((by_id[i] > 0.5) == bool(i % 2) for i in range(60))
    again = quality_fm.fit(docs.repartition(5), labels.repartition(3))
    assert np.allclose(again.weights, machine.weights)
    assert quality_fm.score(docs.limit(0), machine, name="_s").count() == 0
    nothing = quality_fm.fit(docs, labels.limit(0))
    assert {r["_s"] for r in quality_fm.score(docs, nothing, name="_s").collect()} == {0.5}


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, f"text {i} of words") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    turned = labels.withColumn("quality", F.when(crc_fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = quality_fm.fit(docs, labels), quality_fm.fit(docs, turned)
    assert np.array_equal(one.weights, other.weights) and one.bias == other.bias


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x20\x09-\x0D]+", lower) + ["\0end"]


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class PlainKatz:
    def __init__(self, rows, order):
        self.seen = [Counter() for _ in range(order)]  # by length, keyed (history, word)
        for doc_id, text in rows:
            if not held_out(doc_id):
                for history, w in self.places(tokens(text)):
                    for k in range(min(order, len(history) + 1)):
                        self.seen[k][history[len(history) - k:], w] += 1
        self.order, self.one = order, Counter({w: c for (_, w), c in self.seen[0].items()})
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.d = [katz.discounts(np.array([sum(v == c for v in counts.values()) for c in range(1, katz.SMALL + 2)]))
                  for counts in self.seen]
        self.after = [defaultdict(dict) for _ in self.seen]
        for after, counts in zip(self.after, self.seen):
            for (h, w), c in counts.items():
                after[h][w] = c
        self.weights = {}

    @staticmethod
    def places(words):
        marked = ["\0start", *words]
        return [(tuple(marked[:i + 1]), w) for i, w in enumerate(words)]

    def _less(self, d, c):
        return c * d[c] if c <= katz.SMALL else c

    def _history(self, h):
        """What counts after h are divided by, and what is left over."""
        if h not in self.weights:
            seen, d = self.after[len(h)][h], self.d[len(h)]
            total, taken = sum(seen.values()), sum(self._less(d, c) for c in seen.values())
            total = total if total - taken > 1e-9 else total + 1
            left = (total - taken) / total
            self.weights[h] = total, left / (1 - sum(self.chance(h[1:], w) for w in seen)) if h else left
        return self.weights[h]

    def chance(self, h, w):
        h = h[max(0, len(h) - self.order + 1):]
        if h not in self.after[len(h)] and h:
            return self.chance(h[1:], w)
        total, weight = self._history(h)
        if w in self.after[len(h)][h]:
            return self._less(self.d[len(h)], self.after[len(h)][h][w]) / total
        return weight * self.chance(h[1:], w) if h else weight


def sample_rows():
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    return [(i, " ".join(words[i * 20:i * 20 + rng.randint(0, 40)]).replace("w1 ", "W1\t")) for i in range(180)]


@pytest.mark.parametrize("hot, order", [(0.25, 2), (0.0001, 2), (1e9, 2), (0.25, 3), (0.0001, 3), (1e9, 3), (0.01, 4), (0.25, 1)])
def test_scores_are_those_of_a_plain_model(spark, tmp_path, monkeypatch, hot, order):
    monkeypatch.setattr(katz, "CHUNK", 2000)
    rows = sample_rows() + [(None, "w1 w2"), (500, None), (501, ""), (502, "never seen " * 30), (3, "w1 w1 w1"), (3, "w1 w1 w1"),
                            (503, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(4)
    found = katz.train_and_score(docs, str(tmp_path / "m"), hot=hot, order=order).collect()
    model = PlainKatz(rows, order)
    for h in [("\0start",), ("w1",), ("w2",), ("\0none",), ("w1", "w1"), ("\0start", "w1"), ("w2", "w1", "w1"), ("\0none", "w1")]:
        assert sum(model.chance(h, w) for w in model.one) + model.chance(h, "\0none") == pytest.approx(1, abs=1e-9)
    plain = sorted((str(i), held_out(i), len(t := tokens(text)), sum(w in model.one for w in t), model.n,
                    round(sum(math.log10((model.one.get(w, 0) + 1) / (model.n + model.v + 1)) for w in t), 6),
                    round(sum(math.log10(model.chance(h, w)) for h, w in model.places(t)), 6)) for i, text in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                  for r in found) == plain
    for kind in ["words", "pairs", "grams_3", "grams_4"][:order]:
        assert kind in {r.kind for r in spark.read.parquet(str(tmp_path / "m" / kind)).select("kind").distinct().collect()}
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("katz_chunks")]


def test_language_model_of_little(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert katz.train_and_score(empty, str(tmp_path / "a")).count() == 0
    only = next(i for i in range(100) if held_out(i))
    row = katz.train_and_score(spark.createDataFrame([(only, "a b")], "doc_id long, text string"), str(tmp_path / "b")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (3, 0, 0, 0.0, 0.0)


def test_discounts():
    d = katz.discounts(np.array([1000, 400, 200, 120, 80, 60]))
    assert (d[1:] < 1).all() and (d[1:] > 0).all()
    times = np.arange(1, 6)
    assert (np.array([1000, 400, 200, 120, 80]) * times * (1 - d[1:])).sum() == pytest.approx(1000)  # what singletons had
    assert katz.discounts(np.zeros(6))[1] == 0.5


def test_numbers_are_packed_densely():
    buckets, bucket = 24, 5
    numbers = katz.numbered(np.arange(24 * 4000), 3, buckets)
    mine = numbers[katz.next_bucket(numbers, buckets) == bucket]
    packed = katz.pack_numbers(mine, buckets)
    assert (katz.unpack_numbers(packed, bucket, buckets) == mine).all()
    assert len(packed) < len(mine)  # hashes took eight bytes each
    lists, owner = np.array([3, 9, 9000, 2, 7, 8]), np.array([0, 0, 0, 2, 2, 2])
    assert katz.unpack_lists(katz.pack_lists(lists, owner), np.array([3, 0, 3])).tolist() == lists.tolist()


def test_what_is_asked_and_told_takes_few_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK", 100_000)
    rng = random.Random(4)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(rng.paretovariate(0.6)) % 30_000}" for _ in range(300))) for i in range(600)],
                                 "doc_id long, text string").repartition(2)
    katz.train_and_score(docs, str(tmp_path / "m"), order=3)
    stored = sum(p.stat().st_size for kind in ("pairs", "grams_3") for p in (tmp_path / "m" / kind).rglob("*.parquet"))
    assert stored < 3 * 600 * 300
