"""Prefix tries, fill-in-the-middle and token counts against plain versions."""

import hashlib
import math
import random
import re
import zlib

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.llm import fill_in_middle, prefix_trie, token_counts
from tallybook.llm.common import text_bytes
from tallybook.llm.queries import BPE_JSON

from helpers import rows_of

DOCS = "text string, row string, doc_id long, id long, piece string"
CONVERSATIONS = "role string, conv_id long, depth string, text string, turn long, prefix string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_trie(rows):
    """Every node from the sets of rebuilt conversations that begin with it."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())} {role}{text}".encode()).hexdigest()
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), role, tie, text))
    turns = {c: [(role, text) for _, role, _, text in sorted(of)] for c, of in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = (*turns.get(c - int(math.fmod(c, 20)), [])[:h], *own[h:])
    members = {}
    for c, of in rebuilt.items():
        for depth in range(len(of) + 1):
            members.setdefault(of[:depth], []).append(c)
    children, leaves, saved = ({node: 0 for node in members} for _ in range(3))
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, of in members.items():
        words = len(re.findall("[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(of) - 1) * words
    return sorted(((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), children[node], leaves[node], saved[node],
                    sha(",".join(str(c) for c in sorted(of) if len(rebuilt[c]) == len(node)))) for node, of in members.items()),
                  key=lambda row: [(v is None, str(v)) for v in row])


def conversations(spark, rows):
    return spark.createDataFrame([(role, conv, "x", text, turn, "y") for conv, turn, role, text in rows], CONVERSATIONS)


def test_trie_of_odd_conversations(spark):
    rows = [(0, 1, "user", "a b"), (0, None, None, None), (0, 1, "user", "a b"), (0, 1, "user", "a"), (0, 2, "", "long " * 20_000),
            (7, 0, "user", "own one"), (7, 1, "user", "own two"), (7, 2, "u", "three"), (7, 3, "u", "four\x0bfive"),
            (None, 0, "user", "of nobody"), (41, 0, "user", "no family"), (60, 5, "ab", "c"), (61, 5, "a", "bc"),
            (-3, 0, "user", "below zero"), (-20, 0, "user", "below zero"), (-39, 3, "x", ""), (100, 1, None, "")]
    assert rows_of(prefix_trie.prefix_trie(conversations(spark, rows))) == plain_trie(rows)
    nothing = prefix_trie.prefix_trie(conversations(spark, []))
    assert nothing.columns[:3] == ["conv_id", "depth", "parent_conv_id"] and nothing.count() == 0
    only_empty = [(c, 0, "u", "gone") for c in range(1, 400) if zlib.crc32(str(c).encode()) % 4 and c % 20]  # no turns left
    assert len(plain_trie(only_empty)) == 1
    assert rows_of(prefix_trie.prefix_trie(conversations(spark, only_empty))) == plain_trie(only_empty)


@pytest.mark.parametrize("block", [1, 7, 60, 10**6])
def test_trie_across_edges(spark, monkeypatch, block):
    """Copies, long and hot conversations, cut between any two of them."""
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", block)
    monkeypatch.setattr(prefix_trie, "ENDS", 3)
    pick = random.Random(block)
    rows = [(c, t, "user", pick.choice(["a", "b c", "b c d"])) for c in range(150) for t in range(pick.randrange(1, 6))]
    rows += [(c, t, "user", "hot copy") for c in range(200, 300) for t in range(5)]
    rows += [(c, t, "bot", f"step {t}") for c in (400, 401, 402) for t in range(45 + c % 2)]
    assert rows_of(prefix_trie.prefix_trie(conversations(spark, rows))) == plain_trie(rows)


def test_block_orders_any_rows():
    import numpy as np

    pick = random.Random(3)
    seqs = [tuple((pick.randrange(1, 3), pick.randrange(1, 3)) for _ in range(pick.choice([0, 1, 2, 3, 20, 40]))) for _ in range(200)]
    convs = np.array(pick.sample(range(1000), 200))
    ids = np.array([turn for seq in seqs for turn in seq], np.uint64).reshape(-1, 2)
    block = prefix_trie.Block(convs, ids, np.array([len(s) for s in seqs]), np.ones(len(ids), np.int64))
    wanted = sorted(zip(seqs, convs.tolist()))
    assert block.convs.tolist() == [c for _, c in wanted]
    for (a, _), (b, _), n in zip(wanted, wanted[1:], block.before[1:].tolist()):
        assert a[:n] == b[:n] and (n == min(len(a), len(b)) or a[n] != b[n])


def plain_middle(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:first], units[first:second], units[second:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    spm = h4 % 100 < 20
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, "spm" if spm else "psm", len(prefix), len(middle), sha(output), sha(text)


@pytest.mark.parametrize("units", [2, 4096])
def test_middle_of_odd_texts(spark, monkeypatch, units):
    monkeypatch.setattr(fill_in_middle, "UNITS", units)
    monkeypatch.setattr(fill_in_middle, "ROWS_PER_BATCH", 5)
    odd = ["", None, "a", " ", "<P", "<S>", "x<M>y", "<", "é漢🙂 a1b", "ends in <S", "<<>P><", "one  two\n\nthree\t", "abc" * 2000, "x y" * 900]
    rows = [(i % 31 if i % 7 else None, odd[i % len(odd)]) for i in range(150)] + [(5, "same"), (5, "same"), (None, "same")]
    docs = spark.createDataFrame([(text, "r", doc_id, 9, "p") for doc_id, text in rows], DOCS)
    wanted = sorted((plain_middle(*row) for row in rows), key=lambda row: [(v is None, str(v)) for v in row])
    assert rows_of(fill_in_middle.transform(docs)) == wanted
    assert {row[2] for row in wanted} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(docs.limit(0)).collect() == []
    named = fill_in_middle.transform(docs.selectExpr("doc_id AS row", "text AS place"), "row", "place")
    assert named.columns[0] == "row" and rows_of(named) == wanted
    words = fill_in_middle.transform(docs.selectExpr("'abc' AS doc_id", "text"))
    assert rows_of(words) == sorted((plain_middle("abc", text) for _, text in rows), key=lambda row: [(v is None, str(v)) for v in row])


@settings(max_examples=300, deadline=None)
@given(st.text("<PSM>a é", max_size=12), st.text("<PSM>a é", max_size=12), st.text("<PSM>a é", max_size=12), st.data())
def test_reader_finds_the_parts_wherever_pieces_end(prefix, middle, suffix, data):
    whole = prefix + middle + suffix
    if any(m in whole for m in ("<P>", "<S>", "<M>")):
        return
    form = data.draw(st.sampled_from(["psm", "spm"]))
    parts = {"prefix": prefix.encode(), "middle": middle.encode(), "suffix": suffix.encode()}
    output = b"".join(fill_in_middle.MARKERS[part] + parts[part] for part in fill_in_middle.ORDERS[form])
    cuts = sorted(data.draw(st.lists(st.integers(0, len(output)), max_size=6)))
    reader, found = fill_in_middle.Reader(form), dict.fromkeys(parts, b"")
    for a, b in zip([0, *cuts], [*cuts, len(output)]):
        for part, run in reader(output[a:b]):
            found[part] += run
    for part, run in reader(b"", last=True):
        found[part] += run
    assert found == parts


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(BPE_JSON)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    counts = token_counts.Counter(BPE_JSON, token_counts.character_classes())
    return lambda texts: counts(*text_bytes(pa.array(texts, pa.large_string()))).tolist()


ODD_TEXTS = ["it's we're I'll 'sam '' 's 'r", "'r", "'", "a  b\n\nc  \n d   ", "", None, "<|endoftext|>", "<|endoftext", "|>",
             "end <|endoftext|> next<|endoftext|><|endoftext|>x", " \t　x", "'ve'l'll'lx'v'vexe", "  ", "123 456'd7", "é'su", "don't''t",
             "a" * 30_000, "ab" * 9_000, " " * 3_000, "=-" * 2_000, "\x00\x01", "漢字かな交じり文", "é", "🙂👍🏽", " x y\u0085z"]


def test_counts_of_odd_texts(library, counter):
    assert counter(ODD_TEXTS) == library(ODD_TEXTS)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8") | st.sampled_from(" \n\t'strevmldé漢.,aA1<|>"), max_size=60), max_size=8))
def test_counts_of_any_text(library, counter, rows):
    assert counter(rows) == library(rows)


def test_counts_of_every_character(library, counter):
    """Each code point beside a letter, a digit, a mark and white space."""
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    rows = ["".join(f"{c}a{c}1{c}!{c} {c}\n" for c in points[i:i + 500]) for i in range(0, 60_000, 500)]
    assert counter(rows) == library(rows)


def test_states_and_words_are_forgotten(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_STATES", 50)
    monkeypatch.setattr(token_counts, "KEPT_WORDS", 20)
    pick = random.Random(1)
    rows = [" ".join("".join(pick.choices("etaoin", k=pick.randrange(1, 15))) for _ in range(40)) for _ in range(30)]
    counts = token_counts.Counter(BPE_JSON, token_counts.character_classes())
    told = [counts(*text_bytes(pa.array(rows[i:i + 3], pa.large_string()))).tolist() for i in range(0, 30, 3)]
    assert sum(told, []) == library(rows) and len(counts.words.states) < 500


def test_chunk_maps_give_the_entry_states(counter):
    """The prefix scan against a run from the first character on."""
    import numpy as np

    going, emitted = token_counts.word_transducer()
    kinds = np.random.default_rng(2).integers(0, token_counts.CLASSES, 5000).astype(np.uint8)
    state, starts = token_counts.BEGIN, np.zeros(5001, bool)
    for i, kind in enumerate([*kinds.tolist(), token_counts.END]):
        told, state = emitted[kind, state], going[kind, state]
        starts[i] |= bool(told & token_counts.HERE)
        starts[i - 1] |= bool(told & token_counts.BEFORE)
    assert (token_counts.word_starts(kinds) == starts[:5000]).all()


def test_counts_of_a_table(spark, library, sf_dir):
    odd = spark.createDataFrame([(t, "r", i % 3 or None, 9, "p") for i, t in enumerate(ODD_TEXTS * 2)], DOCS)
    docs = odd.unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), allowMissingColumns=True)
    rows = docs.select("doc_id", "text").collect()
    wanted = sorted(((r.doc_id, len((r.text or "").encode()), n, n > 512) for r, n in zip(rows, library([r.text for r in rows]))),
                    key=lambda row: [(v is None, str(v)) for v in row])
    assert rows_of(token_counts.count_tokens(docs, BPE_JSON)) == wanted
    assert token_counts.count_tokens(docs.limit(0), BPE_JSON).collect() == []


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Counter(public_tokenizers.path("word_bpe_49k.json"), token_counts.character_classes())
