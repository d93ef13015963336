"""Words, tokens, packing and personal data against plain versions."""

import base64
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tokenizers import Tokenizer

from tallybook.llm import byte_bpe, packing, pii_crf
from tallybook.llm import common
from tallybook.llm.queries import BPE_JSON, MULTI_RANKS

DOCS = "doc_id long, text string, ids string, score double"
ODD = [(1, "Hello, world's best  text\n\nnew line", "x", 0.5), (2, None, None, None), (3, "", "", 0.0), (None, "no id", "y", 1.0),
       (1, "Hello, world's best  text\n\nnew line", "x", 0.5), (4, "a" * 300_000, "long", 2.0),
       (5, "héllo 漢字 🙂 a b　c \x1c ´’s it’s It's", "mixed", 3.0), (6, "<|endoftext|> 12 345,6", "z", 1.0)]

texts = st.text(st.characters(codec="utf-8", exclude_characters="\x00") | st.sampled_from(" \n\t'sé漢.,aA1"), max_size=60)


def words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x20\x09-\x0D]+", lower)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | texts, max_size=6))
def test_words_are_hashed_like_a_plain_split(rows):
    hashes, lengths, first = common.word_hashes(*common.text_bytes(pa.array(rows, pa.string())))
    known = {}
    for i, text in enumerate(rows):
        plain = words(text)
        assert first[i + 1] - first[i] == len(plain)
        for word, h, n in zip(plain, hashes[first[i]:], lengths[first[i]:]):
            assert known.setdefault(word, h) == h and n == len(word.encode())
    assert len(set(known.values())) == len(known)


def test_words_longer_than_the_window(monkeypatch):
    rows = ["x" * 50 + " y", "x" * 50, "x" * 49 + "z"]
    monkeypatch.setattr(common, "WINDOW", 16)
    hashes, _, first = common.word_hashes(*common.text_bytes(pa.array(rows)))
    assert hashes[0] == hashes[first[1]] != hashes[first[2]]


def test_packed_integers_come_back():
    for kind in (np.uint8, np.int32, np.uint64):
        values = np.array([0, 1, 200, 7], dtype=kind)
        assert (common.unpack(common.pack(values), kind) == values).all()
        assert len(common.unpack(common.pack(values[:0]), kind)) == 0


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    with open(MULTI_RANKS, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.Encoder(byte_bpe.tokenizer_of_ranks(MULTI_RANKS))


@pytest.fixture(scope="module")
def own():
    return byte_bpe.Encoder(byte_bpe.tokenizer_of_json(BPE_JSON)), Tokenizer.from_file(BPE_JSON)


@settings(max_examples=300, deadline=None)
@given(rows=st.lists(texts, max_size=5))
def test_ids_are_those_of_the_rank_file(plain, encoder, rows):
    ids, upto = encoder(*common.text_bytes(pa.array(rows, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [plain.encode_ordinary(t) for t in rows]


@settings(max_examples=400, deadline=None)
@given(rows=st.lists(st.lists(texts | st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", "  ", " \n", "a"]), max_size=6).map("".join),
                     max_size=5))
def test_ids_are_those_of_the_tokenizer_file(own, rows):
    encoder, stock = own
    ids, upto = encoder(*common.text_bytes(pa.array(rows, pa.string())))
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [stock.encode(t, add_special_tokens=False).ids for t in rows]


def test_added_tokens_are_found_in_one_text_only(own):
    encoder, stock = own
    rows = ["end <|endoftext|> next", "<|endof", "text|>", "x  <|endoftext|>  y", "<|endoftext|>" * 3, ""]
    ids, upto = encoder(*common.text_bytes(pa.array(rows)))
    assert ids[:upto[1]].tolist() == [437, 220, 50256, 1306]
    assert [ids[a:b].tolist() for a, b in zip(upto, upto[1:])] == [stock.encode(t, add_special_tokens=False).ids for t in rows]


def test_encode_and_decode_odd_rows(spark, plain):
    docs = spark.createDataFrame(ODD, DOCS)
    load = lambda: byte_bpe.tokenizer_of_ranks(MULTI_RANKS)
    rows = byte_bpe.encode(docs, load).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        text = next(t for i, t, *_ in ODD if i == row.doc_id) or ""
        ids = plain.encode_ordinary(text)
        assert np.frombuffer(row.ids, "<u4").tolist() == ids and row.n_tokens == len(ids)
        starts, ends = np.frombuffer(row.starts, "<u4").tolist(), np.frombuffer(row.ends, "<u4").tolist()
        pieces = [plain.decode_single_token_bytes(i) for i in ids]
        for piece, a, b in zip(pieces, starts, ends):
            if piece.decode("utf-8", "replace").encode() == piece:
                assert text[a:b].encode() == piece
        assert "".join(byte_bpe.decoded_text(pieces)) == text
    report = {(r.doc_id, r.ids_sha256, r.decoded_sha256) for r in byte_bpe.tokens_report(docs, load).collect()}
    assert report == {(i, hashlib.sha256(np.array(plain.encode_ordinary(t or ""), "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ODD}
    told = {(r.doc_id, r.ids_sha256): (r.n_split, r.offsets_sha256) for r in byte_bpe.tokens_report(docs, load).collect()}
    for i, t, *_ in ODD:
        ids, at, starts, ends, split = plain.encode_ordinary(t or ""), 0, [], [], 0
        places = np.cumsum([0, *(len(c.encode()) for c in t or "")])  # where each character begins
        for piece in map(plain.decode_single_token_bytes, ids):
            starts.append(np.searchsorted(places, at, side="right") - 1)
            split += at not in places
            at += len(piece)
            ends.append(np.searchsorted(places, at, side="left"))
        digest = hashlib.sha256(np.array([*starts, *ends], "<u4").tobytes()).hexdigest()
        assert told[i, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()] == (split, digest)
    assert byte_bpe.tokens_report(docs.limit(0), load).count() == 0


def test_packing_keeps_every_id_once(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    rows = packing.pack(docs.where("doc_id <> 1"), lambda: byte_bpe.tokenizer_of_json(BPE_JSON), longest=64).collect()
    tokenizer = Tokenizer.from_file(BPE_JSON)
    for doc_id, text, *_ in ODD:
        if doc_id in (None, 1):
            continue
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        mine = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in mine) == np.array(ids, "<u4").tobytes()
        assert all(r.start == sum(m.length for m in mine[:k]) for k, r in enumerate(mine))
        assert all(r.length & (r.length - 1) == 0 and r.length <= 64 and r.offset == 0 for r in mine)
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.doc_tokens == len(ids) for r in mine)
        assert len({r.length for r in mine if r.length < 64}) == len([r for r in mine if r.length < 64])
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert [r.length for r in sorted(rows, key=lambda r: r.sequence_id)] == sorted(r.length for r in rows)  # buckets
    assert packing.pack(docs.limit(0), lambda: byte_bpe.tokenizer_of_json(BPE_JSON)).count() == 0


def test_buckets_hold_one_length(spark, tmp_path):
    docs = spark.createDataFrame(ODD, DOCS)
    pieces = packing.pack(docs, lambda: byte_bpe.tokenizer_of_json(BPE_JSON))
    packing.write_buckets(pieces, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.where("length * 4 <> octet_length(ids)").count() == 0 and back.count() == pieces.count()


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text)
            if 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and pii_crf.luhn(d)]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("01234@.+- ()a%\n5-é"), max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert pii_crf.base_spans(text) == plain_spans(text)


@pytest.fixture(scope="module")
def crf(spark):
    return pii_crf.train_table(pii_crf.labelled_table(spark))


def test_field_finds_what_it_has_not_seen(crf):
    rows = pii_crf.labelled_rows(copies=4, seed=99)
    found = pii_crf.field_spans([text for text, _ in rows], crf)
    asked, right, made = sum(len(s) for _, s in rows), 0, sum(map(len, found))
    for (_, spans), mine in zip(rows, found):
        right += len(set(spans) & set(mine))
    assert right >= 0.95 * asked and right >= 0.95 * made


def test_added_cards_pass_the_check(crf):
    texts = ["nter of 7086638319846192 the anen", "los se 9807915762804490 en esarbo.", "de 7536784127813050 4845168114407329 la",
             "card 4111 1111 1111 1112 is none", "amex 3782 822463 10005 is one", "visa 4111-1111-1111-1111, 12 of them"]
    found = [[t[a:b] for kind, a, b in spans if kind == "card"] for t, spans in zip(texts, pii_crf.field_spans(texts, crf))]
    assert found[0] == found[1] == found[3] == []
    assert found[4] == ["3782 822463 10005"] and found[5] == ["4111-1111-1111-1111"]


def test_viterbi_is_the_best_of_all_paths(crf):
    from itertools import product

    rng = np.random.default_rng(1)
    for n in (1, 2, 3):
        scores = rng.normal(size=(n, len(pii_crf.TAGS)))
        def value(path):
            return crf.pairs[-1, path[0]] + sum(scores[i, t] for i, t in enumerate(path)) + sum(
                crf.pairs[a, b] for a, b in zip(path, path[1:]))
        best = max(product(range(len(pii_crf.TAGS)), repeat=n), key=value)
        assert tuple(crf.decode([scores])[0]) == best


def test_personal_data_of_odd_rows(spark, crf):
    rows = [(1, "mail a.b@c.example.com now", 1), (2, None, 2), (3, "", 3), (None, "+1 (269) 555-3296", 4),
            (4, "call (988) 555-2485 or 988-555-2485", 5), (5, "x" * 200_000 + "9" * 200_000, 6),
            (6, "no data, version 2.0, in 1999, page 12", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_email int")
    found = {r.doc_id: r for r in pii_crf.find(docs, crf).collect()}
    assert len(found) == len(rows)
    assert found[1].spans == "email:5:22" and found[1].n_email == 1
    assert found[2].spans == found[3].spans == found[5].spans == found[6].spans == ""
    assert found[None].base == "phone:0:17"
    assert found[4].base == "" and found[4].spans == "phone:5:19,phone:23:35"
    full = spark.createDataFrame([(*r, len(r[1]) if r[1] else None) for r in rows],
                                 "doc_id long, text string, n_email int, n_chars long")
    back = {r.doc_id: r for r in pii_crf.redact(full, crf).collect()}
    assert back[1].text == "mail [EMAIL] now" and back[1].n_chars == len(back[1].text)
    assert back[2].text is None and back[6].text == rows[6][1]
    assert back[4].text == "call [PHONE] or [PHONE]" and back[1].n_email == 1
    assert pii_crf.find(docs.limit(0), crf).count() == 0 and pii_crf.redact(full.limit(0), crf).count() == 0


def test_a_labelled_table_may_be_empty(spark):
    field = pii_crf.train_table(spark.createDataFrame([], "text string, spans string"))
    assert pii_crf.field_spans(["call 988-555-2485"], field) == [[]]
    with pytest.raises(ValueError):
        pii_crf.train_table(pii_crf.labelled_table(spark), most=10)
